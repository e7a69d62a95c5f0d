"""Secret scan against plain regular expressions."""

import base64
import hashlib
import json
import re
import time
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm import secrets

GOOD_HEAD = base64.urlsafe_b64encode(b'{"alg":"none"}').decode().rstrip("=")
PIECES = st.sampled_from(
    ["password", "PassWord", "token", "secret", "api_key", "APIKEY", "passwd", "=", ":", " ", '"', "'", "\n", "abc", "abcdef",
     "x" * 7, "AKIA", "akia", "A1" * 9, "deadbeef" * 3, "0123456789ab" * 2, "f" * 23, "İ", "K", "ſecret", "-", "/", "é", "漢"]
)


def plain(text: str) -> list[tuple[int, int, str]]:
    rules = [
        ("assign", re.compile(secrets.ASSIGN), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    found = [(m.start(), i, m.end()) for i, (_, p, holds) in enumerate(rules) for m in p.finditer(text) if holds(m)]
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans(text):
    runs = re.compile("[0-9a-f]{24,}")
    spans = secrets.spans_of(text, secrets.automaton(), secrets.patterns(), runs)
    assert [span for span in spans if span[1] < 3] == plain(text)


def crc_token(body: str) -> str:
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = secrets.BASE62[digit] + digits
    return f"ghp_{body}{digits.rjust(6, '0')}"


def test_checksums(spark):
    good = crc_token("a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5")
    bad = good[:-1] + ("A" if good[-1] != "A" else "B")
    header = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
    jwt = f"{header}.eyJzdWIiOiIxIn0.c2lnbmF0dXJl"
    der = bytes([0x30, 3, 2, 1, 5])
    pem = f"-----BEGIN PRIVATE KEY-----\n{base64.b64encode(der).decode()}\n-----END PRIVATE KEY-----"
    texts = [f"x {good}", f"x {bad}", f"auth {jwt} end", "eyJhbGci.eyJ4.y", f"é{pem}", pem.replace("MAM", "MAQ"), None, "", "password=abcdefg"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {row.doc_id: row for row in secrets.scan(docs).collect()}
    assert rows[0].spans == f"crc_token:2:{2 + len(good)}" and rows[0].n_validated == 1
    assert rows[1].spans == ""
    assert rows[2].spans == f"jwt:5:{5 + len(jwt)}"
    assert rows[3].spans == ""
    assert rows[4].spans == f"pem:1:{1 + len(pem)}"
    assert rows[5].spans == ""
    for i in (6, 7):
        assert (rows[i].spans, rows[i].base_sha256) == ("", hashlib.sha256(b"").hexdigest())
    assert rows[8].spans == "assign:0:16" and rows[8].n_assign == 1
    assert rows[8].base_sha256 == hashlib.sha256(b"assign:0:16").hexdigest()


def spans(text: str) -> list:
    return secrets.spans_of(text, secrets.automaton(), secrets.patterns(), re.compile("[0-9a-f]{24,}"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["eyJ", "EYJ", "eyj", ".", "a", "-", " ", GOOD_HEAD]), max_size=12).map("".join))
def test_token_runs(text):
    """The leftmost tokens, as a plain search finds them, whatever hits lie before in a run."""
    found, at = [], 0
    while match := re.compile(secrets.JWT).search(text, at):
        at = match.end()
        if secrets.is_jwt(match[0]):
            found.append((match.start(), secrets.KINDS.index("jwt"), match.end()))
    assert [span for span in spans(text) if span[1] == secrets.KINDS.index("jwt")] == found


def test_long_runs_take_linear_time():
    begin = time.process_time()
    for piece in ("eyJ", "eyJa.", "AKIA", "password ", "-----BEGIN PRIVATE KEY-----\nAAAA", "ghp_", "0af"):
        spans(piece * (3_000_000 // len(piece)))
    assert time.process_time() - begin < 60


def test_every_document(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    rows = secrets.scan(docs).collect()
    assert len(rows) == len(texts) and sum(row.n_assign + row.n_access + row.n_hex for row in rows)
    for row in rows:
        base = ",".join(f"{secrets.KINDS[kind]}:{start}:{end}" for start, kind, end in plain(texts[row.doc_id]))
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def test_nulls_and_other_columns(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "token: abcdef", 2), (1, "token: abcdef", 2)], "doc_id long, text string, spans int")
    assert [row.spans for row in secrets.scan(docs).orderBy("doc_id").collect()] == ["", "assign:0:13", "assign:0:13"]
    assert secrets.scan(docs.limit(0)).collect() == []
