"""Secret scan: keyword automaton, anchored patterns near its hits, checksums.

One pass of an Aho-Corasick automaton over each text finds the places where a secret
could begin. Only there a pattern is tried, anchored at the place, so the cost does not
grow with the number of patterns. Kinds that carry a checksum or a fixed structure are
then validated; the base kinds are reported as they match.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm.frames import as_texts, by_piece

# The base kinds, as they are to be reported.
ASSIGN = r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 20
HEX = r"[0-9a-f]+"
HEX_LEAST = 24

# Public formats of tokens that can be validated.
CRC_TOKEN = r"(?:ghp|gho|ghu|ghs|ghr|npm)_[A-Za-z0-9]{36}(?![A-Za-z0-9])"
JWT = r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"
JWT_HEAD, JWT_RUN = "eyJ", re.compile("[A-Za-z0-9_-]+")
PEM = r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----[A-Za-z0-9+/=\s]+-----END \1-----"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Kinds in the order that breaks ties between spans of one start.
KINDS = ("assign", "access", "hex", "crc_token", "jwt", "pem")
BASE_KINDS = KINDS[:3]
#: Keywords in lower case, and the kind whose pattern is tried where one begins.
KEYWORDS = (
    *((word, "assign") for word in ("password", "passwd", "secret", "token", "apikey", "api_key")),
    ("akia", "access"),
    *((f"{word}_", "crc_token") for word in ("ghp", "gho", "ghu", "ghs", "ghr", "npm")),
    ("eyj", "jwt"),
    ("-----begin ", "pem"),
)
UPPER = {code: code + 32 for code in range(65, 91)}


def crc_is_right(token: str) -> bool:
    """The last six characters are the CRC-32 of those after the prefix, in base 62."""
    body, check = token[4:-6], token[-6:]
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0") == check


def is_jwt(token: str) -> bool:
    """The header decodes to a JSON object that names an algorithm."""
    head = token.split(".")[0]
    try:
        header = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except ValueError:
        return False
    return isinstance(header, dict) and "alg" in header


def is_pem(block: str) -> bool:
    """The body is base64 of a DER sequence, whose length field fits."""
    body = "".join(block.split("-----")[2].split())
    try:
        der = base64.b64decode(body, validate=True)
    except ValueError:
        return False
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    size = der[1] & 0x7F
    return len(der) == 2 + size + int.from_bytes(der[2 : 2 + size], "big")


def automaton():
    words = ahocorasick.Automaton()
    for word, kind in KEYWORDS:
        words.add_word(word, (len(word), kind))
    words.make_automaton()
    return words


def patterns() -> dict:
    """The anchored pattern and the test of each kind that has keywords."""
    return {
        "assign": (re.compile(ASSIGN), lambda m: len(m[2]) >= ASSIGN_LEAST),
        "access": (re.compile(ACCESS), lambda m: len(m[0]) >= ACCESS_LEAST),
        "crc_token": (re.compile(CRC_TOKEN), lambda m: crc_is_right(m[0])),
        "jwt": (re.compile(JWT), lambda m: is_jwt(m[0])),
        "pem": (re.compile(PEM), lambda m: is_pem(m[0])),
    }


def lowered(text: str) -> str:
    """Lower case with every character at its old place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(UPPER)


def spans_of(text: str, words, tried: dict, runs: re.Pattern) -> list[tuple[int, int, str]]:
    """``start, order of the kind, end`` of all secrets, sorted."""
    found, past = [], dict.fromkeys(KINDS, 0)
    hits = ((last - length + 1, kind) for last, (length, kind) in words.iter(lowered(text)))
    for start, kind in sorted(hits):
        if start < past[kind]:
            continue  # inside the previous match of its kind
        pattern, holds = tried[kind]
        match = pattern.match(text, start)
        if match is None and kind == "jwt" and text.startswith(JWT_HEAD, start):
            # a hit further on in the same characters would fail where this one did
            past[kind] = JWT_RUN.match(text, start).end()
        if match:
            past[kind] = match.end()
            if holds(match):
                found.append((start, KINDS.index(kind), match.end()))
    found += [(run.start(), KINDS.index("hex"), run.end()) for run in runs.finditer(text)]
    return sorted(found)


def scan(docs: DataFrame) -> DataFrame:
    """What secrets each text holds, one row per row of ``docs``.

    ``doc_id``; ``n_assign, n_access, n_hex`` count the base kinds; ``base_sha256`` is
    the digest of their ``kind:start:end``, by start and then kind, joined by commas;
    ``spans`` is that text with the validated kinds too; ``n_validated`` counts those.
    Places are code points, the end exclusive. A null text is an empty one, with no
    spans and the digest of an empty text. Rows that repeat each give a row. Other
    columns are ignored.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        words, tried, runs = automaton(), patterns(), re.compile(f"{HEX[:-1]}{{{HEX_LEAST},}}")
        counts, digests, texts = [], [], []
        for text in piece.column("text").to_pylist():
            spans = spans_of(text, words, tried, runs) if text else []
            named = [(KINDS[kind], start, end) for start, kind, end in spans]
            base = ",".join(f"{kind}:{start}:{end}" for kind, start, end in named if kind in BASE_KINDS)
            kinds = [kind for kind, _, _ in named]
            counts.append([kinds.count(kind) for kind in BASE_KINDS])
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            texts.append(",".join(f"{kind}:{start}:{end}" for kind, start, end in named))
        columns = list(zip(*counts, strict=True)) if counts else [[], [], []]
        validated = [text.count(":") // 2 - sum(row) for text, row in zip(texts, counts, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                *(pa.array(column, pa.int64()) for column in columns),
                pa.array(digests, pa.string()),
                pa.array(texts, pa.string()),
                pa.array(validated, pa.int64()),
            ],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_validated"],
        )

    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_validated long"
    )
    return by_piece(as_texts(docs), ["doc_id", "text"], work, schema)
