"""Suffix arrays and byte dedup against plain sorting and counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm import byte_anchors, repeated_bytes, suffix_groups, window_classes


def suffixes(symbols: list[int]) -> dict[int, tuple]:
    """What follows each symbol but 0, up to the next 0."""
    return {i: tuple(symbols[i : symbols.index(0, i)]) for i, symbol in enumerate(symbols) if symbol}


STRING = st.lists(st.integers(1, 3), max_size=12)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(STRING, st.integers(1, 4)), max_size=5))
def test_suffix_array(parts):
    symbols = [0, *(symbol for string, times in parts for symbol in (*string * times, 0))]
    own = suffixes(symbols)
    order = suffix_groups.suffix_array(np.array(symbols)).tolist()
    assert sorted(order) == sorted(own)
    assert [own[i] for i in order] == sorted(own.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=30))
def test_groups_are_lyndon_prefixes(string):
    """The longest prefix that is smaller than all of its proper suffixes, by descending order."""
    group, length, _ = suffix_groups.lyndon_groups(np.array([0, *string, 0]))
    longest = {}
    for i in range(len(string)):
        prefixes = (tuple(string[i:j]) for j in range(i + 1, len(string) + 1))
        longest[i] = max((p for p in prefixes if all(p < p[k:] for k in range(1, len(p)))), key=len)
        assert length[i + 1] == len(longest[i])
    ranks = sorted(set(longest.values()), reverse=True)
    assert [group[i + 1] for i in range(len(string))] == [ranks.index(longest[i]) for i in range(len(string))]


def repetitive(rnd: random.Random) -> tuple[list[bytes], list[int]]:
    alphabet = rnd.choice([b"a", b"ab", b"abc de\x00", bytes(range(97, 123)) + b" ", "é漢 a".encode()])
    base = bytes(rnd.choice(alphabet) for _ in range(900))
    if rnd.random() < 0.3:
        base = (base[: rnd.randint(1, 120)] * 900)[:900]
    strings = []
    for _ in range(rnd.randint(1, 7)):
        begin = rnd.randint(0, 500)
        string = bytearray(base[begin : begin + rnd.randint(0, 420)])
        for _ in range(rnd.randint(0, 2) if string else 0):
            string[rnd.randrange(len(string))] = rnd.choice(alphabet)
        strings.append(bytes(string))
    return strings, [rnd.choice([1, 1, 1, 2]) for _ in strings]


@pytest.mark.parametrize("seed", range(60))
def test_repeated_starts(seed):
    strings, copies = repetitive(random.Random(seed))
    bounds = np.cumsum([0, *map(len, strings)])
    raw = b"".join(strings)
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, again = window_classes.repeated_starts(data, bounds, np.array(copies), 200)
    places = [i for a, b in zip(bounds, bounds[1:], strict=False) for i in range(a, b - 199)]
    count = Counter()
    for a, b, n in zip(bounds, bounds[1:], copies, strict=False):
        for i in range(a, b - 199):
            count[raw[i : i + 200]] += n
    assert starts.tolist() == places
    assert again.tolist() == [count[raw[i : i + 200]] > 1 for i in places]


@pytest.mark.parametrize("seed", range(20))
def test_every_string_has_one_context_and_its_own_anchor(seed, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(byte_anchors, "BLOCK_BYTES", rnd.choice([50, 333, 1 << 20]))
    alphabet = rnd.choice([b"a", b"ab", bytes(range(97, 123))])
    texts = [bytes(rnd.choice(alphabet) for _ in range(rnd.choice([0, 10, 199, 200, 201, 700]))) for _ in range(5)]
    bounds = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    seen, keys = [], {}
    for (block, begin, _), anchors in byte_anchors.anchors_of(data, bounds, 200):
        for text, low, high, place, key in zip(*(column.tolist() for column in anchors), strict=True):
            for i in range(low, high + 1):
                seen.append(begin + i)
                assert bounds[text] <= begin + i <= bounds[text + 1] - 200
                assert keys.setdefault(block[i : i + 200].tobytes(), (place - i, key)) == (place - i, key)
    assert seen == [i for a, b in zip(bounds, bounds[1:], strict=False) for i in range(a, b - 199)]


def plain_removal(rows: list[tuple]) -> list[tuple]:
    texts = [(text or "").encode() for _, text in rows]
    count = Counter(text[i : i + 200] for text in texts for i in range(len(text) - 199))
    out = []
    for (doc_id, _), text in zip(rows, texts, strict=True):
        gone = np.zeros(len(text) + 1, dtype=np.int8)
        for i in range(len(text) - 199):
            if count[text[i : i + 200]] > 1:
                gone[i : i + 200] = 1
        kept = bytes(byte for byte, drop in zip(text, gone[:-1], strict=True) if not drop)
        spans = int((np.diff(gone, prepend=0) == 1).sum())
        out.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(f"w{rnd.randrange(400)}é" for _ in range(n))


def rows_of(rnd: random.Random) -> list[tuple]:
    """Copies, near copies, passages in ever new surroundings, runs, short and odd texts."""
    phrase, passage = prose(rnd, 24), prose(rnd, 60)
    rows = [(i, prose(rnd, rnd.randint(20, 90)) + phrase + prose(rnd, 40)) for i in range(40)]
    rows += [(50 + i, prose(rnd, 30) + passage + prose(rnd, i)) for i in range(6)]
    rows += [(60 + i, rows[45][1]) for i in range(4)] + [(70, rows[45][1].replace("w1", "v", 1))]
    rows += [(80, "ab" * 300), (81, "x" * 199), (82, "x" * 200), (83, "x" * 200), (84, "é" * 350), (85, "\x00" * 230)]
    rows += [(90, None), (91, ""), (None, passage), (90, prose(rnd, 200)), (90, "dup " * 10), (90, "dup " * 10)]
    rows += [(92, "abc" * 70 + passage + "abc" * 70)]
    return rows


@pytest.mark.parametrize("most", [2, 5, 8192])
def test_removal(spark, monkeypatch, most):
    """Also where an anchor's contexts go down to single strings."""
    monkeypatch.setattr(repeated_bytes, "MOST_CONTEXTS", most)
    monkeypatch.setattr(repeated_bytes, "SORTED_BYTES", 3000)
    rows = rows_of(random.Random(7))
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, n_bytes int, t1 string")
    got = repeated_bytes.removal_digests(docs.repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == plain_removal(rows)
    assert repeated_bytes.removal_digests(docs.limit(0)).collect() == []


def test_kept_bytes_and_columns(spark):
    line = "".join(f"{i}th word of a passage that two texts have; " for i in range(8))
    rows = [(1, "one " + line + "end", "a"), (2, line + "three", "b"), (2, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = {row.row.kept: row for row in repeated_bytes.remove_repeats(docs).collect()}
    assert bytes(got["a"].kept) == b"one end" and bytes(got["b"].kept) == b"three" and bytes(got["c"].kept) == b""
    assert [tuple(span) for span in got["a"].spans] == [(4, 4 + len(line))] and got["a"].n_bytes == len(line) + 7


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    got = repeated_bytes.removal_digests(docs).collect()
    assert sorted(map(tuple, got), key=str) == plain_removal(rows)
    assert sum(row.n_removed for row in got)
