"""Periodic runs against every lag of every text, compared word by word."""

import hashlib
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import words
from tidegauge.llm import periodic_runs


def plain_runs(tokens: list) -> list[tuple[int, int, int]]:
    """``start, length, period`` by start and period."""
    found: dict[tuple[int, int], int] = {}
    n = len(tokens)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and tokens[j] == tokens[j - q]:
                j += 1
            length = j - i + q
            if length >= max(12, 2 * q):
                found.setdefault((i - q, length), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def plain_row(doc_id, text) -> tuple:
    tokens = words(text)
    n, h = len(tokens), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        tokens = [tokens[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(tokens)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(tokens) if i not in gone).encode()).hexdigest(),
    )


def found(*texts) -> list[list[tuple[int, int, int]]]:
    first = np.cumsum([0, *map(len, texts)])
    hashes = np.array([hash(str(token)) & 0xFFFFFFFF for text in texts for token in text], dtype=np.uint64)
    start, end, period = periodic_runs.find_runs(hashes, first)
    own = np.searchsorted(first, start, side="right") - 1
    rows = zip(own, start - first[own], end - start, period, strict=True)
    out = [[] for _ in texts]
    for i, *run in rows:
        out[i].append(tuple(map(int, run)))
    return out


@st.composite
def repetitive(draw, letters="abc"):
    """Powers of powers, joined: many nested runs and runs that touch."""
    parts = draw(st.lists(st.text(letters, min_size=1, max_size=9), min_size=1, max_size=4))
    for _ in range(draw(st.integers(0, 3))):
        i = draw(st.integers(0, len(parts) - 1))
        parts.append(parts[i] * draw(st.integers(1, 9)))
        if draw(st.booleans()):
            parts = ["".join(parts) * draw(st.integers(1, 3)), *parts[-1:]]
    return list("".join(parts)[:700])


@settings(max_examples=600, deadline=None)
@given(st.lists(repetitive(), min_size=1, max_size=3))
def test_nested_runs(texts):
    assert found(*texts) == [plain_runs(text) for text in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=300))
def test_two_words(text):
    assert found(text) == [plain_runs(text)]


@pytest.mark.parametrize("base, powers", [("aab", 9), ("aabaaba", 7), ("abaab" * 3 + "c", 5), ("a" * 20 + "x", 6), ("aabaab" * 4 + "a", 4)])
def test_periods_inside_periods(base, powers):
    """Runs whose root is itself periodic, between and after other runs of its period."""
    text = list(base * powers + "z" + base * 2 + base[: len(base) // 2])
    assert found(text) == [plain_runs(text)]


def test_runs_of_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    assert found(list(b)) == [plain_runs(b)]


def test_long_texts_take_linear_work():
    """One word, two long stretches of it, a short period and a repeated page, at 400,000 words."""
    n = 400_000
    begin = time.process_time()
    assert found(["w"] * n) == [[(0, n, 1)]]
    assert found(["w"] * n + ["x"] + ["w"] * n) == [[(0, n, 1), (n + 1, n, 1)]]
    page = [str(i) for i in range(n // 4)]
    assert found(page * 4) == [[(0, n, n // 4)]]
    line = ["copyright", "all", "rights", "reserved", "by", "the", "owner", "of", "this", "page", "and", "its", "parts"]
    scattered = [token for i in range(n // 20) for token in (*line, *(f"{i}-{k}" for k in range(7)))]
    assert found(scattered) == [[]]
    assert time.process_time() - begin < 60


def test_rows(spark):
    rows = [(None, "a " * 30, 1), (3, None, 2), (4, "", 2), (5, " \t\n", 2), (6, "one", 3), (6, "one", 3)]
    rows += [(i, " ".join(f"w{k % (i + 1)}" for k in range(97)), 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = periodic_runs.digests(periodic_runs.with_repeats(docs))
    expected = sorted((plain_row(doc, text) for doc, text, _ in rows), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert periodic_runs.digests(periodic_runs.with_repeats(docs.limit(0))).collect() == []


def test_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "x  y\tx y x y x y x y x y x y end")], "doc_id long, text string")
    row = periodic_runs.collapse(docs).first()
    assert (row.n_words, row.collapsed) == (15, "x y end")
    assert [tuple(run) for run in row.runs] == [(0, 14, 2)]


def test_every_document(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = periodic_runs.digests(periodic_runs.with_repeats(docs)).collect()
    expected = sorted(plain_row(row.doc_id, row.text) for row in docs.collect())
    assert sorted(map(tuple, got)) == expected
    assert sum(row.n_runs for row in got) > 10
