"""Words, shingles and bit tables against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import peak_mb
from tests.llm import brute
from tidegauge.llm import frames, tokens
from tidegauge.sources.workspace import Scratch, materialize

TEXTS = st.lists(
    st.none() | st.text(alphabet="abAB \t\n\x0b\x1c.é漢", max_size=30), min_size=1, max_size=8
)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 7))
def test_equal_words_and_shingles_have_equal_hashes(texts, size):
    array = pa.array(texts, pa.string())
    words = tokens.words_of(array)
    hashes = tokens.hash_words(words)
    grams, bounds = tokens.shingles(hashes, words.first, size)
    lower = [[word.translate(brute.UPPER) for word in brute.words(text)] for text in texts]
    assert np.diff(words.first).tolist() == [len(own) for own in lower]
    plain = [gram for own in lower for gram in brute.shingles(own, size)]
    assert np.diff(bounds).tolist() == [len(brute.shingles(own, size)) for own in lower]
    assert len(set(grams.tolist())) == len(set(plain)) == len(set(zip(grams.tolist(), plain, strict=True)))


def test_hashes_do_not_depend_on_the_batch(monkeypatch):
    texts = pa.array([f"word{i} " * (i % 7) + "the END" for i in range(300)])
    whole = tokens.hash_words(tokens.words_of(texts))
    monkeypatch.setattr(tokens, "HASH_BYTES", 50)
    assert (tokens.hash_words(tokens.words_of(texts)) == whole).all()
    words = tokens.words_of(texts)
    part = tokens.hash_words(tokens.words_of(texts.slice(100, 50)))
    assert (part == whole[words.first[100] : words.first[150]]).all()


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 7), st.integers(8, 40))
def test_words_and_shingles_do_not_depend_on_the_block(texts, size, block):
    array, usual = pa.array(texts, pa.string()), tokens.HASH_BYTES
    found = []
    try:
        for tokens.HASH_BYTES in (usual, block):
            words = tokens.words_of(array)
            found.append([*words, *tokens.shingles(tokens.hash_words(words), words.first, size)])
    finally:
        tokens.HASH_BYTES = usual
    assert all(np.array_equal(a, b) for a, b in zip(*found, strict=True))


def test_words_and_shingles_hold_little_besides_their_results():
    texts = pa.array(["a few short words\n" * 100] * 2000)
    words = tokens.words_of(texts)
    hashes = tokens.hash_words(words)
    assert peak_mb(lambda: tokens.words_of(texts)) < 2.5 * (words.starts.nbytes + words.ends.nbytes) / 1e6
    assert peak_mb(lambda: tokens.shingles(hashes, words.first)) < 2 * hashes.nbytes / 1e6
    bitmap = np.zeros(1 << 12, dtype=np.uint8)
    assert peak_mb(lambda: frames.in_bitmap(bitmap, hashes)) < hashes.nbytes / 1e6


def test_pieces_cover_all_rows(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE_BYTES", 100)
    texts = pa.array(["x" * n for n in (0, 500, 20, 30, 0, 99, 2, 100, 1)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    got = list(tokens.pieces(batch, texts))
    assert [x for piece in got for x in piece.column(0).to_pylist()] == texts.to_pylist()
    assert max(sum(map(len, piece.column(0).to_pylist())) for piece in got if piece.num_rows > 1) <= 100


def test_bitmap(spark):
    present = [0, 1, 32767, 32768, 65535, -1, 1 << 40, 987654321]
    bitmap = frames.hash_bitmap(spark.createDataFrame([(x,) for x in present], "h long"), "h", 16)
    hashes = np.array(present, dtype=np.int64).view(np.uint64)
    assert frames.in_bitmap(bitmap, hashes).all()
    others = np.arange(100, 200, dtype=np.uint64)
    assert not frames.in_bitmap(bitmap, others).any()


def test_split_by_bitmap(spark):
    """Every present hash is in the first part, and the parts are all rows."""
    present = [0, 1, 32767, 32768, 65535, -1, 1 << 40, 987654321]
    scratch = Scratch(spark, "bitmap")
    table = frames.bitmap_table(spark.createDataFrame([(x,) for x in present], "h long"), 16, scratch, "bits")
    rows = spark.createDataFrame([(x, i) for i, x in enumerate([*present, None, *range(100, 3000)])], "h long, i int")
    may, cannot = frames.split_by(rows, F.col("h"), table, 16)
    assert {row.h for row in may.collect()} == {*present}
    assert sorted(row.i for part in (may, cannot) for row in part.collect()) == list(range(rows.count()))
    empty = frames.bitmap_table(rows.select("h").limit(0), 16, scratch, "none")
    assert frames.split_by(rows, F.col("h"), empty, 16)[0].collect() == []


def test_lookup_both_ways(spark):
    """A small side that is broadcast and one that is salted give the same rows."""
    many = spark.createDataFrame([("hot", i) for i in range(60)] + [("a", 1), ("b", 2), (None, 3)], "k string, i int")
    few = spark.createDataFrame([("hot", 7), ("a", 8), ("c", 9)], "k string, v int")
    few = materialize(few, "few")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for how in ("inner", "left", "left_anti"):
        found = []
        for threshold in ("100m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            frame = frames.lookup(many, few, "k", ["i"], how)
            assert ("BroadcastHashJoin" in frame._jdf.queryExecution().executedPlan().toString()) == (threshold != "-1")
            found.append(sorted(map(str, frame.collect())))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert found[0] == found[1]
