"""Benchmark decontamination by fingerprints of item-sized windows.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case, so case,
punctuation and line breaks don't matter. An item of ``n`` words is looked for in all
windows of ``n`` words; a document with fewer words is one window.

1. A window can only be similar to an item if it holds ``need(n)`` shingles of items of
   its size. Two bit tables of fixed size, of the items' shingles and of their shingles
   by size, rule out all other windows while the texts are read. This loses nothing.
2. The SimHash of each window left is compared with the items of its size. The 64 bits
   are cut into ``RADIUS + 1`` blocks; fingerprints within ``RADIUS`` bits agree in a
   block at least, so an equality join on size, block and bits finds them all.
3. An edited item may lie outside the radius. The shingles of windows and items are
   therefore also put in one order, and those that share one of their first ones are
   candidates too: of two lists that share ``need(n)`` shingles, the first ones up to
   all but ``need(n) - 1`` have one in common. This loses nothing.
4. Of the candidates, the shingles, each weighing as often as it occurs, are compared
   exactly.

Every window that is similar enough is found.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import bitmap_table, by_piece, hash_bitmap, in_bitmap, lookup, split_by
from tidegauge.llm.tokens import (
    BETWEEN,
    ODD,
    SMALL_PIECE,
    hash_words,
    list_array,
    mix,
    shingles,
    signed,
    split_words,
    text_bytes,
)
from tidegauge.sources.workspace import Scratch

SIZE = 5
RADIUS = 12
FILTER_BITS = 24
#: Least share of an item's shingles, in hundredths.
PERCENT = 80


def need(n: int) -> int:
    """Shingles that a window must share with an item of ``n`` words."""
    return max(1, -(-PERCENT * (n - SIZE + 1) // 100))


def simhash(hashes: np.ndarray) -> int:
    """64-bit SimHash of words, each as often as it occurs."""
    ones = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.int64)[0])


def _by_size(grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    return mix(grams ^ (n.astype(np.uint64) * ODD[3]))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int64)
    return list_array(signed(np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)), ends)


def leading(grams: np.ndarray, n: int) -> np.ndarray:
    """The first of a list's shingles, one of which any list that is similar enough shares.

    A shingle's second and later occurrences count as shingles of their own.
    """
    grams = np.sort(grams)
    nth = np.arange(len(grams)) - np.searchsorted(grams, grams)
    return np.sort(mix(grams + nth.astype(np.uint64) * ODD[2]))[: max(0, len(grams) - need(n) + 1)]


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item_id, n, fingerprint, grams, sized, leading`` of each item that has words."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        words = split_words(*text_bytes(piece.column("text")), BETWEEN)
        hashes = hash_words(words)
        grams, bounds = shingles(hashes, words.first, SIZE)
        n = np.diff(words.first)
        rows = np.flatnonzero(n)
        prints = [simhash(hashes[words.first[i] : words.first[i + 1]]) for i in rows]
        ends = np.append(bounds[rows], len(grams))
        sized = _by_size(grams, np.repeat(n, np.diff(bounds)))
        first = [leading(grams[bounds[i] : bounds[i + 1]], int(n[i])) for i in rows]
        return pa.RecordBatch.from_arrays(
            [
                piece.column("item_id").take(pa.array(rows)),
                pa.array(n[rows], pa.int64()),
                pa.array(prints, pa.int64()),
                list_array(signed(grams), ends),
                list_array(signed(sized), ends),
                _lists(first),
            ],
            ["item_id", "n", "fingerprint", "grams", "sized", "leading"],
        )

    texts = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    schema = "item_id long, n long, fingerprint long, grams array<long>, sized array<long>, leading array<long>"
    return by_piece(texts, ["item_id", "text"], work, schema)


def _starts(places: np.ndarray, n: int, low: int, high: int) -> np.ndarray:
    """Windows of ``n`` words that begin in ``low..high`` and hold enough of ``places``."""
    wanted, span = need(n), max(n - SIZE, 0)
    first, last = places[: len(places) - wanted + 1], places[wanted - 1 :]
    begin, end = np.maximum(last - span, low), np.minimum(first, high)
    fits = begin <= end
    if not fits.any():
        return np.zeros(0, dtype=np.int64)
    return np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(begin[fits], end[fits], strict=True)]))


def windows_of(docs: DataFrame, any_size: np.ndarray, own_size: np.ndarray, sizes: list[int]) -> DataFrame:
    """``digest, doc_id, start, n, fingerprint, grams, leading`` of the windows not ruled out."""
    sent = docs.sparkSession.sparkContext.broadcast((any_size, own_size, sizes))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        any_size, own_size, sizes = sent.value
        words = split_words(*text_bytes(piece.column("text")), BETWEEN)
        hashes = hash_words(words)
        grams, bounds = shingles(hashes, words.first, SIZE)
        hits = np.flatnonzero(in_bitmap(any_size, grams))
        owner = np.searchsorted(bounds, hits, side="right") - 1
        rows, starts, lengths, prints, parts = [], [], [], [], []
        found, begin = np.unique(owner, return_index=True)
        for i, a, b in zip(found, begin, [*begin[1:], len(hits)], strict=False):
            places, n_words = hits[a:b] - bounds[i], int(words.first[i + 1] - words.first[i])
            own, word_hashes = grams[bounds[i] : bounds[i + 1]], hashes[words.first[i] : words.first[i + 1]]
            for n in sizes:
                if len(places) < need(n):
                    continue
                width = min(n, n_words)
                sized = places[in_bitmap(own_size, _by_size(own[places], np.full(len(places), n)))]
                if len(sized) < need(n):
                    continue
                for start in _starts(sized, n, 0, n_words - width):
                    rows.append(i)
                    starts.append(start)
                    lengths.append(n)
                    prints.append(simhash(word_hashes[start : start + width]))
                    parts.append(own[start : start + max(1, width - SIZE + 1)])
        take = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                piece.column("digest").take(take),
                piece.column("doc_id").take(take),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(prints, pa.int64()),
                _lists(parts),
                _lists([leading(part, n) for part, n in zip(parts, lengths, strict=True)]),
            ],
            ["digest", "doc_id", "start", "n", "fingerprint", "grams", "leading"],
        )

    schema = (
        "digest string, doc_id long, start long, n long, fingerprint long, grams array<long>, leading array<long>"
    )
    return by_piece(docs, ["digest", "doc_id", "text"], work, schema, SMALL_PIECE)


def _blocks() -> list[tuple[int, int]]:
    """Shift and mask of ``RADIUS + 1`` blocks that cover 64 bits."""
    edges = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _indexed(df: DataFrame) -> DataFrame:
    """One row for each block of the fingerprint, with the join's key."""
    blocks = F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned("fingerprint", shift).bitwiseAND(F.lit(mask)).alias("bits"),
            )
            for i, (shift, mask) in enumerate(_blocks())
        )
    )
    return df.select("*", F.explode(blocks).alias("at")).select("*", "at.block", "at.bits").drop("at")


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles shared by window and item, as a share of the longer one's."""
    for batch in batches:
        shared = []
        for a, b in zip(batch.column("grams").to_pylist(), batch.column("item_grams").to_pylist(), strict=True):
            shared.append(sum((Counter(a) & Counter(b)).values()) / max(len(a), len(b)))
        kept = ["digest", "doc_id", "item_id", "start"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in kept), pa.array(shared, pa.float64())], [*kept, "similarity"]
        )


def _matches(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """``digest, doc_id, item_id, start, similarity`` of every window like an item."""
    items = scratch.table(items_of(benchmark).withColumn("item", F.monotonically_increasing_id()), "items")
    any_size = hash_bitmap(items.select(F.explode("grams").alias("gram")), "gram", FILTER_BITS)
    own_size = hash_bitmap(items.select(F.explode("sized").alias("gram")), "gram", FILTER_BITS)
    sizes = [row[0] for row in items.select("n").distinct().orderBy("n").collect()]
    texts = docs.select(
        F.md5(F.col("text").cast("string").cast("binary")).alias("digest"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    windows = scratch.table(
        windows_of(texts, any_size, own_size, sizes).withColumn("window", F.monotonically_increasing_id()),
        "windows",
    )
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS
    near_pairs = (
        _indexed(windows.select("window", "n", "fingerprint"))
        .join(
            _indexed(items.select("item", "n", "fingerprint")).select(
                "n", "block", "bits", "item", F.col("fingerprint").alias("item_print")
            ),
            ["n", "block", "bits"],
        )
        .where(near)
        .select("window", "item")
    )
    shared_pairs = (
        windows.select("window", "n", F.explode("leading").alias("gram"))
        .join(items.select("item", "n", F.explode("leading").alias("gram")), ["n", "gram"])
        .select("window", "item")
    )
    pairs = near_pairs.union(shared_pairs).distinct()
    return (
        windows.select("window", "digest", "doc_id", "start", "grams")
        .join(pairs, "window")
        .join(items.select("item", "item_id", F.col("grams").alias("item_grams")), "item")
        .select("digest", "doc_id", "item_id", "start", "grams", "item_grams")
        .mapInArrow(_similarity, "digest string, doc_id long, item_id long, start long, similarity double")
        .where(F.col("similarity") >= PERCENT / 100)
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item in it.

    ``doc_id, item_id, similarity`` (of the most similar window), ``windows`` (how many
    are similar enough) and ``first_word`` (the most similar window's first word, from
    0; the earliest if several). A null text, and one without words, matches nothing,
    as an item or as a document. An item of fewer than five words matches only a
    document that has just these words. Rows that repeat give one row; null ids stay
    null. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back")))
    return (
        _matches(docs, benchmark, scratch)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"), F.countDistinct("start").alias("windows"))
        .select(
            "doc_id", "item_id", "best.similarity", "windows", (-F.col("best.back")).alias("first_word")
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns.

    Rows are told apart by their text, so null and repeated ids don't matter.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate-keep")
    found = scratch.table(_matches(docs, benchmark, scratch).select("digest").distinct(), "found")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.md5(F.col("text").cast("string").cast("binary")), F.lit("")).alias("digest"),
    ).withColumn("doc_id", F.col("row.doc_id").cast("long"))
    # only rows whose digest may be among those found are joined
    hashes = bitmap_table(found.select(F.xxhash64("digest")), FILTER_BITS, scratch, "hashes")
    may, clean = split_by(rows, F.xxhash64("digest"), hashes, FILTER_BITS)
    return clean.select("row.*").union(lookup(may, found, "digest", ["doc_id"], "left_anti").select("row.*"))
