"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

Rows of the incidence matrix are *classes*: documents with one and the same set of
n-grams count once. The product of the matrix with its transpose holds the overlap of
every two classes; only what can reach the wanted similarity is computed:

* All n-grams have one total order, common ones last. Two sets of sizes ``a <= b``
  that overlap by ``4/9 (a + b)`` (Jaccard 0.8) share an n-gram among the first
  ``n - ceil(0.8 n) + 1`` of each, so only these entries are multiplied.
* Blocks are cut by n-gram and by size band, a factor of 5/4 wide. Sets in bands
  further apart than one differ too much in size.
* Two sets that reach the similarity share a number of prefix entries that follows from
  their sizes; a class with fewer shared entries than that is left out of a product.
* Within a block each class is first multiplied with one central class of its own
  and one of the next lower band only. Where the block's classes are then connected, no
  other product can change a component. What is left are the entries of classes
  outside the block's largest component, which are multiplied with all others.
* A block with more products than ``CROWDED`` times its classes' n-grams is not multiplied,
  as letters of one form would all meet there. The n-grams of its classes are counted, which
  costs less, and these classes get prefixes anew, rarest n-grams first; the blocks of those
  are multiplied instead.

So a group of thousands of near copies costs a few products per copy, yet no link
between different components is missed. Only where thousands of sets are not similar, and
each is made up of n-grams that very many of them have, does the last step compare many
pairs; it stays exact.

The first order's weights are counts of n-grams that occur twice in some piece of the
input, kept in a table of fixed size. They only steer the cost, never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.frames import (
    as_texts,
    bitmap_table,
    by_piece,
    hash_bitmap,
    in_bitmap,
    lookup,
    split_by,
    with_columns_by_piece,
)
from tidegauge.llm.graph import components
from tidegauge.llm.tokens import hash_words, list_array, shingles, signed, words_of
from tidegauge.sources.workspace import Scratch

SIZE = 5
WEIGHT_BITS = 20
FILTER_BITS = 24
#: Jaccard as a share of the union, in hundredths.
PERCENT = 80
#: Products of a block for each n-gram of its classes, up to which it is multiplied.
CROWDED = 4


def ngram_sets(texts: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Sorted distinct n-gram hashes of each text, their bounds, and a 128-bit key of each set."""
    words = words_of(texts)
    values, bounds = shingles(hash_words(words), words.first, size)
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        values[begin:end].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][bounds[:-1] < len(values)]] = True
    bounds = np.concatenate([[0], np.cumsum(new)])[bounds]
    values = values[new]
    keys = [
        hashlib.blake2b(values[begin:end], digest_size=16).digest()
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True)
    ]
    return values, bounds, keys


def _chosen(values: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of some rows only."""
    if not len(rows):
        return values[:0], np.zeros(1, dtype=np.int64)
    parts = [values[bounds[i] : bounds[i + 1]] for i in rows]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def _first_rows(keys: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    for i, key in enumerate(keys):
        seen.setdefault(key, i)
    return np.fromiter(seen.values(), dtype=np.int64, count=len(seen))


def signatures(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_shingles, key`` per row, and the n-grams common in its piece of the input."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds, keys = ngram_sets(piece.column("text"), size)
        own, _ = _chosen(values, bounds, _first_rows(keys))
        common, times = np.unique(own, return_counts=True)
        common, times = common[times > 1], times[times > 1]
        ends = np.full(len(keys) + 1, len(common))
        ends[0] = 0  # the first row carries them
        return pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                pa.array(np.diff(bounds)),
                pa.array(keys, pa.binary()),
                list_array(signed(common), ends),
                list_array(times, ends),
            ],
            ["doc_id", "n_shingles", "key", "common", "times"],
        )

    return by_piece(
        docs,
        ["doc_id", "text"],
        work,
        "doc_id long, n_shingles long, key binary, common array<long>, times array<long>",
    )


def order_weights(signed_docs: DataFrame, bits: int = WEIGHT_BITS) -> np.ndarray:
    """For each residue of a hash, the logarithm of the count of its commonest n-gram."""
    found = (
        signed_docs.where(F.size("common") > 0)
        .select(F.explode(F.arrays_zip("common", "times")).alias("x"))
        .groupBy(F.col("x.common").alias("shingle"))
        .agg(F.sum("x.times").alias("times"))
        .groupBy(F.col("shingle").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("residue"))
        .agg(F.floor(F.log2(F.max("times"))).cast("int").alias("weight"))
        .where("weight > 2")
        .toArrow()
    )
    weights = np.zeros(1 << bits, dtype=np.uint8)
    weights[found.column("residue").to_numpy()] = found.column("weight").to_numpy()
    return weights


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (PERCENT * n + 99) // 100 + 1


def _prefixes(docs: DataFrame, weights: np.ndarray, size: int) -> DataFrame:
    """``key, n, doc_id, prefix`` of each class in each piece."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds, keys = ngram_sets(piece.column("text"), size)
        weight = sent.value[values & np.uint64(len(sent.value) - 1)]
        rows = _first_rows(keys)
        n = np.diff(bounds)[rows]
        rows, n = rows[n > 0], n[n > 0]
        lengths = prefix_length(n)
        out = []
        for i, length in zip(rows, lengths, strict=True):
            own, heavy = values[bounds[i] : bounds[i + 1]], weight[bounds[i] : bounds[i + 1]]
            out.append(own[np.argsort(heavy, kind="stable")[:length]] if heavy.any() else own[:length])
        smallest: dict[bytes, int] = {}
        for key, doc in zip(keys, piece.column("doc_id").to_pylist(), strict=True):
            if doc is not None:
                smallest[key] = min(doc, smallest.get(key, doc))
        keys = [keys[i] for i in rows]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.binary()),
                pa.array(n, pa.int64()),
                pa.array([smallest.get(key) for key in keys], pa.int64()),
                list_array(
                    signed(np.concatenate(out)) if out else np.zeros(0, dtype=np.int64),
                    np.concatenate([[0], np.cumsum(lengths)]),
                ),
            ],
            ["key", "n", "doc_id", "prefix"],
        )

    return by_piece(docs, ["doc_id", "text"], work, "key binary, n long, doc_id long, prefix array<long>")


def _sets(docs: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """``key, grams`` for the classes in ``keys``; the texts are not shuffled."""
    wanted = keys.select("key", F.xxhash64("key").alias("hash"))
    sent = docs.sparkSession.sparkContext.broadcast(
        hash_bitmap(
            wanted.select(F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("long").alias("head")),
            "head",
            FILTER_BITS,
        )
    )

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds, keys = ngram_sets(piece.column("text"), size)
        heads = np.array([int.from_bytes(key[:7], "big") for key in keys], dtype=np.uint64)
        rows = _first_rows(keys)
        rows = rows[in_bitmap(sent.value, heads[rows])]
        own, ends = _chosen(values, bounds, rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([keys[i] for i in rows], pa.binary()), list_array(signed(own), ends)], ["key", "grams"]
        )

    return by_piece(docs, ["text"], work, "key binary, grams array<long>")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose overlap reaches the bound."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    overlap = F.size(F.array_intersect("grams_a", "grams_b"))
    both = F.size("grams_a") + F.size("grams_b")
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .where(F.lit(100) * overlap >= F.lit(PERCENT) * (both - overlap))
        .select("a", "b")
    )


def link_classes(docs: DataFrame, scratch: Scratch, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and ``key, component_id`` of each class of equal sets.

    ``docs`` has ``doc_id`` and ``text``. Both results are read from ``scratch``.
    """
    docs = as_texts(docs)
    marked = scratch.table(signatures(docs, size), "signatures")
    weights = order_weights(marked)

    node = F.monotonically_increasing_id()
    classes = scratch.table(
        _prefixes(docs, weights, size)
        .groupBy("key", "n")
        .agg(F.min("doc_id").alias("doc_id"), F.first("prefix").alias("prefix"))
        .withColumn("node", node),
        "classes",
    )
    entries = _incidence(classes, scratch, "entries")
    nodes = scratch.table(classes.select("node", "key", "doc_id"), "nodes")
    scratch.drop("classes")

    def sets_of(members: DataFrame, label: str) -> DataFrame:
        wanted = scratch.table(nodes.join(members, "node").select("key", "node"), f"{label}-wanted")
        return scratch.table(
            _sets(docs, wanted, size)
            .join(wanted, "key")
            .groupBy("key")
            .agg(F.first("node").alias("node"), F.first("grams").alias("grams"))
            .select("node", "grams"),
            label,
        )

    pairs = scratch.table(_first_products(entries), "pairs")
    sets = sets_of(_ends(pairs), "sets")
    links = scratch.table(_linked(pairs, sets), "links")
    found = components(links, scratch, "first")
    mixed = scratch.table(_mixed_blocks(entries, found), "mixed")
    crowded = scratch.table(mixed.where("crowded").select("node").distinct(), "crowded")
    covered = mixed.where(~F.col("crowded")).join(crowded.withColumn("again", F.lit(True)), "node", "left")
    rest = scratch.table(_remaining_products(covered, entries).join(pairs, ["a", "b"], "left_anti"), "rest")
    missing = scratch.table(_ends(rest).union(crowded).distinct().join(_ends(pairs), "node", "left_anti"), "missing")
    if not missing.isEmpty():
        sets = sets.union(sets_of(missing, "more-sets"))
    if not crowded.isEmpty():
        again = _incidence(_rarest_first(sets.join(crowded, "node", "left_semi")), scratch, "again")
        others = _remaining_products(_mixed_blocks(again, found).withColumn("again", F.lit(None)), again)
        rest = rest.union(others.join(pairs.union(rest), ["a", "b"], "left_anti"))
    more = scratch.table(_linked(rest, sets), "more")
    scratch.drop("sets", "more-sets", "entries", "again", "mixed", "crowded", "missing", "pairs", "rest")
    scratch.drop("sets-wanted", "more-sets-wanted")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)
    final = components(edges, scratch, "last")

    rooted = nodes.join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = F.col("doc_id").isNotNull()
    smallest = rooted.groupBy("root").agg(
        F.coalesce(
            F.min(F.when(known, F.struct("doc_id", "key"))), F.min(F.struct("doc_id", "key"))
        ).alias("smallest")
    )
    labels = rooted.join(smallest, "root").select(
        "key",
        F.col("smallest.doc_id").alias("component_id"),
        F.col("smallest.key").alias("component_key"),
    )
    return marked.select("doc_id", "n_shingles", "key"), scratch.table(labels, "labels")


def _incidence(classes: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Entries of the n-grams that several of the classes' prefixes share.

    An n-gram of one prefix only adds to no overlap.
    """
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / PERCENT))).cast("int")
    shared = scratch.table(
        classes.select(F.explode("prefix").alias("shingle"), "node", F.col("n").cast("int").alias("n"))
        .withColumn("members", F.count("*").over(Window.partitionBy("shingle")))
        .where("members > 1")
        .select("shingle", "members", band.alias("band"), "node", "n"),
        f"{label}-shared",
    )
    own = Window.partitionBy("node")
    entries = scratch.table(
        shared.withColumn("held", F.count("*").over(own))
        .withColumn("met", F.sum("members").over(own))
        .withColumn("place", F.row_number().over(own.orderBy("members", "shingle")))
        .drop("members"),
        label,
    )
    scratch.drop(f"{label}-shared")
    return entries


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def _rarest_first(sets: DataFrame, bits: int = WEIGHT_BITS) -> DataFrame:
    """``node, n, prefix`` of sets, their n-grams ordered by how many of the sets have them.

    Of the prefixes, n-grams that only one set has are left out.
    """
    found = (
        sets.select(F.explode("grams").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("times"))
        .where("times > 1")
        .groupBy(F.col("shingle").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("residue"))
        .agg(F.floor(4 * F.log2(F.max("times"))).cast("int").alias("weight"))
        .toArrow()
    )
    weights = np.zeros(1 << bits, dtype=np.uint8)
    weights[found.column("residue").to_numpy()] = np.minimum(found.column("weight").to_numpy(), 255)
    sent = sets.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("grams")
            n = grams.value_lengths().to_numpy().astype(np.int64)
            values = grams.flatten().to_numpy().view(np.uint64)
            weight = sent.value[values & np.uint64(len(sent.value) - 1)]
            out = []
            for end, size, length in zip(np.cumsum(n), n, prefix_length(n), strict=True):
                # a set's n-grams come sorted, so equal weights keep one order for all sets
                heavy = weight[end - size : end]
                first = np.argsort(heavy, kind="stable")[:length]
                out.append(values[end - size : end][first[heavy[first] > 0]])
            ends = np.concatenate([[0], np.cumsum([len(prefix) for prefix in out])]).astype(np.int64)
            prefixes = signed(np.concatenate(out) if out else values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(n), list_array(prefixes, ends)],
                ["node", "n", "prefix"],
            )

    return sets.select("node", "grams").mapInArrow(run, "node long, n long, prefix array<long>")


def _first_products(entries: DataFrame) -> DataFrame:
    """Each class with the center of its block and band, and of the band below.

    The center is the class that meets the most others in all its blocks, as the
    original among its edited copies does.
    """
    centers = entries.groupBy("shingle", "band").agg(F.max(F.struct("met", "node", "n", "held")).alias("center"))
    reach = centers.select(
        "shingle", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), "center"
    )
    pairs = (
        entries.join(reach, ["shingle", "band"])
        .where(
            _can_link(*(F.col(name) for name in ("n", "center.n", "held", "center.held")))
            & (F.col("node") != F.col("center.node"))
        )
        .select(
            F.least("node", "center.node").alias("a"), F.greatest("node", "center.node").alias("b")
        )
        .distinct()
    )
    return _overlapping(pairs, entries)


def _overlapping(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """The pairs whose prefixes overlap as much as their sizes demand.

    The overlap is counted among the shared entries, at most a prefix per class.
    """
    own = entries.groupBy("node", "n").agg(F.collect_list("shingle").alias("shared"))
    met = pairs.join(own.toDF("b", "n_b", "shared_b"), "b").join(own.toDF("a", "n_a", "shared_a"), "a")
    least = _least_overlap(F.col("n_a"), F.col("n_b"))
    return met.where(F.size(F.array_intersect("shared_a", "shared_b")) >= least).select("a", "b")


def _least_overlap(n: Column, m: Column) -> Column:
    """What the prefixes of sets of sizes ``n`` and ``m`` share if the sets reach the bound.

    The sets share ``needed`` n-grams. Of the set whose prefix ends first in the common
    order, at most the n-grams after its prefix can lie outside of both prefixes.
    """
    needed = F.ceil(F.lit(PERCENT) * (n + m) / F.lit(100 + PERCENT))
    return needed - F.ceil(F.lit(PERCENT) * F.greatest(n, m) / 100) + 1


def _can_link(n: Column, m: Column, held_n: Column, held_m: Column) -> Column:
    """Whether sets of these sizes, with so many shared entries, can reach the bound."""
    near = F.lit(100) * F.least(n, m) >= F.lit(PERCENT) * F.greatest(n, m)
    return near & (_least_overlap(n, m) <= F.least(held_n, held_m))


def _mixed_blocks(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of blocks with classes that are not connected yet.

    ``root`` is the class's component, ``main`` the block's largest one. A block is
    ``crowded`` if to multiply it costs more than to count its classes' n-grams.
    """
    rooted = entries.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rooted.groupBy("shingle", "root").agg(F.count("*").alias("times"), F.sum("n").alias("n"))
    outer = F.sum("times") - F.max("times")
    blocks = (
        sizes.groupBy("shingle")
        .agg(
            F.max_by("root", F.struct("times", "root")).alias("main"),
            (outer * F.sum("times") > CROWDED * F.sum("n")).alias("crowded"),
            F.count("*").alias("parts"),
        )
        .where("parts > 1")
    )
    return rooted.join(blocks, "shingle").select("shingle", "main", "crowded", "node", "n", "held", "place", "root")


def _remaining_products(mixed: DataFrame, entries: DataFrame) -> DataFrame:
    """Pairs of classes of one block that are not connected yet and can reach the bound.

    Classes outside a block's largest component are multiplied with all others. Two
    classes that must share ``least`` of their entries share one of the first
    ``held - least + 1`` of each in the order rarest first, so later ones are left out.
    Two classes that both have ``again`` set get multiplied elsewhere.
    """
    fields = ("node", "n", "held", "place", "root", "again")
    outer = mixed.where("root <> main").select("shingle", *(F.col(name).alias(f"{name}_x") for name in fields))
    inner = mixed.select("shingle", "main", *(F.col(name).alias(f"{name}_y") for name in fields))
    least = _least_overlap(F.col("n_x"), F.col("n_y"))
    met = outer.join(inner, "shingle").where(
        (F.col("root_x") != F.col("root_y"))
        & (F.col("again_x").isNull() | F.col("again_y").isNull())
        & ((F.col("root_y") == F.col("main")) | (F.col("node_x") < F.col("node_y")))
        & _can_link(*(F.col(name) for name in ("n_x", "n_y", "held_x", "held_y")))
        & (F.col("place_x") <= F.col("held_x") - least + 1)
        & (F.col("place_y") <= F.col("held_y") - least + 1)
    )
    pairs = met.select(
        F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")
    ).distinct()
    return _overlapping(pairs, entries)


def ngram_components(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are runs of non-blank characters, A-Z in lower case. A document with fewer
    words than ``size`` has one n-gram of all of them; one without words, or a null
    text, has none, links with nothing and is its own component. ``component_id`` is
    the smallest doc_id of all that are linked, in any number of steps. A null doc_id
    takes part and gets its component's id, null if that has no other. Rows that
    repeat, with the same doc_id or not, each stay a row. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "ngram-join")
    rows, labels = link_classes(docs, scratch, size)
    return lookup(rows, labels.drop("component_key"), "key", ["doc_id"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one_per_component(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the smallest doc_id.

    Documents without words are all kept. Of rows that repeat with one doc_id one is
    kept. All columns of ``docs`` are returned as they are.
    """
    scratch = Scratch(docs.sparkSession, "ngram-keep")
    signed_rows, labels = link_classes(docs, scratch, size)
    kept = labels.where("key = component_key").select("key", F.col("component_id").alias("kept_id"), F.lit(True).alias("known"))
    stays = (F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("kept_id")) & F.col("known")
    judged = lookup(signed_rows, kept, "key", ["doc_id"], "left")
    # ids of which a row goes or several may stay; all other rows stay without a join
    open_ids = (
        judged.groupBy("doc_id")
        .agg(F.count("*").alias("rows"), F.count_if(~F.coalesce(stays, F.lit(False))).alias("gone"))
        .where("rows > 1 or gone > 0 or doc_id is null")
    )
    hashes = bitmap_table(open_ids.select(F.xxhash64("doc_id")), FILTER_BITS, scratch, "open")
    may, sure = split_by(docs.select(F.struct("*").alias("row")), F.xxhash64(F.col("row.doc_id").cast("long")), hashes, FILTER_BITS)

    def work(texts: pa.Array) -> list[pa.Array]:
        _, bounds, keys = ngram_sets(texts, size)
        return [pa.array(np.diff(bounds)), pa.array(keys, pa.binary())]

    rows = with_columns_by_piece(may.select("row.*"), work, "n_shingles long, key binary").withColumn(
        "doc_id", F.col("row.doc_id").cast("long")
    )
    found = lookup(rows, kept, "key", ["doc_id"], "left", keep_salt=True).where(stays)
    # rows without n-grams all stay, and are not gathered by their common key
    same = Window.partitionBy("key", "_salt").orderBy(F.xxhash64("row"))
    first = found.where("n_shingles > 0").withColumn("place", F.row_number().over(same)).where("place = 1")
    empty = found.where("n_shingles = 0")
    return sure.select("row.*").union(first.select("row.*")).union(empty.select("row.*"))
