"""Suffix-array dedup: remove every byte of a long string that occurs somewhere else.

All strings of ``LENGTH`` bytes are judged, at every byte. Sorting all suffixes of a corpus
in one place is not possible, but equal strings have equal anchors
(:mod:`tidegauge.llm.byte_anchors`), so:

1. Count anchors. An anchor that occurs once has no repeated string around it.
2. Contexts of the others go to tasks by anchor, equal contexts as one with a count. A
   task sorts the suffixes of as many whole anchors as fit in memory
   (:mod:`tidegauge.llm.suffix_groups`), and neighbours that agree far enough give the
   repeated strings (:mod:`tidegauge.llm.window_classes`).
3. An anchor with very many different contexts, such as a common phrase in ever new
   surroundings, is not sent to one task. Its contexts are cut into strings with a like
   offset from the anchor, which have more bytes in common, and go by those bytes. At the
   last level that is the whole string, and then all contexts of a key are equal.
4. Repeated strings go back to their texts as spans. Texts are known by their digests, so
   copies are looked at once and a repeated id does no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge.llm.byte_anchors import Hashes, anchors_of
from tidegauge.llm.frames import bitmap_table, hash_bitmap, in_bitmap, lookup, split_by
from tidegauge.llm.tokens import pieces, signed, text_bytes
from tidegauge.llm.window_classes import repeated_starts
from tidegauge.operators.keyed_join import attach_by_key
from tidegauge.sources.workspace import Scratch

#: Bytes of a string that is removed if it occurs twice.
LENGTH = 200
#: Different contexts of an anchor that go to one task.
MOST_CONTEXTS = 4096
#: Bytes of contexts whose suffixes are sorted at a time, if whole anchors are shorter.
SORTED_BYTES = 1 << 19
#: Offsets from the anchor that strings of one key may have, by level after the first.
OFFSETS = (12, 1)
#: 2 ** these many bits tell anchors that may recur, and texts that may lose bytes.
ANCHOR_BITS, TEXT_BITS = 26, 24

CONTEXT = "hash long, d1 long, d2 long, place int, n long, bytes binary"


def text_digests(raw: bytes, bounds: np.ndarray) -> list[bytes]:
    """The MD5 of each text, as Spark computes it too."""
    return [hashlib.md5(raw[a:b]).digest() for a, b in zip(bounds, bounds[1:], strict=False)]


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _slices(block: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of ``block`` as binary values."""
    lengths = ends - starts
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], lengths)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(block[at])]
    ).cast(pa.binary())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and bounds of a bounded amount of text at a time."""
    for batch in batches:
        for piece in pieces(batch, batch.column("text")):
            yield text_bytes(piece.column("text"))


def _binary(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a binary column."""
    return text_bytes(values.cast(pa.large_binary()).view(pa.large_string()))


def count_anchors(texts: DataFrame) -> DataFrame:
    """``hash, n`` of the anchors of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, bounds in _pieces(batches):
            for _, anchors in anchors_of(data, bounds, LENGTH):
                hashes, counts = np.unique(anchors.hash, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(counts)], ["hash", "n"])

    return texts.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def find_contexts(texts: DataFrame, recurring: np.ndarray) -> DataFrame:
    """Contexts of anchors that may recur, and where they are.

    A context of a block of text has ``CONTEXT``'s columns, with ``n`` occurrences there.
    Its places have the text's ``digest`` and ``low, step, times``: ``times``
    contexts one after the other that begin ``step`` bytes apart. ``rows`` says how many
    rows of the block have the text; it is in one place of each.
    """
    bitmap = texts.sparkSession.sparkContext.broadcast(recurring)
    names = ["hash", "d1", "d2", "place", "n", "bytes", "digest", "low", "step", "times", "rows"]
    schema = f"{CONTEXT}, digest binary, low long, step int, times long, rows long"
    types = [pa.int64()] * 3 + [pa.int32(), pa.int64()] + [pa.binary()] * 2 + [pa.int64(), pa.int32()] + [pa.int64()] * 2

    def rows_of(columns: dict[str, pa.Array | np.ndarray], size: int) -> pa.RecordBatch:
        arrays = [
            pa.array(columns[name], kind) if name in columns and not isinstance(columns[name], pa.Array)
            else columns.get(name, pa.nulls(size, kind))
            for name, kind in zip(names, types, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, bounds in _pieces(batches):
            digests = text_digests(data.tobytes(), bounds)
            told = np.zeros(len(bounds) - 1, dtype=bool)
            for (block, begin, hashes), anchors in anchors_of(data, bounds, LENGTH):
                may = in_bitmap(bitmap.value, anchors.hash)
                text, low, high, place, hashed = (column[may] for column in anchors)
                if not len(text):
                    continue
                d1, d2 = (known.of(low, high + LENGTH) for known in (hashes, Hashes(block, 1)))
                _, first, own, n = np.unique(d1 ^ (d2 << np.uint64(1)), return_index=True, return_inverse=True, return_counts=True)
                yield rows_of(
                    {
                        "hash": signed(hashed[first]),
                        "d1": signed(d1[first]),
                        "d2": signed(d2[first]),
                        "place": place[first] - low[first],
                        "n": n,
                        "bytes": _slices(block, low[first], high[first] + LENGTH),
                    },
                    len(first),
                )
                # equal contexts that follow each other at one distance are one row
                step = np.diff(low, append=low[-1:])
                same = np.zeros(len(low), dtype=bool)
                same[1:] = (own[1:] == own[:-1]) & (text[1:] == text[:-1]) & (step[:-1] <= LENGTH)
                same[2:] &= (step[1:-1] == step[:-2]) | ~same[1:-1]
                begins = np.flatnonzero(~same)
                times = np.diff(np.append(begins, len(low)))
                new = np.ones(len(begins), dtype=bool)
                new[1:] = text[begins][1:] != text[begins][:-1]
                new &= ~told[text[begins]]
                told[text[begins]] = True
                yield rows_of(
                    {
                        "d1": signed(d1[begins]),
                        "d2": signed(d2[begins]),
                        "digest": pa.array([digests[i] for i in text[begins].tolist()], pa.binary()),
                        "low": low[begins] + begin - bounds[text[begins]],
                        "step": np.where(times > 1, step[begins], 0),
                        "times": times,
                        "rows": new.astype(np.int64),
                    },
                    len(begins),
                )

    return texts.mapInArrow(run, schema)


def merge_contexts(contexts: DataFrame) -> DataFrame:
    """Equal contexts as one, with all of their occurrences."""
    keys = ["hash", "d1", "d2", "place", "bytes"]
    return contexts.groupBy(*keys).agg(F.sum("n").alias("n")).select("hash", "d1", "d2", "place", "n", "bytes")


def _whole_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor as parts of some size, each with whole anchors."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("bytes").nbytes
        if size < SORTED_BYTES:
            continue
        all_held = joined()
        hashes = all_held.column("hash").to_numpy()
        turns = np.flatnonzero(hashes[1:] != hashes[:-1]) + 1
        lengths = np.cumsum(np.diff(_binary(all_held.column("bytes"))[1]))
        at = 0
        for turn in turns.tolist():
            if lengths[turn - 1] - (lengths[at - 1] if at else 0) >= SORTED_BYTES:
                yield all_held.slice(at, turn - at)
                at = turn
        held = [all_held.slice(at)]
        size = int(lengths[-1] - (lengths[at - 1] if at else 0))
    if held:
        yield joined()


def find_repeats(contexts: DataFrame) -> DataFrame:
    """``d1, d2, n, runs`` of contexts with strings that occur again, ``runs`` their starts.

    All contexts of an anchor must be among the rows, in a number that one task can hold.
    """
    schema = "d1 long, d2 long, n long, runs array<struct<begin: int, end: int>>"

    def work(part: pa.RecordBatch) -> pa.RecordBatch | None:
        hashes, n = part.column("hash").to_numpy(), part.column("n").to_numpy()
        _, own = np.unique(hashes, return_inverse=True)
        # an anchor that occurs once was let through by the bit table only
        part = part.filter(pa.array(np.bincount(own, weights=n)[own] > 1))
        if not part.num_rows:
            return None
        data, bounds = _binary(part.column("bytes"))
        starts, again = repeated_starts(data, bounds, part.column("n").to_numpy(), LENGTH)
        starts = starts[again]
        string = np.searchsorted(bounds, starts, side="right") - 1
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (starts[1:] != starts[:-1] + 1) | (string[1:] != string[:-1])
        begins = np.flatnonzero(new)
        ends = starts[np.append(begins[1:], len(starts)) - 1] + 1 if len(starts) else starts
        string = string[begins]
        with_runs, first = np.unique(string, return_index=True)
        runs = pa.StructArray.from_arrays(
            [pa.array((at - bounds[string]).astype(np.int32)) for at in (starts[begins], ends)], ["begin", "end"]
        )
        listed = pa.ListArray.from_arrays(pa.array(np.append(first, len(string)).astype(np.int32)), runs)
        columns = [part.column(name).take(pa.array(with_runs)) for name in ("d1", "d2", "n")]
        return pa.RecordBatch.from_arrays([*columns, listed], ["d1", "d2", "n", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_anchors(batches):
            found = work(part)
            if found is not None:
                yield found

    return contexts.repartition("hash").sortWithinPartitions("hash").mapInArrow(run, schema)


def split_contexts(contexts: DataFrame, offsets: int) -> DataFrame:
    """Contexts cut into strings whose anchor is at a like offset, by what these share.

    ``CONTEXT``'s columns, and the context ``o1, o2`` that each is from, ``begin`` bytes
    into it. Their key is a hash of the bytes common to all strings with such an offset.
    """
    names = ["hash", "d1", "d2", "place", "n", "bytes", "o1", "o2", "begin"]

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = _binary(part.column("bytes"))
        place = part.column("place").to_numpy().astype(np.int64)
        last = np.diff(bounds) - LENGTH
        lowest, highest = (place - last) // offsets, place // offsets
        n_keys = highest - lowest + 1
        own = np.repeat(np.arange(len(place)), n_keys)
        key = np.arange(len(own)) - np.repeat(np.cumsum(n_keys) - n_keys, n_keys) + lowest[own]
        begin = np.maximum(place[own] - (key + 1) * offsets + 1, 0)
        end = np.minimum(place[own] - key * offsets, last[own]) + LENGTH
        anchor = bounds[own] + place[own]
        hashes, second = Hashes(data), Hashes(data, 1)
        shared = hashes.of(anchor - key * offsets, anchor - (key + 1) * offsets + 1 + LENGTH)
        start, stop = bounds[own] + begin, bounds[own] + end
        columns = [
            pa.array(signed(shared ^ (key.astype(np.uint64) << np.uint64(48)))),
            pa.array(signed(hashes.of(start, stop))),
            pa.array(signed(second.of(start, stop))),
            pa.array((place[own] - begin).astype(np.int32)),
            part.column("n").take(pa.array(own)),
            _slices(data, start, stop),
            part.column("d1").take(pa.array(own)),
            part.column("d2").take(pa.array(own)),
            pa.array(begin.astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield work(batch.slice(at, 1024))

    return contexts.mapInArrow(run, f"{CONTEXT}, o1 long, o2 long, begin int")


def judge_contexts(contexts: DataFrame, scratch: Scratch, offsets: tuple[int, ...] = OFFSETS) -> DataFrame:
    """``d1, d2, n, runs`` as of :func:`find_repeats`, whatever the contexts of an anchor.

    ``contexts`` is a written table without equal rows.
    """
    level = len(offsets)
    often = contexts.groupBy("hash").agg(F.count("*").alias("contexts")).where(F.col("contexts") > MOST_CONTEXTS)
    often = scratch.table(often.select("hash", F.lit(True).alias("often")), f"often-{level}")
    if not offsets or often.isEmpty():
        return find_repeats(contexts)
    marked = lookup(contexts, often, "hash", ["d1", "d2"], "left")
    few = scratch.table(find_repeats(marked.where("often is null").drop("often")), f"few-{level}")
    parts = scratch.table(split_contexts(marked.where("often").drop("often"), offsets[0]), f"parts-{level}")
    merged = scratch.table(merge_contexts(parts), f"merged-{level}")
    below = scratch.table(judge_contexts(merged, scratch, offsets[1:]), f"below-{level}")
    scratch.drop(f"merged-{level}")
    own = F.transform(
        "runs", lambda run: F.struct((run["begin"] + F.col("begin")).alias("begin"), (run["end"] + F.col("begin")).alias("end"))
    )
    found = attach_by_key(parts.drop("n", "bytes"), below, ["d1", "d2"], "n", stored=True)
    many = (
        found.where("runs is not null")
        .select("o1", "o2", F.explode(own).alias("run"))
        .groupBy("o1", "o2")
        .agg(F.collect_list("run").alias("runs"))
    )
    many = contexts.select("d1", "d2", "n").join(many.toDF("d1", "d2", "runs"), ["d1", "d2"])
    return few.unionByName(scratch.table(many, f"many-{level}"))


def merge_spans(spans: DataFrame) -> DataFrame:
    """Spans of each row's ``spans`` that overlap or touch as one, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("spans")
            row = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy())
            begin, end = (listed.flatten().field(name).to_numpy() for name in ("begin", "end"))
            order = np.lexsort((begin, row))
            row, begin, end = row[order], begin[order], end[order]
            # ends of different rows never meet if each row's are shifted past the last one's
            shift = row * (int(end.max(initial=0)) + 1)
            reach = np.maximum.accumulate(end + shift) if len(end) else end
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | ((begin + shift)[1:] > reach[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(row)) - 1 if len(first) else first
            bounds = np.searchsorted(row[first], np.arange(len(listed) + 1)).astype(np.int32)
            merged = pa.StructArray.from_arrays(
                [pa.array(begin[first]), pa.array((reach - shift)[last])], ["begin", "end"]
            )
            at = batch.schema.get_field_index("spans")
            columns = list(batch.columns)
            columns[at] = pa.ListArray.from_arrays(pa.array(bounds), merged)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return spans.mapInArrow(run, spans.schema)


def repeated_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``digest, rows, spans`` of each text with bytes to remove, as a written table.

    ``rows`` is the number of documents that have the text.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"))
    anchors = count_anchors(texts)
    recurring = hash_bitmap(anchors.where("n > 1"), "hash", ANCHOR_BITS)
    found = scratch.table(find_contexts(texts, recurring), "found")
    fields = [field.split()[0] for field in CONTEXT.split(", ")]
    contexts = scratch.table(merge_contexts(found.where("bytes is not null").select(*fields)), "contexts")
    judged = scratch.table(judge_contexts(contexts, scratch), "judged")
    scratch.drop("contexts")

    places = found.where("digest is not null").select("d1", "d2", "digest", "low", "step", "times", "rows")
    hits = attach_by_key(places, judged, ["d1", "d2"], "n", stored=True)
    reach = F.col("low") + (F.col("times") - 1) * F.col("step") + LENGTH - 1
    spans = F.transform(
        "runs",
        lambda run: F.struct((F.col("low") + run["begin"]).alias("begin"), (reach + run["end"]).alias("end")),
    )
    listed = (
        hits.where("runs is not null or rows > 0")
        .select("digest", "rows", F.explode_outer(spans).alias("span"))
        .groupBy("digest")
        .agg(F.sum("rows").alias("rows"), F.collect_set("span").alias("spans"))
        .where(F.size("spans") > 0)
    )
    merged = scratch.table(merge_spans(listed), "spans")
    scratch.drop("found", "judged")
    return merged


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` as ``row``, and what is left of each text's UTF-8 bytes.

    ``row`` holds all columns of a document, whatever their names; ``n_bytes``; ``spans``
    the removed bytes as sorted ``begin, end``; ``kept`` the others, which may end within
    a character. A byte goes if some string of ``LENGTH`` bytes around it begins anywhere
    else too, in the same text or another; matches end with their text. A null text is an
    empty one, and texts shorter than ``LENGTH`` stay whole. A repeated row is one more
    text, so it repeats all of its strings. A text of any length is hashed in blocks.
    Contexts count as equal by 128-bit and parts of strings by 64-bit hashes.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    spans = repeated_spans(docs, scratch)
    text = F.col("row.text").cast("string")
    rows = docs.select(F.struct("*").alias("row")).withColumn("digest", _digest(F.col("row.text")))
    # only texts that may lose bytes are shuffled, and looked at again
    marks = bitmap_table(spans.select(F.xxhash64("digest")), TEXT_BITS, scratch, "marks")
    may, others = split_by(rows, F.xxhash64("digest"), marks, TEXT_BITS)
    whole = F.coalesce(text, F.lit("")).cast("binary")
    kept = others.select(
        "row",
        F.octet_length(whole).cast("long").alias("n_bytes"),
        F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"),
        whole.alias("kept"),
    )
    return kept.unionByName(_cut(attach_by_key(may, spans, ["digest"], "rows", stored=True).select("row", "spans")))


def _cut(rows: DataFrame) -> DataFrame:
    """Texts without the bytes of their spans."""
    schema = StructType([rows.schema["row"]]).add("n_bytes", "long").add(rows.schema["spans"]).add("kept", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("row").field("text").cast(pa.string()))
            raw, spans = data.tobytes(), batch.column("spans").to_pylist()
            kept = []
            for i, own in enumerate(spans):
                at, parts = bounds[i], []
                for span in own or []:
                    parts.append(raw[at : bounds[i] + span["begin"]])
                    at = bounds[i] + span["end"]
                kept.append(b"".join([*parts, raw[at : bounds[i + 1]]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(bounds)), batch.column("spans"), pa.array(kept, pa.binary())],
                schema.fieldNames(),
            )

    return rows.mapInArrow(run, schema)


def removal_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row of ``docs``."""
    lengths = F.transform(F.coalesce("spans", F.array()), lambda span: span["end"] - span["begin"])
    return remove_repeats(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda total, length: total + length).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
