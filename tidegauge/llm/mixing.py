"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight that changes linearly over training time 0 to 1. Its
integral, scaled to the source's target, is the demand for the source's words up to a
time. A word at place ``x`` of the source's stream is due when demand reaches ``x``;
inverting the demand turns places into times, and the times order the corpus.

A source's stream repeats its documents, in an order by digest, until the target is
reached; the pass that reaches it ends there, in the middle of a document if need be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import lookup
from tidegauge.llm.ordering import running_totals
from tidegauge.sources.workspace import Scratch

#: A source gives at most so many times its own words.
MOST_PASSES = 3
#: Weights 1, 2, 3, repeating by the sources' order.
CYCLE = 3
#: How the weight of a source changes from time 0 to 1, by its weight: the lightest
#: sources fade to half their start, the heaviest double.
START = (1.0, 1.0, 1.0)
END = (0.5, 1.0, 2.0)


def word_count(text: Column) -> Column:
    """Words of non-blank characters: blanks are space and the control characters 9 to 13."""
    plain = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(
        F.size(F.filter(F.split(plain, " +"), lambda word: word != "")).cast("long"), F.lit(0).cast("long")
    )


def source_targets(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """``source, rank, weight, source_size, target``, one row per source, null last.

    Targets share the words of all documents by weight; one that would exceed
    ``MOST_PASSES`` times its source's words stops there, and the excess is shared
    again until none does. Each round is one aggregate of one row.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "one", F.lit(1).cast("long")
    )
    totals = scratch.table(
        totals.withColumn("last", F.col("source").isNull().cast("int")).withColumn("all", F.lit(0).cast("long")),
        "totals",
    )
    ranked = running_totals(totals, "all", ["last", "source"], "one", scratch, "ranks")
    sources = scratch.table(
        ranked.select(
            "source",
            F.col("before").alias("rank"),
            (F.col("before") % CYCLE + 1).alias("weight"),
            "source_size",
        ),
        "sources",
    )
    words, weights = (value or 0 for value in sources.agg(F.sum("source_size"), F.sum("weight")).first())
    most = F.col("source_size") * MOST_PASSES
    left, share = words, weights
    while share:
        above = sources.where(most * F.lit(share) < F.col("weight") * F.lit(left))
        full, heavy = (value or 0 for value in above.agg(F.sum(most), F.sum("weight")).first())
        if (words - full, weights - heavy) == (left, share):
            break
        left, share = words - full, weights - heavy
    by_weight = F.col("weight") * F.lit(float(left)) / F.lit(float(share or 1))
    return sources.withColumn("target", F.least(by_weight, most.cast("double")))


def _due(place: Column, words: Column, start: Column, end: Column) -> Column:
    """The time at which a source's demand reaches ``place`` of its ``words``.

    The weight runs from ``start`` to ``end``, so demand is a parabola; this is its
    inverse in the form that also holds where both are equal.
    """
    done = place / words * (start + end)
    return done / (start + F.sqrt(start * start + (end - start) * done))


def _reached(time: Column, start: float, end: float) -> Column:
    """The share of a source's demand that is due before ``time``."""
    return (2 * start * time + (end - start) * time * time) / (start + end)


def _by_weight(values: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*(F.lit(value) for value in values)), F.col("weight").cast("int"))


def _placed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Each document with its source's target and the words before it in a pass."""
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "source"))
    sizes = scratch.table(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text").cast("string")).alias("size"),
        ).withColumn("key", key),
        "sizes",
    )
    sources = scratch.table(source_targets(sizes, scratch).withColumn("key", key).drop("source"), "targets")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    known = scratch.table(
        lookup(sizes, sources, "key", ["doc_id"]).drop("key").withColumn("digest", digest), "known"
    )
    placed = running_totals(known, "rank", ["digest", "size"], "size", scratch, "placed")
    scratch.drop("sizes", "totals", "ranks", "sources")
    return placed.drop("digest").withColumn("words", F.floor(F.col("target") + 0.5))


def _timed(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Add ``time`` and ``position`` of the word at ``place`` of the source's stream."""
    shares = placed.groupBy("rank", "weight").agg(F.first("words").alias("words"))
    demand = {row[0]: row[1] for row in shares.groupBy("weight").agg(F.sum("words")).collect()}
    time = _due(F.col("place"), F.col("words"), _by_weight(START), _by_weight(END))
    reached = sum(
        (
            F.lit(float(demand.get(weight, 0))) * _reached(F.col("time"), START[weight - 1], END[weight - 1])
            for weight in range(1, CYCLE + 1)
        ),
        F.lit(0.0),
    )
    return rows.withColumn("time", time).withColumn("position", F.floor(reached + 0.5))


#: A document comes up if the source's target goes beyond the words before it in the first pass.
COMES_UP = "size > 0 and words > before"


def _passes(placed: DataFrame) -> DataFrame:
    """One row for each time that a document comes up: ``pass``, ``place`` and the words ``taken``."""
    passes = F.expr("(words - before + source_size - 1) div source_size")
    return (
        placed.where(COMES_UP)
        .withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), passes)))
        .withColumn("place", (F.col("pass") - 1) * F.col("source_size") + F.col("before"))
        .withColumn("taken", F.least("size", F.col("words") - F.col("place")))
    )


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: what the schedule takes of it, and when, in training order.

    ``doc_id, source, size, source_size, target, taken`` in words; ``passes``, the
    number of times the document comes up; ``time``, from 0 to 1, when it first does,
    and ``position``, the words of the whole mix due before then, both null where
    nothing is taken. All of it is added up from the rows of the schedule. The result is
    sorted by position over ranges; documents of which nothing is taken come last, by
    id. A null or empty text has size 0 and is never taken. A null source is a source of
    its own, ordered last; a null doc_id goes with an empty one. Rows that repeat count
    each time. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    placed = _placed(docs, scratch)
    known = ["doc_id", "source", "size", "source_size", "target"]
    # Documents with words differ in the words before them, so no two rows fall together.
    coming = (
        _timed(_passes(placed), placed)
        .groupBy("rank", "before", *known)
        .agg(
            F.sum("taken").alias("taken"),
            F.count("pass").alias("passes"),
            F.min("time").alias("time"),
            F.min("position").alias("position"),
        )
        .drop("rank", "before")
    )
    none = F.lit(0).cast("long")
    never = placed.where(f"not ({COMES_UP})").select(
        *known, none, none, F.lit(None).cast("double"), F.lit(None).cast("long")
    )
    return coming.union(never).orderBy(F.col("position").asc_nulls_last(), "doc_id", "source")


def schedule(docs: DataFrame) -> DataFrame:
    """The mix in training order: one row for each time that a document comes up.

    ``doc_id, source, pass, words, time, position``, sorted by position over ranges.
    ``words`` is the document's size but for the one document at which its source
    reaches the target. Nulls, empty texts and repeated rows go as in :func:`mix`.
    """
    scratch = Scratch(docs.sparkSession, "schedule")
    placed = _placed(docs, scratch)
    return (
        _timed(_passes(placed), placed)
        .select("doc_id", "source", "pass", F.col("taken").alias("words"), "time", "position")
        .orderBy("position", "doc_id", "pass")
    )
