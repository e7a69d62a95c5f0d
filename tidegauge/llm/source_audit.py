"""Source divergence audit: which terms set a source apart, and how far sources differ.

Terms are packed, sorted and counted in each task (:mod:`tidegauge.llm.packed_terms`),
then added up over all texts. Each source of a language, and the language as a whole,
gives every kept term a share in whole billionths, with one count added to each, and the
divergence of two shares is ``(p - q)^2 / q``, rounded down. All of it is integers.

Two sources are compared over all kept terms, although most terms are absent from most
sources: where both counts are zero the divergence is the same for every such term, so
only terms that one of the two has are gone through, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.frames import by_piece, lookup
from tidegauge.llm.packed_terms import count_terms
from tidegauge.sources.workspace import Scratch

#: Shares are whole multiples of one part in this.
UNIT = 1_000_000_000
#: Documents of a language that a kept term is in, at least.
LEAST_DOCS = 3
#: Ranks of terms that are reported.
TOP_TERMS = 200
#: Counted terms that are compared in one block.
BLOCK = 1 << 16
#: Pairs of sources whose sums a task holds before it hands them on.
HELD = 1 << 20


def count_by_source(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with the term.

    Every language and source that occurs also has a row with a null term.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        names = pa.table({"lang": piece.column("lang"), "source": piece.column("source")})
        sites = names.group_by(["lang", "source"]).aggregate([])
        sites = sites.append_column("group", pa.array(np.arange(sites.num_rows)))
        group = np.empty(piece.num_rows, dtype=np.int64)
        own = names.append_column("row", pa.array(np.arange(piece.num_rows))).join(sites, ["lang", "source"])
        group[own["row"].to_numpy()] = own["group"].to_numpy()
        parts = list(count_terms(piece.column("text"), group))
        zeros, every = np.zeros(sites.num_rows, dtype=np.int64), np.arange(sites.num_rows)
        terms = pa.chunked_array([pa.nulls(len(every), pa.string()), *(part.term for part in parts)])
        at = pa.array(np.concatenate([every, *(part.group for part in parts)]))
        return pa.RecordBatch.from_arrays(
            [
                sites["lang"].combine_chunks().take(at),
                sites["source"].combine_chunks().take(at),
                pa.concat_arrays(terms.chunks),
                pa.array(np.concatenate([zeros, *(part.n for part in parts)])),
                pa.array(np.concatenate([zeros, *(part.texts for part in parts)])),
            ],
            ["lang", "source", "term", "n", "docs"],
        )

    columns = ["text", "lang", "source"]
    texts = docs.select(*(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in columns))
    parts = by_piece(texts, columns, work, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """``1 + floor(UNIT (n + 1) / (total + terms))``, exact for any long counts."""
    n, total, terms = (F.col(x) if isinstance(x, str) else x for x in (n, total, terms))
    whole = ((n + 1).cast("decimal(20)") * F.lit(UNIT).cast("decimal(10)")).alias("whole")
    parts = (total.cast("decimal(19)") + terms.cast("decimal(19)")).cast("decimal(20)")
    return F.call_function("div", whole, parts) + 1


def divergence(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def keep_terms(counts: DataFrame) -> DataFrame:
    """The counts of terms in enough documents of their language.

    With ``lang_n``, the term's occurrences in the language, and ``is_first`` at one of
    its sources.
    """
    of_term = Window.partitionBy("lang", "term")
    return (
        counts.where("term is not null")
        .withColumn("lang_docs", F.sum("docs").over(of_term))
        .withColumn("lang_n", F.sum("n").over(of_term))
        .withColumn("is_first", (F.row_number().over(of_term.orderBy("source")) == 1).cast("long"))
        .where(F.col("lang_docs") >= LEAST_DOCS)
        .select("lang", "source", "term", "n", "lang_n", "is_first")
    )


def count_sites(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Each language and source: its number in the language and its sums over kept terms.

    ``site, lang, source, ix, total, lang_total, terms, entries``, and ``p_none``, the
    share of a kept term that the source lacks (null if the language keeps no term).
    """
    sites = counts.where("term is null").select("lang", "source")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.sum("is_first").alias("terms"), F.count("*").alias("entries")
    )
    numbers = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return (
        sites.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "lang_total", "terms", "entries"])
        .withColumn("ix", numbers)
        .withColumn("p_none", F.when(F.col("terms") > 0, share(F.lit(0), "total", "terms")))
        .select(F.struct("lang", "source").alias("site"), "*")
    )


def score_terms(kept: DataFrame, sites: DataFrame) -> DataFrame:
    """``lang, source, term, ix, entries, p, q`` of each counted term."""
    rows = kept.withColumn("site", F.struct("lang", "source"))
    found = lookup(rows, sites.drop("lang", "source", "p_none"), "site", ["term"])
    return found.select(
        "lang",
        "source",
        "term",
        "ix",
        "entries",
        share("n", "total", "terms").alias("p"),
        share("lang_n", "lang_total", "terms").alias("q"),
    )


def top_terms(scored: DataFrame) -> DataFrame:
    """The terms that a source has most above its language."""
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        scored.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= TOP_TERMS)
    )


class _Sums:
    """Sums over pairs of sources, one row of numbers per first source."""

    def __init__(self) -> None:
        self.rows: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        self.held = 0

    def row(self, lang: str, first: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        if (lang, first) not in self.rows:
            self.rows[lang, first] = (np.zeros(size, np.int64), np.zeros(size, np.int64))
            self.held += size
        return self.rows[lang, first]

    def drain(self) -> Iterator[pa.RecordBatch]:
        for (lang, first), (sums, counted) in self.rows.items():
            second = np.flatnonzero(counted)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(second), pa.string()),
                    pa.array(np.full(len(second), first, dtype=np.int32)),
                    pa.array(second.astype(np.int32)),
                    pa.array(sums[second]),
                    pa.array(counted[second]),
                ],
                ["lang", "first", "second", "sum", "counted"],
            )
        self.rows, self.held = {}, 0


def _add_block(sums: _Sums, lang: str, none: np.ndarray, term: np.ndarray, ix: np.ndarray, p: np.ndarray) -> None:
    """Add the divergences of all pairs of sources in which one has a term of the block.

    ``none`` holds each source's share of an absent term; ``term, ix, p`` are the block's
    counts, by term. Terms are taken a bounded number of shares at a time.
    """
    size = len(none)
    n_terms = int(term[-1]) + 1
    at_once = max(1, (1 << 20) // size)
    for begin in range(0, n_terms, at_once):
        low, high = np.searchsorted(term, [begin, begin + at_once])
        rows, cells, shares = term[low:high] - begin, ix[low:high], p[low:high]
        table = np.repeat(none[None, :], min(at_once, n_terms - begin), axis=0)
        table[rows, cells] = shares
        has = np.zeros(table.shape, dtype=bool)
        has[rows, cells] = True
        for first in np.unique(cells):
            with_term = has[:, first]
            others, lacks = table[with_term], ~has[with_term]
            own = others[:, first, None]
            gap = (own - others) ** 2
            total, counted = sums.row(lang, int(first), size)
            total += (gap // others).sum(axis=0)
            counted += len(others)
            back, missing = (gap // own * lacks).sum(axis=0), lacks.sum(axis=0)
            for second in np.flatnonzero(missing):
                total, counted = sums.row(lang, int(second), size)
                total[first] += back[second]
                counted[first] += missing[second]


def pair_sums(scored: DataFrame, sites: DataFrame) -> DataFrame:
    """``lang, first, second, sum, counted`` over the terms that one of two sources has."""
    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("entries") / BLOCK)).alias("block")
    blocks = (
        scored.select("lang", block, F.struct("term", "ix", "p").alias("entry"))
        .groupBy("lang", "block")
        .agg(F.collect_list("entry").alias("entries"))
    )
    shares = sites.where("terms > 0").groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("ix", "p_none"))).alias("shares")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in batches:
            for i in range(batch.num_rows):
                none = batch.column("shares")[i].values.field("p_none").to_numpy()
                entries = batch.column("entries")[i].values
                term = entries.field("term").dictionary_encode().indices.to_numpy()
                order = np.argsort(term, kind="stable")
                ix, p = entries.field("ix").to_numpy(), entries.field("p").to_numpy()
                _add_block(sums, batch.column("lang")[i].as_py(), none, term[order], ix[order], p[order])
                if sums.held > HELD:
                    yield from sums.drain()
        yield from sums.drain()

    schema = "lang string, first int, second int, sum long, counted long"
    parts = lookup(blocks, shares, "lang", ["block"]).select("lang", "shares", "entries")
    return (
        parts.mapInArrow(run, schema)
        .groupBy("lang", "first", "second")
        .agg(F.sum("sum").alias("sum"), F.sum("counted").alias("counted"))
    )


def rank_pairs(sums: DataFrame, sites: DataFrame) -> DataFrame:
    """How far each source's shares are from those of each other source of its language."""
    one = sites.select("lang", "source", F.col("ix").alias("first"), "terms", F.col("p_none").alias("p"))
    other = sites.select("lang", F.col("source").alias("item"), F.col("ix").alias("second"), F.col("p_none").alias("q"))
    absent = (F.col("terms") - F.coalesce("counted", F.lit(0))) * divergence("p", "q")
    value = F.when(F.col("terms") > 0, F.coalesce("sum", F.lit(0)) + absent).otherwise(0)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        one.join(other, "lang")
        .where("first != second")
        .join(sums, ["lang", "first", "second"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
    )


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` of pairs of sources and of terms.

    ``pair`` rows give each other source of the language and the sum of divergences over
    all kept terms; ``term`` rows the first ``TOP_TERMS`` terms that the source has more
    than its language, by their divergence. Ranks go by value, largest first, then item.
    Null texts, languages and sources are empty ones; a repeated row is one more document;
    other columns are ignored; no documents give no rows. A language without kept terms
    has pairs of value 0. The rows of pairs are as many as the result holds by its
    definition: the square of a language's number of sources.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    counts = scratch.table(count_by_source(docs), "counts")
    kept = scratch.table(keep_terms(counts), "kept")
    sites = scratch.table(count_sites(counts, kept), "sites")
    scored = scratch.table(score_terms(kept, sites), "scored")
    scratch.drop("counts", "kept")
    return rank_pairs(pair_sums(scored, sites), sites).unionByName(top_terms(scored))
