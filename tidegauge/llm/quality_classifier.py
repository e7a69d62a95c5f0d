"""Quality by hierarchical empirical Bayes: document, path and host.

A linear classifier gives each document a probability of its own. Documents belong to a
path and paths to a host. The good share of a path has a beta prior around its host's,
and that of a host one around the share of all documents. How strong these priors are
comes from the data: the more the shares of sites differ beyond what their numbers of
documents explain, the weaker. A site with few documents therefore stays near its
parent, and sites that do not differ are all alike.

The posterior odds of a document are its own odds, times those of its path (without the
document itself) over those of all documents. All site figures are grouped sums.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import linear
from tidegauge.llm.frames import as_texts, by_piece, lookup
from tidegauge.llm.tokens import hash_words, shingles, split_words, text_bytes
from tidegauge.sources.workspace import Scratch

#: Labelled documents that the classifier is fitted on at most: those of smallest hash.
TRAIN_ROWS = 20_000
#: Prior documents of a site at most; reached where sites do not differ at all.
STRONGEST = 1e6
#: Probabilities are kept this far from 0 and 1.
EDGE = 1e-6
#: Documents below this posterior are rejected.
LEAST = 0.5

#: Character classes whose shares of a text are features.
CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "symbols": b"#*$%&|<>{}[]\\^~@=_+/",
    "marks": b"!?",
    "stops": b".,;:",
    "blanks": b" \t\r\x0b\x0c",
    "breaks": b"\n",
}
FEATURES = (*CLASSES, "non_ascii", "words", "word_length", "distinct_words", "repeated_runs")


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def _counts(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(bounds) - 1, dtype=np.int64)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        total[some] = np.add.reduceat(mask, bounds[some], dtype=np.int64)
    return total


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; all 0 for one without words."""
    data, bounds = text_bytes(texts)
    words = split_words(data, bounds)
    hashes = hash_words(words)
    n = np.diff(words.first)
    size = np.maximum(np.diff(bounds), 1)
    columns = []
    for characters in CLASSES.values():
        table = np.zeros(256, dtype=np.uint8)
        table[list(characters)] = 1
        columns.append(_counts(table[data], bounds) / size)
    columns.append(_counts((data >= 192).view(np.uint8), bounds) / size)
    length = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    many = np.maximum(n, 1)
    columns += [np.log1p(n), np.diff(length[words.first]) / many]
    runs, at = shingles(hashes, words.first, 3)
    columns.append(np.array([len(np.unique(hashes[a:b])) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]) / many)
    distinct = np.array([len(np.unique(runs[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)])
    columns.append(1 - distinct / np.maximum(np.diff(at), 1))
    out = np.column_stack(columns).astype(float)
    out[n == 0] = 0
    return out


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """The document classifier, from a bounded sample of the labelled documents."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows = features(piece.column("text"))
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), piece.column("quality"), pa.array(list(rows), pa.list_(pa.float64()))],
            ["doc_id", "quality", "features"],
        )

    # at most TRAIN_ROWS pairs of an id and a label are sent to the texts
    sample = by_piece(
        as_texts(docs).join(F.broadcast(known), "doc_id"),
        ["doc_id", "quality", "text"],
        work,
        "doc_id long, quality int, features array<double>",
    )
    table = sample.dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    x = np.array(table.column("features").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = table.column("quality").to_numpy().astype(float)
    if not len(y):
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES) + 1))
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    return Model(mean, scale, linear.fit((x - mean) / scale, y))


def document_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, host, path, p_document`` of every row of ``doc_id, host, path, text``."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        model = Model(*sent.value)
        p = linear.predict((features(piece.column("text")) - model.mean) / model.scale, model.weights)
        kept = ["doc_id", "host", "path"]
        return pa.RecordBatch.from_arrays(
            [*(piece.column(name) for name in kept), pa.array(np.clip(p, EDGE, 1 - EDGE))], [*kept, "p_document"]
        )

    return by_piece(
        docs, ["doc_id", "host", "path", "text"], work, "doc_id long, host string, path string, p_document double"
    )


def _strength(sites: DataFrame, parent: str) -> float:
    """Prior documents of a site, by the method of moments.

    A site's share differs from its parent's by chance, ``m (1 - m) / n``, and by the
    spread between sites; what is left of the squared differences after the first is
    the second. Sites weigh by their documents. One row reaches the driver.
    """
    m, n = F.col(parent), F.col("n")
    chance = m * (1 - m)
    squares, by_chance, all_chance, total = (
        sites.where("n > 0")
        .agg(
            F.sum(n * (F.col("good") / n - m) * (F.col("good") / n - m)),
            F.sum(chance),
            F.sum(n * chance),
            F.sum(n),
        )
        .first()
    )
    if not total:
        return STRONGEST
    between = max(0.0, (squares - by_chance) / total)
    if between <= 0:
        return STRONGEST
    return min(STRONGEST, max(0.0, all_chance / total / between - 1))


def _logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(safe / (1 - safe))


def site_posteriors(scored: DataFrame, scratch: Scratch) -> tuple[DataFrame, float, float]:
    """``host, path, n, good, host_posterior`` per path, the overall share, and the path prior's strength."""
    paths = scratch.table(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_document").alias("good")), "paths"
    )
    n, good = paths.agg(F.sum("n"), F.sum("good")).first()
    overall = good / n if n else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    hosts = scratch.table(hosts.withColumn("overall", F.lit(float(overall))), "hosts")
    strength = _strength(hosts, "overall")
    hosts = hosts.select(
        "host", ((F.col("good") + strength * overall) / (F.col("n") + strength)).alias("host_posterior")
    )
    known = scratch.table(paths.join(hosts, "host"), "known")
    return known, float(overall), _strength(known, "host_posterior")


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """Each row's own probability of being good, its sites' and the posterior.

    ``doc_id, host, path, p_document, host_posterior, path_posterior, posterior, kept``.
    A null host or path is a site of its own, written as an empty one is not: null. A
    null or empty text has no features but gets a probability, as its sites do. Labels
    that are null or not 0 or 1 are left out; a document labelled both ways counts as
    bad. Without labels every probability is one half and all rows are kept. Rows that
    repeat each give a row, and each counts for its sites. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality-classifier")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("")).alias("host"),
        F.coalesce(F.concat(F.lit("="), path.cast("string")), F.lit("")).alias("path"),
        F.col("text").cast("string").alias("text"),
    )
    scored = scratch.table(document_scores(own, fit(docs, labels)), "scored").withColumn(
        "site", F.concat_ws("\x01", "host", "path")
    )
    sites, overall, strength = site_posteriors(scored, scratch)
    few = sites.select(F.concat_ws("\x01", "host", "path").alias("site"), "n", "good", "host_posterior")
    found = lookup(scored, few, "site", ["doc_id"])
    rest = (F.col("good") - F.col("p_document") + strength * F.col("host_posterior")) / (F.col("n") - 1 + strength)
    evidence = F.when(F.col("n") - 1 + strength > 0, rest).otherwise(F.col("host_posterior"))
    odds = _logit(F.col("p_document")) + _logit(F.col("path_posterior")) - _logit(F.lit(overall))
    name = lambda column: F.when(F.col(column) != "", F.substring(column, 2, 1 << 30)).alias(column)
    return (
        found.withColumn("path_posterior", evidence)
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .select(
            "doc_id",
            name("host"),
            name("path"),
            "p_document",
            "host_posterior",
            "path_posterior",
            "posterior",
            (F.col("posterior") >= LEAST).alias("kept"),
        )
    )
