"""Quality rules and classifiers: counts, bounds, held-out accuracy."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidegauge.llm import quality_classifier, quality_rules, toxicity

DOCS = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, quality int, toxic int"

EDGES = [
    (1, None, "en", "s"), (2, "", None, None), (3, "a a a a", "en", "s"), (4, "x\ny\nx\n\n\nx ", "en", "s"),
    (5, "w " * 60, "en", None), (6, " ".join(f"w{i}" for i in range(60)), None, "s"), (None, "#$ é\x1c", "", ""),
    (7, "a b c d a b c\x0bq a b c", "en", "s"), (7, "# " * 20000, "en", "s"), (8, "p q r p q r p q r p", "fr", "t"),
]


def labelled(n: int, seed: int = 1) -> tuple[list, list]:
    """Documents of which a third is junk, each kind its own way, and a tenth is toxic."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices("abcdefghijklmnop", k=chance.randint(2, 8)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(chance.randint(60, 120))]
        good, toxic = int(chance.random() > 0.33), 0
        if not good:
            words = [f"{w}$$%" for w in words] if i % 2 else [f"{w.upper()}!!" for w in words]
        elif chance.random() < 0.15:
            toxic = 1
            for bad in chance.sample([t for terms in toxicity.SEEDS.values() for t in terms], 3):
                words[chance.randrange(len(words))] = bad
        docs.append((i, " ".join(words), f"l{i % 2}", f"s{i % 5}"))
        labels.append((i, good, toxic))
    return docs, labels


def test_base_counts(spark):
    empty = spark.createDataFrame([], LABELS)
    docs = spark.createDataFrame([(*row, "clash") for row in EDGES], DOCS + ", n_words string")
    got = quality_rules.judge(docs, empty).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    key = lambda row: tuple(map(str, row))
    found = sorted(((row.doc_id, *(row[name] for name in names)) for row in got), key=key)
    assert found == sorted(((doc, *brute.base_counts(text)) for doc, text, _, _ in EDGES), key=key)
    assert all(row.kept == (not row.base_failed) for row in got)


def test_binomial_tail(spark):
    rows = [(k, n) for n in (1, 5, 40, 400, 3000) for k in (0, 1, 2, 5, 30) if k < n]
    p = 0.0125
    tail = quality_rules.binomial_tail(F.col("k"), F.col("n"), p)
    for row in spark.createDataFrame(rows, "k long, n long").withColumn("tail", tail).collect():
        exact = 1.0 if row.k >= row.n * p else brute.binomial_tail(row.k, row.n, p)
        assert row.tail == pytest.approx(exact, rel=1e-9)


def test_rules_catch_junk_and_keep_the_good(spark):
    docs, labels = labelled(2400)
    kept = {
        row.doc_id: row.kept
        for row in quality_rules.judge(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels[:1800], LABELS)).collect()
    }
    unseen = labels[1800:]
    assert all(kept[doc] for doc, good, _ in unseen if good)
    assert sum(kept[doc] for doc, good, _ in unseen if not good) < 0.02 * len(unseen)


def test_no_cutoff_without_enough_labels(spark):
    docs, labels = labelled(300)
    judged = quality_rules.judge(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert {row.kept for row in judged.collect()} == {True}


def test_kept_rows_are_whole(spark):
    docs, labels = labelled(60)
    frame = spark.createDataFrame([(*row, 1, "k") for row in [*docs, *EDGES]], DOCS + ", n_words int, kept string")
    kept = quality_rules.keep_good(frame, spark.createDataFrame(labels, LABELS))
    assert kept.columns == frame.columns
    good = [(row[0], row[1]) for row in [*docs, *EDGES] if not brute.base_counts(row[1])[-1]]
    assert sorted((row.doc_id, row.text) for row in kept.collect()) == sorted(good)


def test_classifier_on_unseen_documents(spark):
    docs, labels = labelled(1200, seed=3)
    frame = spark.createDataFrame(docs, DOCS)
    got = quality_classifier.classify(frame, spark.createDataFrame(labels[:800], LABELS), frame["source"], frame["lang"])
    kept = {row.doc_id: row.kept for row in got.collect()}
    unseen = labels[800:]
    assert sum(kept[doc] == bool(good) for doc, good, _ in unseen) >= 0.98 * len(unseen)


def test_sites_shrink_toward_their_parents(spark):
    """A bad host lowers its documents; a tiny path follows its host, not its one document."""
    rows = []
    for host, share, n in (("good", 0.95, 400), ("bad", 0.2, 400), ("middle", 0.6, 400)):
        rows += [(host, f"{host}/a", share if i % 2 else share - 0.05) for i in range(n)]
    rows.append(("bad", "bad/rare", 0.9))
    scored = spark.createDataFrame(rows, "host string, path string, p_document double")
    from tidegauge.sources.workspace import Scratch

    sites, overall, strength = quality_classifier.site_posteriors(scored, Scratch(spark, "sites"))
    host = {row.host: row.host_posterior for row in sites.collect()}
    assert host["bad"] < host["middle"] < host["good"]
    assert host["bad"] < overall < host["good"] and strength > 1


def test_classifier_edges(spark):
    frame = spark.createDataFrame([(*row, 1) for row in EDGES], DOCS + ", host int")
    none = spark.createDataFrame([(1, None, None), (None, 1, 1), (99, 1, 0)], LABELS)
    got = quality_classifier.classify(frame, none, frame["source"], frame["lang"]).collect()
    assert len(got) == len(EDGES) and all(row.kept for row in got)
    assert {row.host for row in got} == {"s", "t", "", None}
    empty = frame.limit(0)
    assert quality_classifier.classify(empty, none, empty["source"], empty["lang"]).collect() == []


def test_toxicity_on_unseen_documents(spark):
    docs, labels = labelled(1500, seed=7)
    got = toxicity.score(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels[:1000], LABELS))
    found = {row.doc_id: row for row in got.collect()}
    unseen = labels[1000:]
    assert sum(found[doc].toxic == bool(toxic) for doc, _, toxic in unseen) >= 0.99 * len(unseen)
    terms = {name: set(seeds) for name, seeds in toxicity.SEEDS.items()}
    texts = {row[0]: set(row[1].split()) for row in docs}
    for name in terms:
        right = sum((found[doc][f"p_{name}"] > 0.5) == bool(terms[name] & texts[doc]) for doc, _, _ in unseen)
        assert right >= 0.97 * len(unseen)


def test_toxicity_edges(spark):
    frame = spark.createDataFrame([(*row, True) for row in EDGES], DOCS + ", toxic boolean")
    for labels in ([], [(1, 1, None), (3, None, 0), (99, 1, 1), (None, 1, 1)], [(3, 1, 1)]):
        got = toxicity.score(frame, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == len(EDGES)
    assert toxicity.score(frame.limit(0), spark.createDataFrame([], LABELS)).collect() == []
