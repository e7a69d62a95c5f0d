"""N-gram Jaccard join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidegauge.llm import ngram_join

SCHEMA = "doc_id long, text string"


def copies(seed: int) -> list[tuple]:
    """Random texts, edited copies of them, and a passage that many share."""
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = chance.choices(vocabulary, k=12)
    rows: list[tuple] = []
    for _ in range(12):
        base = chance.choices(vocabulary, k=chance.randint(8, 120))
        if chance.random() < 0.5:
            base[3:3] = passage
        for _ in range(chance.randint(1, 9)):
            text = list(base)
            for _ in range(chance.choice((0, 0, 1, 1, 2, 4))):
                text[chance.randrange(len(text))] = chance.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    chance.shuffle(rows)
    return rows


EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "a b"),
    (None, "a b"), (None, None), (9, "x " * 5000), (10, "x " * 4000), (9, "x " * 5000),
    (11, "É é É é É"), (12, "é é é é é"), (13, "1 2 3 4 5\x1c6"), (14, "1 2 3 4 5\x1c6 "),
]


@pytest.mark.parametrize("rows", [copies(1), copies(2), EDGES, []], ids=["random", "other", "edges", "empty"])
def test_components(spark, rows):
    got = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA).repartition(3))
    key = lambda row: tuple((x is None, x or 0) for x in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute.components(rows), key=key)


def test_chain_through_edited_copies(spark):
    """Copies of copies are one group though the ends are unlike."""
    texts, words = [], [f"t{i}" for i in range(100)]
    for step in range(8):
        words = list(words)
        words[step * 11] = f"n{step}"
        texts.append((step, " ".join(words)))
    got = {row.doc_id: row.component_id for row in ngram_join.ngram_components(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert set(got.values()) == {0}


def test_keep_one(spark):
    rows = copies(3)
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, n_shingles int")
    kept = ngram_join.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    expected = {component for _, _, component in brute.components(rows)}
    assert sorted(row.doc_id for row in kept.collect()) == sorted(expected)


def test_keep_one_edges(spark):
    kept = ngram_join.keep_one_per_component(spark.createDataFrame(EDGES, SCHEMA)).collect()
    found = sorted(((row.doc_id is None, row.doc_id or 0), row.text or "") for row in kept)
    assert [i for (_, i), _ in found] == [1, 2, 3, 4, 6, 9, 11, 12, 13, 0]
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.keep_one_per_component(empty).collect() == []


def leading_grams(text: str) -> dict[int, int]:
    """The hashes and places of a text's prefix in hash order."""
    values, _, _ = ngram_join.ngram_sets(pa.array([text]))
    length = int(ngram_join.prefix_length(np.array([len(values)]))[0])
    words = text.split()
    places = {
        int(ngram_join.ngram_sets(pa.array([" ".join(words[i : i + 5])]))[0][0]): i for i in range(len(words) - 4)
    }
    return {int(value): places[int(value)] for value in values[:length]}


def test_pair_that_meets_only_foreign_centers(spark):
    """Each n-gram that the pair is indexed under also lies in a text that meets more others."""
    words = [f"t{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "other"]))]
    for number, (value, place) in enumerate(leading_grams(rows[0][1]).items()):
        hub = [f"h{number}x{i}" for i in range(44)]
        for copy in range(7):
            for turn in range(1000):
                tail = [f"u{number}y{copy}y{turn}z{i}" for i in range(11)]
                text = " ".join([*hub, *(words[place : place + 5] if copy == 0 else tail[:5]), *tail])
                if copy or value in leading_grams(text):
                    break
            rows.append((len(rows) + 1, text))
    got = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect())) == sorted(brute.components(rows))


@pytest.mark.parametrize("pieces", [1, 300])
def test_form_letters_do_not_meet_all_others(spark, pieces, monkeypatch):
    """Texts with 40 words in common and 20 of their own: no pair is similar, few are compared."""
    seen = []
    compared = ngram_join._linked

    def counted(pairs, sets):
        seen.append(pairs.count())
        return compared(pairs, sets)

    monkeypatch.setattr(ngram_join, "_linked", counted)
    form = [f"f{i}" for i in range(40)]
    rows = [(i, " ".join([*form, *(f"o{i}x{j}" for j in range(20))])) for i in range(300)]
    rows += [(300 + i, " ".join([*form, *(f"o{i}x{j}" for j in range(19)), "last"])) for i in range(0, 300, 50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000 if pieces == 1 else 1)
    try:
        got = ngram_join.ngram_components(docs.repartition(4) if pieces > 1 else docs.coalesce(1))
        assert sorted(map(tuple, got.collect())) == sorted(brute.components(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(seen) < 10 * len(rows)


@pytest.mark.parametrize("seed", [2, 4])
def test_crowded_blocks_lose_no_link(spark, monkeypatch, seed):
    """Every block counts as crowded, so all links between components come from the second index."""
    monkeypatch.setattr(ngram_join, "CROWDED", 0)
    monkeypatch.setattr(ngram_join, "_first_products", _no_pairs)
    rows = copies(seed)
    got = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(brute.components(rows))


def _no_pairs(entries):
    return entries.selectExpr("node as a", "node as b").where("false")
