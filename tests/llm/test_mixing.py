"""Source mix: targets, what is taken, and the order."""

from collections import Counter

import pytest

from tests.llm import brute
from tidegauge.llm import mixing

SCHEMA = "doc_id long, source string, text string"
ROWS = [(i, f"s{i % 5}", "w " * (i % 17)) for i in range(120)] + [
    (200, None, "a b c"), (201, None, None), (None, "s1", "x y"), (None, "s1", "x y"),
    (3, "s3", "w w w"), (202, "", "z"), (203, "é", "q " * 900), (204, "Z", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


def test_targets(docs):
    sizes = Counter()
    for _, source, text in ROWS:
        sizes[source] += len(brute.words(text))
    expected = brute.targets(sizes)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        assert row.target == pytest.approx(expected[row.source], rel=1e-12)
        assert row.source_size == sizes[row.source]
        assert 0 <= row.taken <= 3 * row.size
    taken = Counter()
    for row in rows:
        taken[row.source] += row.taken
    assert all(abs(taken[source] - expected[source]) <= 0.5 for source in sizes)


def test_reruns_agree(docs):
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_schedule_takes_what_the_mix_says(docs):
    rows = mixing.schedule(docs).collect()
    taken, passes = Counter(), Counter()
    for row in rows:
        taken[row.doc_id, row.source] += row.words
        passes[row.doc_id, row.source] += 1
    mix = Counter()
    times = Counter()
    for row in mixing.mix(docs).collect():
        mix[row.doc_id, row.source] += row.taken
        times[row.doc_id, row.source] += row.passes
    assert +mix == +taken and +times == +passes
    assert [row.position for row in rows] == sorted(row.position for row in rows)
    assert all(0 <= row.time < 1 for row in rows)


def test_mix_is_in_training_order(docs):
    """Its rows come sorted by position over several ranges; what is never taken comes last."""
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    places = [(row.position is None, row.position) for row in rows]
    due = [place for none, place in places if not none]
    assert [none for none, _ in places] == sorted(none for none, _ in places)
    assert due == sorted(due) and len(set(due)) > 50
    assert all((row.taken == 0) == (row.position is None) == (row.passes == 0) for row in rows)
    firsts = {}
    for row in mixing.schedule(docs).collect():
        firsts.setdefault((row.doc_id, row.source), row.position)
    assert [row.position for row in rows if row.taken and row.doc_id not in (None, 3)] == [
        place for (doc_id, _), place in firsts.items() if doc_id not in (None, 3)
    ]


def test_heavier_sources_come_later(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "w " * 10) for i in range(3000)], SCHEMA)
    mean = {
        row.source: row.mean
        for row in mixing.schedule(docs).groupBy("source").agg({"time": "avg"}).toDF("source", "mean").collect()
    }
    assert mean["s0"] < mean["s1"] < mean["s2"]


@pytest.mark.parametrize("rows", [[], [(1, "a", None), (2, None, "")]], ids=["no rows", "no words"])
def test_nothing_to_take(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert [row.taken for row in mixing.mix(docs).collect()] == [0] * len(rows)
    assert mixing.schedule(docs).collect() == []


def test_a_source_of_many_ranges(spark):
    """One source over many tasks has the same running sums as on one."""
    docs = spark.createDataFrame([(i, "hot", "w " * (i % 5)) for i in range(4000)], SCHEMA).repartition(8)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        many = sorted((row.doc_id, row.taken, row.position) for row in mixing.mix(docs).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    one = sorted((row.doc_id, row.taken, row.position) for row in mixing.mix(docs.coalesce(1)).collect())
    assert many == one
