"""Benchmark decontamination against all windows of all documents."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.helpers import arrow_step, peak_mb
from tests.llm import brute
from tidegauge.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def planted(seed: int) -> tuple[list, list]:
    chance = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(chance.choices(vocabulary, k=chance.randint(12, 60)))) for i in range(15)]
    items += [(20, None), (21, "one two three"), (22, "..."), (None, "v1 v2 v3 v4 v5 v6 v7"), (23, items[0][1])]
    docs = []
    for i in range(60):
        text = chance.choices(vocabulary, k=chance.randint(0, 200))
        if i % 3 == 0:
            item = items[chance.randrange(15)][1].split()
            for _ in range(chance.choice((0, 0, 1, 2, 6))):
                item[chance.randrange(len(item))] = "changed"
            at = chance.randint(0, len(text))
            text[at:at] = item
        docs.append((i, chance.choice((" ", "\n", ", ")).join(text).upper() if i % 2 else " ".join(text)))
    docs += [(70, None), (71, ""), (72, "One, two three!"), (73, "one two three four"), (None, items[1][1]),
             (74, items[2][1][:-4]), (75, "a " * 20000 + items[3][1]), (75, items[3][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_windows(spark, seed):
    docs, items = planted(seed)
    expected = brute.contamination(docs, items)
    got = decontaminate.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    found = {(row.doc_id, row.item_id): row.similarity for row in got}
    assert len(found) == len(got)
    assert all(expected[pair] == pytest.approx(share) for pair, share in found.items())
    # SimHash may lose what is hardly similar enough, never an unchanged passage
    assert {pair for pair, share in expected.items() if share >= 0.9} <= set(found)
    assert len(found) >= 0.95 * len(expected)


def edited(seed: int) -> tuple[list, list]:
    """Items of several lengths, each with a tail, a middle block, or single words changed up to the limit."""
    chance = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(500)]
    docs, items = [], []
    for i in range(120):
        n = (10, 15, 20, 30, 60, 200)[i % 6]
        item = chance.choices(vocabulary[: 20 if i % 5 == 4 else 500], k=n)
        items.append((i, " ".join(item)))
        most = (n - 4) // 5  # shingles that may be lost
        if i % 3 == 0:
            places = range(n - most, n)
        elif i % 3 == 1:
            at = chance.randrange(4, n - most)
            places = range(at, at + max(0, most - 4))
        else:
            places = chance.sample(range(n), most // 5)
        for place in places:
            item[place] = chance.choice(vocabulary)
        docs.append((i, " ".join([*chance.choices(vocabulary, k=20), *item, *chance.choices(vocabulary, k=20)])))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_edits_up_to_the_limit_are_all_found(spark, seed):
    docs, items = edited(seed)
    expected = brute.contamination(docs, items)
    assert len(expected) >= 100
    documents, benchmark = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = decontaminate.contaminated(documents, benchmark).collect()
    assert {(row.doc_id, row.item_id): pytest.approx(row.similarity) for row in got} == expected
    clean = {row.doc_id for row in decontaminate.drop_contaminated(documents, benchmark).collect()}
    assert clean == {doc for doc, _ in docs} - {doc for doc, _ in expected}


def test_first_word(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta")]
    docs = [(5, "x y z Alpha, beta gamma-delta epsilon zeta eta theta end")]
    row = decontaminate.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).first()
    assert (row.doc_id, row.item_id, row.similarity, row.first_word) == (5, 1, 1.0, 3)


def test_rows_dropped_by_text(spark):
    docs, items = planted(4)
    found = brute.contamination(docs, items)
    maybe = {doc for doc, _ in found}
    bad = {doc for (doc, _), share in found.items() if share >= 0.9}
    rows = spark.createDataFrame([(*row, 1, "d") for row in docs], "doc_id long, text string, n int, digest string")
    clean = decontaminate.drop_contaminated(rows, spark.createDataFrame(items, ITEMS))
    assert clean.columns == rows.columns
    kept = [(row.doc_id, row.text) for row in clean.collect()]
    assert (70, None) in kept and (71, "") in kept
    assert not {doc for doc, _ in kept if doc is not None} & {doc for doc in bad if doc is not None}
    assert {doc for doc, _ in docs} - {doc for doc, _ in kept} <= maybe


def test_blocks_meet_whatever_differs_within_the_radius():
    chance = random.Random(5)
    blocks = decontaminate._blocks()
    for _ in range(500):
        a = chance.getrandbits(64)
        b = a
        for bit in chance.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        assert any((a >> shift) & mask == (b >> shift) & mask for shift, mask in blocks)
    assert sum(bin(mask).count("1") for _, mask in blocks) == 64


@pytest.mark.parametrize("docs,items", [([], [(1, "a b c d e")]), ([(1, "a b c d e")], []), ([], [])])
def test_empty(spark, docs, items):
    docs, items = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert decontaminate.contaminated(docs, items).collect() == []
    assert decontaminate.drop_contaminated(docs, items).count() == docs.count()


def test_a_large_batch_of_texts_takes_little_memory(spark):
    texts = ["some words of an ordinary text\n" * 100] * 4000
    batch = pa.RecordBatch.from_pydict({"digest": texts, "doc_id": list(range(4000)), "text": texts})
    nothing = np.zeros(1 << 12, dtype=np.uint8)
    run = arrow_step(spark, lambda docs: decontaminate.windows_of(docs, nothing, nothing, [20]))
    assert peak_mb(lambda: [None for _ in run([batch])]) < 2 * batch.column("text").nbytes / 1e6
