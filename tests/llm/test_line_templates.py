"""Line dedup against the same rule in plain Python."""

import random

import pyarrow as pa
import pytest

from tests.helpers import arrow_step, peak_mb
from tests.llm import brute
from tidegauge.llm import line_templates

SCHEMA = "doc_id long, text string"


def corpus(seed: int) -> list[tuple]:
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices("abcdefghij", k=chance.randint(2, 6)))
    line = lambda: " ".join(word() for _ in range(chance.randint(1, 14)))
    user = ["ann", "bob", "cem", "dov", "eli", "fay", "gus", "hal"]
    rows: list[tuple] = []
    for i in range(60):
        lines = [line() for _ in range(chance.randint(3, 9))]
        if chance.random() < 0.5:
            lines.insert(1, f"Served by node {chance.randint(1, 99)} at 2024-01-{chance.randint(10, 28)} in {chance.randint(1, 9)} ms")
        if chance.random() < 0.4:
            lines.append(f"\tPlease log in as user {chance.choice(user)} to read all of this page ")
        if chance.random() < 0.2:
            lines.append("All rights reserved by us")
        rows.append((i, "\n".join(lines)))
    for i in range(20):  # copies and near copies
        text = rows[i % 6][1].split("\n")
        if i % 3:
            text[i % len(text)] += " edited"
        rows.append((100 + i, "\n".join(text)))
    rows += [(200, None), (201, ""), (202, "\n\n \n"), (203, "All rights reserved by us"), (None, "a b c\na b c"),
             (0, rows[0][1]), (204, "All rights reserved by us\n" + line() * 5 + "\n")]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain(spark, seed):
    rows = corpus(seed)
    dropped = brute.template_lines([text for _, text in rows])
    assert any(line.startswith("Served by node") for line in dropped)
    assert any(line.startswith("Please log in as") for line in dropped)
    expected = [
        (doc, brute.without_lines(text, dropped), len((text or "").split("\n")) if text is not None else 0)
        for doc, text in rows
    ]
    got = line_templates.drop_report(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    key = lambda row: tuple(map(str, row))
    assert sorted(((r.doc_id, r.text, r.n_lines) for r in got), key=key) == sorted(expected, key=key)
    for row in got:
        assert row.n_dropped == row.n_lines - len((row.text or "").split("\n")) if row.text else True


def test_copies_keep_their_lines(spark):
    """Copies of one document are no sign of boilerplate, however many there are."""
    text = "\n".join(f"line {chr(97 + i)} of a document that has been copied often" for i in range(8))
    rows = [(i, text if i % 2 else text.replace("line c", f"row {chr(97 + i)}")) for i in range(20)]
    got = line_templates.drop_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {row.n_dropped for row in got} == {0}


def test_boilerplate_that_outweighs_the_text(spark):
    """A passage goes however short the pages are that it sits in; near copies stay."""
    chance = random.Random(8)
    words = lambda n: " ".join("".join(chance.choices("abcdefghij", k=6)) for _ in range(n))
    passage, header, footer, article = words(60), words(25), words(25), [words(20) for _ in range(9)]
    pages = [(i, f"{passage}\n{words(50)}") for i in range(8)]
    pages += [(100 + i, f"{header}\n{words(20)}\n{footer}") for i in range(12)]
    copies = []
    for i in range(60):
        lines = [line.split() for line in article]
        lines[i % 9][i % 20] = words(1)
        copies.append((200 + i, "\n".join(" ".join(line) for line in lines)))
    got = line_templates.drop_report(spark.createDataFrame(pages + copies, SCHEMA).repartition(5)).collect()
    gone = {row.doc_id: row.text for row in got}
    for doc, text in pages:
        assert gone[doc] == text.split("\n")[1]
    for doc, text in copies:
        assert gone[doc] == text


def test_rows_keep_their_other_columns(spark):
    rows = [(i, f"{chr(97 + i) * 3} is all its own\nBuilt by us with care\n{chr(97 + i) * 4} too is its own", "x", 7) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string, gone int")
    clean = line_templates.drop_lines(docs)
    assert clean.columns == docs.columns
    assert {row.text.count("Built") for row in clean.collect()} == {0}
    assert {(row.hits, row.gone) for row in clean.collect()} == {("x", 7)}


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert line_templates.drop_report(docs).collect() == []
    assert line_templates.drop_lines(docs).collect() == []


def test_a_large_batch_of_texts_takes_little_memory(spark):
    texts = ["\n".join(f"line {j} of the text with number {i}" for j in range(100)) for i in range(4000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    run = arrow_step(spark, line_templates.lines_of)
    assert peak_mb(lambda: [None for _ in run([batch])]) < 2 * batch.nbytes / 1e6
