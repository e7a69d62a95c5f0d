"""Every corpus query over the given tables, and the pipeline against plain Python."""

import math
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tests.llm import brute
from tidegauge.llm.oracle import ORACLE
from tidegauge.llm.queries import QUERIES


def plain(value):
    return f"{value:.12g}" if isinstance(value, float) and not math.isnan(value) else str(value)


@pytest.mark.parametrize("name", ORACLE)
def test_against_sql(spark, medium, name):
    connection = duckdb.connect()
    for path in Path(medium).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = connection.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    expected = sorted(tuple(map(plain, row)) for row in result.fetchall())
    frame = QUERIES[name](spark, medium)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(tuple(map(plain, row)) for row in frame.select(*columns).collect()) == expected


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_pipeline(spark, small, tmp_path):
    """Each stage on the rows of the one before; few labels, so rules are the base."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [tuple(row) for row in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {row.doc_id: row for row in docs.collect()}
    texts = {doc: row.text for doc, row in rows.items()}
    steps = dict(corpus_pipeline.STAGES)

    frame = written(spark, steps["quality_rules"](spark, docs, small), tmp_path / "a")
    texts = {doc: text for doc, text in texts.items() if not brute.base_counts(text)[-1]}
    assert {row.doc_id: row.text for row in frame.collect()} == texts

    frame = written(spark, steps["line_dedup"](spark, frame, small), tmp_path / "b")
    dropped = brute.template_lines(list(texts.values()))
    texts = {doc: brute.without_lines(text, dropped) for doc, text in texts.items()}
    assert {row.doc_id: (row.text, row.n_chars) for row in frame.collect()} == {d: (t, len(t)) for d, t in texts.items()}

    frame = written(spark, steps["ngram_jaccard_join"](spark, frame, small), tmp_path / "c")
    first = {c for _, n, c in brute.components(list(texts.items())) if n}
    texts = {doc: text for doc, text in texts.items() if doc in first or not brute.words(text)}
    assert {row.doc_id: row.text for row in frame.collect()} == texts

    frame = written(spark, steps["decontamination"](spark, frame, small), tmp_path / "d")
    bad = {doc for doc, _ in brute.contamination(list(texts.items()), items)}
    assert frame.columns == docs.columns
    assert {row.doc_id for row in frame.collect()} == set(texts) - bad

    mixed = steps["source_mix"](spark, frame, small).collect()
    sizes: dict = {}
    for row in frame.collect():
        sizes[row.source] = sizes.get(row.source, 0) + len(brute.words(row.text))
    for source, target in brute.targets(sizes).items():
        assert abs(sum(row.words for row in mixed if row.source == source) - target) <= 0.5
    assert [tuple(row) for row in corpus_pipeline.run(spark, small).collect()] == [tuple(row) for row in mixed]


@pytest.mark.parametrize("empty", [True, False])
def test_pipeline_of_odd_documents(spark, small, tmp_path, empty):
    """No documents; nulls in every column, repeated rows, names that clash, no n_chars."""
    for name in ("labels", "benchmark"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{small}/{name}.parquet")
    good = [" ".join(f"w{i}x{k}" for k in range(60 + i)) for i in range(6)]
    rows = [(i, text, "en", f"s{i % 2}", "x") for i, text in enumerate(good)]
    rows += [rows[0], (None, good[5] + " more", None, None, None), (7, None, "en", "s", "x"), (8, "", None, "s", "x"), (9, " \n\t", "en", None, "x")]
    names = ("key", "digest", "row", "doc", "_may", "_salt")
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, extra string")
    docs = docs.selectExpr("*", *(f"extra AS {name}" for name in names))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = written(spark, stage(spark, frame, str(tmp_path)), tmp_path / name)
        assert frame.columns == docs.columns
    assert sorted(row.doc_id for row in frame.collect()) == ([] if empty else [0, 1, 2, 3, 4, 5])
    mixed = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).collect()
    # a source's last pass may end before all of its documents
    assert {row.doc_id for row in mixed} <= set(range(6)) and bool(mixed) != empty


def written(spark, frame, path):
    frame.write.parquet(str(path))
    return spark.read.parquet(str(path))
