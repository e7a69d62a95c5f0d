"""A training corpus from the documents table, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate, line_templates, mixing, ngram_join, quality_rules
from tidegauge.sources.workspace import Scratch, ending_scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go; n_chars, if there, follows the text."""
    clean = line_templates.drop_lines(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.keep_one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: sources at their target weights along a curriculum."""
    return mixing.schedule(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", mixture),
]

#: Templates, components and fingerprints have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again.

    A stage's table goes when the next one is written. No documents give no rows. Texts
    that are null or empty fail the base rules, so they are not in the result; a null id,
    language or source is a value like others, and other columns, whatever their names,
    don't matter. Of rows that repeat one stays.
    """
    scratch = Scratch(spark, "corpus")
    docs, done = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with ending_scratch():
            docs = scratch.table(stage(spark, docs, sf_dir), name)
        scratch.drop(*done)
        done = [name]
    return STAGES[-1][1](spark, docs, sf_dir)
