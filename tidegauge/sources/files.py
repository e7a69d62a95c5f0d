"""Batch sources: CSV drops, JSON lines and catalog tables."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions import clean_names
from tidegauge.schema import CORRUPT, EXTRA, LOAD, QUARANTINED, RAW_SCHEMA
from tidegauge.sources.workspace import read_head

#: Bytes of a file's beginning in which its header is looked for, and files at a time.
HEAD_BYTES = 1 << 14
HEADS_AT_ONCE = 16


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder and all folders in it; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return sorted(row.path for row in files.select("path").collect())


def csv_headers(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The CSV files of a drop folder, or of a list, by header: the first line with text.

    Only the beginning of each file is read, many files at a time; a file without text
    has no header. The driver holds the names of the files, as Spark's own listing does.
    """
    paths = list_files(spark, path) if isinstance(path, str) else sorted(path)
    files_of: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        for name, header in zip(paths, pool.map(partial(_first_line, spark), paths), strict=True):
            if header is not None:
                files_of.setdefault(header, []).append(name)
    return files_of


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line with text; a compressed file is read through its codec."""
    size = HEAD_BYTES
    while True:
        head = read_head(spark, path, size)
        lines = head.decode("utf-8", "replace").splitlines(keepends=True)
        whole = lines if len(head) < size else lines[:-1]  # the last may be cut off
        for line in whole:
            if line.strip():
                return line.rstrip("\r\n")
        if len(head) < size:
            return None
        size *= 16


def _names(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff")]))


def _readable(names: list[str], schema: T.StructType) -> bool:
    return len(set(names)) == len(names) and not set(names).isdisjoint(schema.fieldNames())


def odd_csv_files(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SCHEMA) -> list[str]:
    """The files of a drop folder that no column can be read from by name."""
    headers = csv_headers(spark, path)
    return sorted(name for header in headers if not _readable(_names(header), schema) for name in headers[header])


def odd_csv_lines(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """``source_file, _corrupt_record``: every line of the files that hold no known column."""
    odd = odd_csv_files(spark, path, schema)
    if not odd:
        return spark.createDataFrame([], f"source_file string, {CORRUPT} string")
    return spark.read.text(odd).select(file_path().alias("source_file"), F.col("value").alias(CORRUPT))


def read_csv_drop(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_SCHEMA,
    *,
    multiline: bool = True,
    extras: bool = False,
    source: bool = False,
) -> DataFrame:
    """All CSV files of a folder or list, every column as text, found by the header's names.

    Files may have their columns in any order. A column that a file lacks is NULL; a file
    without any of them, or with a name twice, is left to :func:`odd_csv_files` and does
    not stop the others. Short rows are filled with NULL, blank lines skipped. ``extras``
    adds two columns that lose nothing: ``_extra``, a JSON object of the columns that are
    not in the schema, and ``_corrupt_record``, the whole line of a row with too few or
    too many fields. ``source`` adds ``source_file``. ``multiline`` keeps quoted line breaks
    but makes each file one task; turn it off for huge files without such breaks, which can
    then be split. The rows are read once; see :func:`csv_headers`.
    """
    files_of = csv_headers(spark, path)
    added = (*((EXTRA, CORRUPT) if extras else ()), *(("source_file",) if source else ()))
    parts = [
        _with_header(spark, paths, _names(header), schema, multiline, added)
        for header, paths in sorted(files_of.items())
        if _readable(_names(header), schema)
    ]
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{name} string" for name in (*schema.fieldNames(), *added)))
    return reduce(DataFrame.unionByName, parts)


def read_csv_as_json(spark: SparkSession, path: str | list[str], *, multiline: bool = True) -> DataFrame:
    """Every row of the CSV files of a folder or list as one JSON object with all of its columns.

    The keys are the header's names as they are, also those that no schema knows; of a
    name that a header has twice the last column counts. Missing values are null. A row
    with too few or too many fields has its whole line under ``_corrupt_record`` besides.
    """
    parts = []
    for header, paths in sorted(csv_headers(spark, path).items()):
        last = {name: i for i, name in enumerate(_names(header))}
        places = [T.StructField(f"_{i}", T.StringType()) for i in range(len(_names(header)))]
        rows = _csv_rows(spark, paths, T.StructType([*places, T.StructField(CORRUPT, T.StringType())]), multiline)
        columns = [F.col(f"_{i}").alias(name) for name, i in last.items()]
        keep = {"ignoreNullFields": "false"}
        whole = F.to_json(F.struct(*columns), keep)
        odd = F.to_json(F.struct(*columns, F.col(CORRUPT)), keep)
        parts.append(rows.select(F.when(F.col(CORRUPT).isNull(), whole).otherwise(odd).alias("value")))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "value string")


def _csv_rows(spark: SparkSession, paths: list[str], schema: T.StructType, multiline: bool) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .csv(paths)
    )


def _with_header(
    spark: SparkSession,
    paths: list[str],
    names: list[str],
    schema: T.StructType,
    multiline: bool,
    added: tuple[str, ...],
) -> DataFrame:
    fields = [T.StructField(name, T.StringType()) for name in (*names, CORRUPT)]
    rows = _csv_rows(spark, paths, T.StructType(fields), multiline)
    columns = [
        (F.col(f"`{name}`") if name in names else F.lit(None).cast("string")).alias(name)
        for name in schema.fieldNames()
    ]
    if EXTRA in added:
        others = [F.col(f"`{name}`").alias(name) for name in names if name not in schema.fieldNames()]
        extra = F.to_json(F.struct(*others)) if others else F.lit(None).cast("string")
        columns += [extra.alias(EXTRA), F.col(CORRUPT)]
    if "source_file" in added:
        columns.append(file_path().alias("source_file"))
    return rows.select(*columns)


def file_path() -> Column:
    """Path of the file a row came from."""
    return F.col("_metadata.file_path")


def decode_key(key: Column) -> Column:
    """Undo the URL escapes of an object key; a broken escape stays as it is."""
    return F.try_url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))


def count_rows_per_file(df: DataFrame) -> DataFrame:
    """One row per source file with its number of records.

    The file path is the one column the scan has to produce, and the counts are
    combined before the shuffle.
    """
    path = F.col("source_file") if "source_file" in df.columns else file_path()
    return df.groupBy(path.alias("source_file")).agg(F.count("*").alias("records"))


def summarize_ingest(counts: DataFrame) -> DataFrame:
    """Number of files and records of one ingest run."""
    return counts.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("records"),
    )


def json_schema(schema: T.StructType = RAW_SCHEMA) -> T.StructType:
    """The record schema plus the column that receives unreadable lines."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """JSON lines of a folder and all folders in it, with a fixed schema.

    Unreadable lines land in ``_corrupt_record``.
    """
    return (
        spark.read.schema(json_schema(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def good_records(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def mark_quarantined(parsed: DataFrame) -> DataFrame:
    """Clean column names and a flag column that tells unreadable lines apart."""
    names = clean_names(parsed.drop(CORRUPT)).columns
    renamed = parsed.select(*parsed.drop(CORRUPT).columns, CORRUPT).toDF(*names, CORRUPT)
    return renamed.withColumn(QUARANTINED, F.col(CORRUPT).isNotNull())


def write_bronze(parsed: DataFrame, path: str, load_id: str) -> None:
    """Add raw records and unreadable lines of one load, each in a partition of its own.

    The same load again replaces its rows. Both kinds come out of a single parse, and
    Spark does not let raw JSON files be asked for their unreadable lines alone.
    """
    (
        mark_quarantined(parsed)
        .withColumn(LOAD, F.lit(load_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD, QUARANTINED)
        .parquet(path)
    )


def bronze_records(bronze: DataFrame) -> DataFrame:
    """Readable records; only their partition is read."""
    return bronze.filter(~_is_quarantined()).drop(QUARANTINED, CORRUPT, LOAD)


def quarantined_lines(bronze: DataFrame) -> DataFrame:
    """Unreadable lines; only their partition is read."""
    return bronze.filter(_is_quarantined()).select(F.col(CORRUPT).alias("line"))


def _is_quarantined() -> Column:
    # A folder's partition values come back as text, a table's as booleans.
    return F.col(QUARANTINED).cast("boolean")


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; a missing one raises ``AnalysisException``."""
    return spark.read.table(name)


def load_table_if_present(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or None where it does not exist."""
    try:
        return load_table(spark, name)
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        return None
