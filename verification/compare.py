"""Run queries next to their SQL and report differences.

    python -m verification.compare [--sf 0.01] [--conf KEY=VALUE] [query ...]
"""

from __future__ import annotations

import argparse
import math
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracle import ORACLE
from verification.queries import QUERIES

DATA = "/root/testdata"


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    """Column names, types and rows of a DuckDB query over the given tables."""
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = [str(column[1]) for column in result.description]
    return names, types, result.fetchall()


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    return value


def canonical(names: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((value is None, str(value)) for value in row))


def differences(frame: DataFrame, name: str, sf_dir: str) -> list[str]:
    """What differs between a query's result and its SQL; empty if nothing does."""
    rows = [tuple(row) for row in frame.collect()]
    if name not in ORACLE:
        return [] if rows else ["no rows"]
    names, types, expected = sql_rows(sf_dir, ORACLE[name])
    found = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    same_type = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP",
    }
    sql_types = dict(zip(names, types))
    for column, data_type in frame.dtypes:
        if same_type.get(data_type) != sql_types[column]:
            found.append(f"{column}: {data_type} != {sql_types[column]}")
    if len(rows) != len(expected):
        found.append(f"{len(rows)} rows != {len(expected)}")
    ours, theirs = canonical(frame.columns, rows), canonical(names, expected)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for setting in args.conf:
        builder = builder.config(*setting.split("=", 1))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in args.names or QUERIES:
        begin = time.time()
        try:
            sf_dir = f"{DATA}/sf{args.sf}"
            found = differences(QUERIES[name](spark, sf_dir), name, sf_dir)
        except Exception as error:  # noqa: BLE001 - reported per query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - begin:.1f}s", *found, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
