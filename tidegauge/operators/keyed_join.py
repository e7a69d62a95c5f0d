"""Attach a per-key table to a large, possibly skewed table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.sources.workspace import materialize

#: Shares of a shuffle partition that one key's rows may take before they are split.
HOT_SHARE = 0.25


def attach_by_key(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    count_column: str,
    *,
    stored: bool = False,
) -> DataFrame:
    """Left join of ``rows`` with ``lookup``, which has one row per key.

    ``count_column`` says how many of ``rows`` carry the key. The lookup is written
    once, unless it is ``stored`` already, so Spark knows its bytes and broadcasts it
    only where they are few. For the other case, keys that hold more than a quarter of
    an even shuffle partition are split: their rows are dealt to as many tasks as that
    needs, to each of which goes a copy of the key's row. With ``P`` partitions there are
    fewer than ``4 P`` such keys by arithmetic, so the list of them, which marks the
    rows, is small at any size. Rows without a key are dealt out evenly. ``rows`` is
    read once.
    """
    if not stored:
        lookup = materialize(lookup, "lookup")
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = lookup.agg(F.coalesce(F.sum(count_column), F.lit(0))).first()[0]
    share = max(1.0, total * HOT_SHARE / partitions)
    splits = F.least(F.ceil(F.col(count_column) / share), F.lit(partitions)).cast("int")
    is_hot = F.col(count_column) > share
    hot = lookup.where(is_hot).select(*keys, splits.alias("_splits"))
    copies = lookup.withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.when(is_hot, splits - 1).otherwise(0)))
    ).drop(count_column)
    has_key = reduce(and_, (F.col(key).isNotNull() for key in keys))
    # the input partition, which a retried task keeps, tells equal rows apart
    spread = F.xxhash64(F.spark_partition_id(), *rows.columns)
    parts = F.when(has_key, F.coalesce("_splits", F.lit(1))).otherwise(F.lit(partitions))
    return (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_part", F.pmod(spread, parts).cast("int"))
        .drop("_splits")
        .join(copies, [*keys, "_part"], "left")
        .drop("_part")
    )
