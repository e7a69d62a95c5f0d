"""Positions and running totals along a global order, without a single sorted task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidegauge.sources.workspace import Scratch


def running_totals(
    df: DataFrame, group: str, order: list[str], value: str, scratch: Scratch, label: str
) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over earlier rows of the same ``group``.

    ``group`` is a bigint without nulls. Rows are dealt to tasks by ranges of group and
    ``order``, so a large group takes many tasks. Each task adds up its own rows; the
    totals of whole ranges, one row per task and group, are then added up and joined.
    Rows that agree in all of ``order`` are interchangeable. ``df`` should be a written
    table, as its ranges are sampled first.
    """
    schema = StructType(
        df.schema.fields + [StructField("own_before", LongType()), StructField("part", LongType())]
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, total = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(group).to_numpy(zero_copy_only=False)
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(values)])
            new = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
            run = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(groups))))
            base = sums[new]
            if groups[0] == last:
                base[0] -= total
            before = sums[:-1] - base[run]
            last, total = groups[-1], int(sums[-1] - base[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before), pa.array(np.full(len(groups), part, dtype=np.int64))],
                schema.fieldNames(),
            )

    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    parts = scratch.table(ranged.mapInArrow(add_up, schema), label)
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        parts.groupBy(group, "part")
        .agg(F.sum(value).alias("total"))
        .withColumn("range_before", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
        .select(group, "part", "range_before")
    )
    return (
        parts.join(ranges, [group, "part"])
        .withColumn("before", F.col("own_before") + F.col("range_before"))
        .drop("own_before", "range_before", "part")
    )
