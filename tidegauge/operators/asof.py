"""As-of join: each row with the latest earlier row of another table.

Only moments take part: the times of the left rows, each once per key, and the right rows,
one per key and time. Moments are cut into buckets of time. In a bucket the latest right
row so far is carried on; what a bucket begins with is the last right row of the buckets
before, found among one row per key and bucket, so empty buckets cost nothing. The found
values then go back to the left rows by key and time, with moments that hold very many
rows split. So neither a hot key nor a hot moment is sorted by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import bucket_start
from tidegauge.operators.keyed_join import attach_by_key
from tidegauge.schema import TIME

BUCKET_SECONDS = 3600


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    values: list[str],
    *,
    time: str = TIME,
    right_time: str | None = None,
    tolerance_seconds: int | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """``left`` with ``matched_time`` and ``values`` of the latest right row at its time or before.

    Rows match within equal ``keys``. Of right rows at one time the greatest values count.
    NULL where there is no such row, none within ``tolerance_seconds``, or where a left
    row has no time or key; right rows without them match nothing.
    """
    known = F.lit(True)
    for key in keys:
        known &= F.col(key).isNotNull()
    source = right.select(*keys, F.col(right_time or time).alias("_time"), F.struct(*values).alias("_value"))
    rows = source.where(known & F.col("_time").isNotNull()).groupBy(*keys, "_time").agg(F.max("_value").alias("_value"))
    asked = left.where(known & F.col(time).isNotNull()).groupBy(*keys, F.col(time).alias("_time"))
    moments = (
        rows.unionByName(asked.agg(F.count("*").alias("_rows")), allowMissingColumns=True)
        .groupBy(*keys, "_time")
        .agg(F.max("_value").alias("_value"), F.sum("_rows").alias("_rows"))
        .withColumn("_bucket", bucket_start(F.col("_time"), bucket_seconds))
        .withColumn("_found", F.when(F.col("_value").isNotNull(), F.struct(F.col("_time").alias("at"), "_value")))
    )
    so_far = Window.partitionBy(*keys, "_bucket").orderBy("_time").rowsBetween(Window.unboundedPreceding, 0)
    inside = moments.withColumn("_found", F.last("_found", ignorenulls=True).over(so_far))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        moments.groupBy(*keys, "_bucket")
        .agg(F.max("_found").alias("_last"))
        .withColumn("_before", F.last("_last", ignorenulls=True).over(earlier))
        .drop("_last")
    )
    matched = (
        inside.where("_rows is not null")
        .join(begins, [*keys, "_bucket"])
        .select(*keys, F.col("_time").alias(time), F.coalesce("_found", "_before").alias("_found"), "_rows")
    )
    joined = attach_by_key(left, matched, [*keys, time], "_rows")
    found = F.col("_found")
    if tolerance_seconds is not None:
        age = F.unix_micros(time) - F.unix_micros(found["at"])
        found = F.when(age <= tolerance_seconds * 1_000_000, found)
    return joined.select(
        *left.columns, found["at"].alias("matched_time"), *(found["_value"][name].alias(name) for name in values)
    )
