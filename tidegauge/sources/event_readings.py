"""Raw readings as a view of an event table.

Every event becomes exactly one reading; none is left out. The CASE rules put
missing, negative and unreadable values in, as a sensor feed has them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import wall_clock_epoch
from tidegauge.schema import RAW_COLUMNS


def readings_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events to raw text readings; ``keep`` carries event columns along."""
    event_id = F.col("event_id")
    level = F.get_json_object("props", "$.k").try_cast("double")
    seconds = wall_clock_epoch(F.col("ts"))
    text = {
        "Time": F.when(event_id % 103 != 0, seconds.cast("string")),
        "Temperature": (
            F.when(event_id % 101 == 0, F.lit(None).cast("string"))
            .when(event_id % 97 == 0, F.lit("-1"))
            .when(event_id % 89 == 0, F.lit("bad"))
            .otherwise(F.col("value").cast("string"))
        ),
        "Humidity": (F.pow(level, F.lit(6.0)) / F.lit(1e10)).cast("string"),
        "Air_Quality": F.col("user_id").cast("string"),
        "Light": (event_id % 1000).cast("string"),
        "Loudness": F.sqrt("value").cast("string"),
    }
    return events.select(*keep, *(text[name].alias(name) for name in RAW_COLUMNS))
