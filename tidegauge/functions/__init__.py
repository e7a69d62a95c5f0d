from tidegauge.functions.names import clean_name, clean_names, clean_text
from tidegauge.functions.numbers import (
    correlation,
    deviates,
    to_number,
    usable_mean,
    usable_std,
    zscore,
)
from tidegauge.functions.times import (
    bucket_start,
    clamp_timestamp,
    epoch_to_timestamp,
    on_bucket_edge,
    shift_seconds,
    utc_wall_clock,
    wall_clock_epoch,
)

__all__ = [
    "bucket_start",
    "clamp_timestamp",
    "clean_name",
    "clean_names",
    "clean_text",
    "correlation",
    "deviates",
    "epoch_to_timestamp",
    "on_bucket_edge",
    "shift_seconds",
    "to_number",
    "usable_mean",
    "usable_std",
    "utc_wall_clock",
    "wall_clock_epoch",
    "zscore",
]
