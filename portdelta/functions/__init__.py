from portdelta.functions.columns import (
    bulk_cast,
    ci_equals,
    clamp_negative,
    direction_split,
    dropna_subset,
    epoch_aligned,
    has_counter,
    like_ipv4,
    map_get,
    newer_than,
    null_defaults,
    with_columns_map,
)
from portdelta.functions.time import bucket, parse_ts, ts_from_ms_minute, ts_from_ns, with_time_parts

__all__ = [
    "bucket",
    "bulk_cast",
    "ci_equals",
    "clamp_negative",
    "direction_split",
    "dropna_subset",
    "epoch_aligned",
    "has_counter",
    "like_ipv4",
    "map_get",
    "newer_than",
    "null_defaults",
    "parse_ts",
    "ts_from_ms_minute",
    "ts_from_ns",
    "with_columns_map",
    "with_time_parts",
]
