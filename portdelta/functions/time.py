"""Time conversions. Whole-number division keeps every digit of a 19-digit epoch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _div(col: Column, by: int) -> Column:
    return F.call_function("div", col, F.lit(by).cast("long"))


def ts_from_ns(col: Column | str) -> Column:
    """Epoch nanoseconds to a timestamp cut to four fraction digits."""
    return F.timestamp_micros(_div(_col(col).cast("long"), 100_000) * 100)


def ts_from_ms_minute(col: Column | str) -> Column:
    """Epoch milliseconds to the start of their minute."""
    return F.date_trunc("minute", F.timestamp_millis(_col(col).cast("long")))


def bucket(col_ms: Column | str, seconds: int) -> Column:
    """Start of the ``seconds``-long bucket that holds an epoch-millisecond value."""
    width = seconds * 1000
    return F.timestamp_millis(F.floor(_col(col_ms).cast("long") / width) * width)


def with_time_parts(df: DataFrame, ts: str) -> DataFrame:
    """Adds date, hour, minute and second of ``ts``."""
    return df.withColumns(
        {"datetype": F.to_date(ts), "hour": F.hour(ts), "min": F.minute(ts), "sec": F.second(ts)}
    )


def parse_ts(col: Column | str, pattern: str) -> Column:
    """Text to timestamp by pattern; text that does not fit becomes NULL."""
    return F.try_to_timestamp(_col(col), F.lit(pattern))
