"""Counter deltas: previous sample, windows, groups of n, trailing range and polls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portdelta.functions.columns import ci_equals, clamp_negative, direction_split, null_defaults
from portdelta.functions.time import bucket
from portdelta.model import DELTA_COUNTERS, GAUGES, OUTPUT_COLUMNS
from portdelta.operators.aggregates import first_delta, max_min
from portdelta.operators.joins import attach
from portdelta.operators.slices import SLICE_SECONDS
from portdelta.operators.windows import group_every, lag_columns, range_first_last

# Constant columns of the published record.
RECORD_TYPE = "juniper_inf"
NO_SUBINTERFACE = "null"


def _on_reset(delta: Column, policy: str) -> Column:
    if policy == "negative":
        return delta
    if policy == "zero":
        return F.when(delta < 0, F.lit(0)).otherwise(delta)
    if policy == "null":
        return F.when(delta >= 0, delta)
    raise ValueError(f"unknown on_reset policy {policy!r}")


def delta_lag(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    order: Sequence[str],
    n: int = 1,
    on_reset: str = "negative",
    time_name: str = "delta_time_sec",
    first: str = "zero",
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Current minus n-th previous sample of the key, in time and in each counter.

    ``order`` starts with the time column; further columns break ties. ``first`` says what samples
    without a partner get: ``zero``, ``null``, or ``drop`` to leave them out. ``on_reset`` says what
    becomes of a falling counter: ``negative``, ``zero`` or ``null``.
    """
    ts = order[0]
    names = {ts: "prev_time", **{c: f"prev_{c}" for c in cols}}
    return lag_deltas(lag_columns(df, keys, order, names, n, seconds), cols, ts, on_reset, time_name, first)


def lag_deltas(out: DataFrame, cols: Sequence[str], ts: str, on_reset: str, time_name: str, first: str) -> DataFrame:
    """Deltas against ``prev_time`` and ``prev_<col>``, which each row has already; policies as in ``delta_lag``."""
    if first not in ("zero", "null", "drop"):
        raise ValueError(f"unknown first policy {first!r}")
    if first == "drop":
        out = out.where(F.col("prev_time").isNotNull())

    def against(prev: str, delta: Column) -> Column:
        has = F.when(F.col(prev).isNotNull(), delta)
        return has.otherwise(F.lit(0)) if first == "zero" else has

    passed = F.unix_timestamp(ts) - F.unix_timestamp("prev_time")
    new = {time_name: against("prev_time", passed)}
    for c in cols:
        new[f"delta_{c}"] = against(f"prev_{c}", _on_reset(F.col(c) - F.col(f"prev_{c}"), on_reset))
    return out.withColumns(new)


def delta_window(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    ts: str,
    size: str = "301 seconds",
    slide: str | None = "5 minutes",
    watermark: str | None = None,
    cut_minutes: bool = True,
    offset: str | None = None,
) -> DataFrame:
    """Maximum, minimum and their difference per key and window; batch or stream.

    The window is one second longer than its slide, so a sample on the boundary closes one window
    and opens the next and no step between windows is lost. That needs times cut to the minute,
    which ``cut_minutes`` does. With ``slide=None`` windows do not overlap. ``offset`` shifts all windows.
    """
    if cut_minutes:
        df = df.withColumn(ts, F.date_trunc("minute", ts))
    if watermark:
        df = df.withWatermark(ts, watermark)
    period = F.window(ts, size, slide, offset)
    return max_min(df, [period.alias("_period"), *keys], cols).select(
        *keys,
        F.col("_period.start").alias("window_start"),
        F.col("_period.end").alias("window_end"),
        *[f"max_{c}" for c in cols],
        *[f"min_{c}" for c in cols],
        *[(F.col(f"max_{c}") - F.col(f"min_{c}")).alias(f"delta_{c}") for c in cols],
        (F.unix_timestamp("_period.end") - F.unix_timestamp("_period.start")).alias("delta_time"),
    )


def delta_bucket(df: DataFrame, keys: Sequence[str], cols: Sequence[str], ts: str, size: str) -> DataFrame:
    """Delta per aligned bucket with its start and end; elapsed time is left open."""
    out = delta_window(df, keys, cols, ts, size, None, cut_minutes=False)
    return out.select(
        *keys,
        F.col("window_start").alias("start_timestamp"),
        F.col("window_end").alias("end_timestamp"),
        *[f"delta_{c}" for c in cols],
        F.lit(None).cast("long").alias("delta_time"),
    )


def delta_group(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    ts: str,
    n: int = 5,
    tie: str | None = None,
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Groups of n consecutive samples per key: first and last time, first value, maximum minus first."""
    order = [c for c in (ts, tie) if c]
    grouped = group_every(df, keys, order, n, seconds)
    return first_delta(grouped, [*keys, "group_id"], col, ts, tie)


def delta_complete_window(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    ts: str,
    window: str,
    n: int = 5,
    tie: str | None = None,
) -> DataFrame:
    """Delta over the first n samples of each window; windows with fewer samples are left out."""
    order = [c for c in (ts, tie) if c]
    spec = Window.partitionBy(*keys, "_w").orderBy(*order)
    # The rank filter also runs before the shuffle, which bounds what a busy window sends.
    firsts = (
        df.select(*keys, *order, *cols, F.window(ts, window).alias("_w"))
        .withColumn("_n", F.row_number().over(spec))
        .where(F.col("_n") <= n)
    )
    return (
        firsts.groupBy("_w", *keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[(F.max(c) - F.min(c)).alias(f"delta_{c}") for c in cols],
        )
        .where(F.col("_n") == n)
        .select(
            *keys,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *[f"delta_{c}" for c in cols],
            (F.unix_timestamp("_w.end") - F.unix_timestamp("_w.start")).alias("delta_time"),
        )
    )


def delta_trailing(
    df: DataFrame, keys: Sequence[str], col: str, ts: str, seconds: int = 240, tie: str | None = None
) -> DataFrame:
    """Last minus first value within the trailing seconds, and the time between them."""
    out = range_first_last(df, keys, ts, col, seconds, tie)
    return out.withColumn(f"delta_{col}", F.col(f"last_{col}") - F.col(f"first_{col}"))


def delta_attach_interval(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], ts: str, window: str
) -> DataFrame:
    """Every sample with the extent and the delta of its window.

    Windows do not overlap, so the interval that contains a sample is that of its own window: the
    range join becomes an equi join on key and window.
    """
    rows = df.withColumn("_w", F.window(ts, window)["start"])
    by = [*keys, "_w"]
    intervals = rows.groupBy(*by).agg(
        F.min(ts).alias("start_timestamp"),
        F.max(ts).alias("end_timestamp"),
        *[(F.max(c) - F.min(c)).alias(f"delta_{c}") for c in cols],
    )
    return attach(rows, intervals, by).drop("_w")


def delta_sampled(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], ts: str, size: int = 301, period: int = 600
) -> DataFrame:
    """Every ``period`` seconds, the delta over the first ``size`` seconds, copied to each sample in them."""
    span, every = size * 1_000_000, period * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = df.withColumn("_slot", F.floor(micros / every)).where(micros - F.col("_slot") * every < span)
    by = [*keys, "_slot"]
    slots = rows.groupBy(*by).agg(*[(F.max(c) - F.min(c)).alias(f"delta_{c}") for c in cols])
    return attach(rows, slots, by).drop("_slot")


def poll_delta(df: DataFrame, dataset: str | None = None) -> DataFrame:
    """Polled element rows (text fields) to byte and time differences per 15-minute bucket."""
    if dataset is not None:
        df = df.where(ci_equals("src", dataset))

    def number(name: str) -> Column:
        return F.col(name).try_cast("double")

    quarter = bucket(F.col("finishTime").try_cast("long"), 900)
    out = direction_split(df.where(F.col("dataType") == "IP"), "orient", "value", "previousValue").select(
        "deviceName",
        "ifDescr",
        quarter.alias("measurement_time_15min"),
        F.col("bytes_in").alias("bytesInValue"),
        F.col("bytes_out").alias("bytesOutValue"),
        ((number("sysUpTime") - number("previousSysUpTime")) / 100).alias("deltaTime"),
        "src",
        F.date_format(quarter, "yyyyMMdd").alias("date"),
        number("oidTag").alias("_tag"),
    )
    # The two octet counters among the polled objects.
    out = out.where(F.col("deltaTime").isNotNull() & F.col("_tag").isin(100.0, 103.0)).drop("_tag")
    out = null_defaults(out, {"bytesInValue": 0.0, "bytesOutValue": 0.0, "src": "UNKNOWN"})
    return clamp_negative(out, ["bytesInValue", "bytesOutValue"])


# Order of the fields in the separated poll record.
POLL_RECORD = [
    "deviceName",
    "ifDescr",
    "measurement_time_15min",
    "bytesInValue",
    "bytesOutValue",
    "deltaTime",
    "src",
    "date",
]


def delta_output(
    df: DataFrame, gauges: Sequence[str] = tuple(GAUGES), epoch_ms: str = "timestamp", recordtype: str = RECORD_TYPE
) -> DataFrame:
    """Window deltas to the published record: gauges show their maximum, all others their delta.

    ``df`` comes from ``delta_window`` with the millisecond column ``epoch_ms`` among its columns.
    """
    start, end = F.col(f"min_{epoch_ms}"), F.col(f"max_{epoch_ms}")
    shaped = {
        "recordtype": F.lit(recordtype),
        "timestamp": F.date_trunc("minute", F.timestamp_millis(start)),
        "start_epochtime": start,
        "end_epochtime": end,
        "delta_time_ms": end - start,
        "devicename": F.col("devicename"),
        "interface": F.col("interface"),
        "subinterface": F.lit(NO_SUBINTERFACE),
    }
    for c in [*DELTA_COUNTERS, *GAUGES]:
        shaped[c] = F.col(f"max_{c}") if c in gauges else F.col(f"delta_{c}")
    return df.select(*[shaped[name].alias(name) for name in OUTPUT_COLUMNS])
