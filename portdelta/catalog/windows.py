"""Queries over aggregations and ordered windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from portdelta.catalog.parsing import _POLL, _poll
from portdelta.catalog.registry import query
from portdelta.catalog.tel import KEYS, SUB_KEYS, tel, with_tel
from portdelta.functions import epoch_aligned
from portdelta.operators import aggregates, windows
from portdelta.operators.deltas import delta_lag
from portdelta.operators.flatten import explode_elements
from portdelta.functions.columns import direction_split

_FOUR = ["in_octets", "in_pkts", "out_octets", "out_pkts"]
_KEY = "devicename, interface"
_BY = f"PARTITION BY {_KEY} ORDER BY ts, event_id"
_BY_SUB = f"PARTITION BY {_KEY}, subinterface ORDER BY ts, event_id"
_W = 21600 * 1_000_000
_SECOND = "CAST(epoch(date_trunc('second', ts)) AS BIGINT)"
_RANGE = f"PARTITION BY {_KEY} ORDER BY s RANGE BETWEEN 21600 PRECEDING AND CURRENT ROW"
_TIMED = f"timed AS (SELECT *, {_SECOND} AS s FROM tel)"
_ORDER = ["ts", "event_id"]


def _rows(spark, sf, *cols: str):
    return tel(spark, sf).select(*KEYS, *_ORDER, *cols)


@query(
    "max_min_list",
    with_tel(
        f"""SELECT {_KEY}, {", ".join(f"max({c}) AS max_{c}, min({c}) AS min_{c}" for c in _FOUR)}
            FROM tel GROUP BY {_KEY}"""
    ),
)
def max_min_list(spark, sf):
    return aggregates.max_min(tel(spark, sf), KEYS, _FOUR)


@query("group_count", with_tel("SELECT devicename, count(*) AS count FROM tel GROUP BY devicename"))
def group_count(spark, sf):
    return aggregates.group_count(tel(spark, sf), ["devicename"])


@query(
    "group_avg_max_min",
    with_tel(
        """SELECT devicename, avg(in_octets) AS avg_in_octets, max(in_octets) AS max_in_octets,
                  min(in_octets) AS min_in_octets FROM tel GROUP BY devicename"""
    ),
)
def group_stats(spark, sf):
    return aggregates.group_stats(tel(spark, sf), ["devicename"], "in_octets")


@query(
    "group_first_delta",
    with_tel(
        f"""SELECT {_KEY}, min(ts) AS start_timestamp, max(ts) AS end_timestamp, arg_min(in_octets, ts) AS in_octets,
                   max(in_octets) - arg_min(in_octets, ts) AS delta_in_octets FROM tel GROUP BY {_KEY}"""
    ),
)
def first_delta(spark, sf):
    return aggregates.first_delta(_rows(spark, sf, "in_octets"), KEYS, "in_octets", "ts", "event_id")


@query("global_max", "SELECT max(ts) AS max_ts FROM events")
def global_max(spark, sf):
    return aggregates.global_max(tel(spark, sf), "ts")


@query(
    "poll_sum_window",
    with_tel(
        f"""SELECT make_timestamp(epoch_ms * 1000 // {_W} * {_W}) AS window_start, devicename AS "deviceName",
                   if_descr AS "ifDescr", tag AS "oidTag",
                   sum(CASE WHEN orient = '1' THEN CAST(v - p AS DOUBLE) END) AS bytes_in,
                   sum(CASE WHEN orient = '0' THEN CAST(v - p AS DOUBLE) END) AS bytes_out,
                   sum(up_diff / 100.0::DOUBLE) AS delta_time
            FROM poll GROUP BY ALL""",
        _POLL,
    ),
)
def poll_sum_window(spark, sf):
    rows = direction_split(explode_elements(_poll(spark, sf)), "orient", "value", "previousValue")
    rows = rows.withColumns(
        {
            "t": F.timestamp_millis(F.col("finishTime").try_cast("long")),
            "delta_time": (F.col("sysUpTime").try_cast("double") - F.col("previousSysUpTime").try_cast("double")) / 100,
        }
    )
    return aggregates.poll_sums(rows, ["deviceName", "ifDescr", "oidTag"], "t", "6 hours")


@query(
    "window_extents",
    with_tel(
        f"""SELECT {_KEY}, min(ts) AS start_timestamp, max(ts) AS end_timestamp FROM tel
            GROUP BY {_KEY}, epoch_us(ts) // {_W}"""
    ),
)
def window_extents(spark, sf):
    return aggregates.window_extents(tel(spark, sf), KEYS, "ts", "6 hours")


@query(
    "window_max_of_delta",
    with_tel(
        f"""SELECT {_KEY}, min(ts) AS start_timestamp, max(ts) AS end_timestamp, max(in_octets) AS in_octets,
                   max(d) AS delta_in_octets
            FROM (SELECT *, coalesce(in_octets - lag(in_octets) OVER ({_BY}), 0) AS d FROM tel)
            GROUP BY {_KEY}, epoch_us(ts) // {_W}"""
    ),
)
def window_max_of_delta(spark, sf):
    rows = delta_lag(_rows(spark, sf, "in_octets"), KEYS, ["in_octets"], _ORDER)
    return aggregates.window_max_of_delta(rows, KEYS, "ts", "6 hours", "in_octets", "delta_in_octets")


def _lag_sql(by: str, key: str, cols: list[str]) -> str:
    lags = ", ".join(f"lag({c}) OVER ({by}) AS prev_{c}" for c in cols)
    return with_tel(f"SELECT {key}, ts, event_id, lag(ts) OVER ({by}) AS prev_time, {lags} FROM tel")


_LAGS = {"ts": "prev_time", **{c: f"prev_{c}" for c in _FOUR}}


@query("lag_prev", _lag_sql(_BY, _KEY, _FOUR))
def lag_prev(spark, sf):
    return windows.lag_columns(_rows(spark, sf, *_FOUR), KEYS, _ORDER, _LAGS).drop(*_FOUR)


@query("lag_prev_sub", _lag_sql(_BY_SUB, f"{_KEY}, subinterface", _FOUR))
def lag_prev_sub(spark, sf):
    return windows.lag_columns(_rows(spark, sf, "subinterface", *_FOUR), SUB_KEYS, _ORDER, _LAGS).drop(*_FOUR)


@query(
    "range_first_last",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id, arg_min(in_octets, ts) OVER w AS first_in_octets,
                   arg_max(in_octets, ts) OVER w AS last_in_octets, max(s) OVER w - min(s) OVER w AS interval_seconds
            FROM timed WINDOW w AS ({_RANGE})""",
        _TIMED,
    ),
)
def range_first_last(spark, sf):
    rows = _rows(spark, sf, "in_octets")
    return windows.range_first_last(rows, KEYS, "ts", "in_octets", 21_600, "event_id").drop("in_octets")


@query(
    "range_vs_total_sum",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id, CAST(sum(in_octets) OVER ({_RANGE}) AS BIGINT) AS range_sum,
                   CAST(sum(in_octets) OVER (PARTITION BY {_KEY}) AS BIGINT) AS total_sum FROM timed""",
        _TIMED,
    ),
)
def range_vs_total(spark, sf):
    out = windows.range_stat(
        _rows(spark, sf, "in_octets"),
        KEYS,
        "ts",
        {"range_sum": ("sum", F.col("in_octets"))},
        21_600,
        totals={"total_sum": (F.sum("in_octets"), "sum")},
    )
    return out.drop("in_octets")


@query(
    "range_interval_len",
    with_tel(
        f"SELECT {_KEY}, ts, event_id, max(s) OVER w - min(s) OVER w AS interval_seconds FROM timed WINDOW w AS ({_RANGE})",
        _TIMED,
    ),
)
def range_interval_len(spark, sf):
    second = F.unix_seconds("ts")
    stats = {"_max": ("max", second), "_min": ("min", second)}
    out = windows.range_stat(_rows(spark, sf), KEYS, "ts", stats, 21_600)
    return out.select(*KEYS, *_ORDER, (F.col("_max") - F.col("_min")).alias("interval_seconds"))


@query(
    "rolling_sum_5m",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id, CAST(sum(in_octets) OVER (PARTITION BY {_KEY} ORDER BY s
                   RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) AS BIGINT) AS octets_sum FROM timed""",
        _TIMED,
    ),
)
def rolling_sum(spark, sf):
    rows = _rows(spark, sf, "in_octets")
    return windows.range_stat(rows, KEYS, "ts", {"octets_sum": ("sum", F.col("in_octets"))}, 300).drop("in_octets")


@query(
    "lead_lag_span",
    with_tel(
        f"""SELECT * FROM (SELECT {_KEY}, ts, event_id, lead(in_octets, 4) OVER w - lag(in_octets, 4) OVER w AS span_in_octets
            FROM tel WINDOW w AS ({_BY})) WHERE span_in_octets IS NOT NULL"""
    ),
)
def lead_lag_span(spark, sf):
    return windows.lead_lag_span(_rows(spark, sf, "in_octets"), KEYS, _ORDER, "in_octets", 4).drop("in_octets")


@query(
    "nth_in_window",
    with_tel(
        f"""SELECT * FROM (SELECT {_KEY}, ts, event_id, in_octets, make_timestamp(epoch_us(ts) // {_W} * {_W}) AS window_start,
                   row_number() OVER (PARTITION BY {_KEY}, epoch_us(ts) // {_W} ORDER BY ts, event_id) AS row_num FROM tel)
            WHERE row_num = 5"""
    ),
)
def nth_in_window(spark, sf):
    return windows.nth_in_window(_rows(spark, sf, "in_octets"), KEYS, "ts", "6 hours", 5, "event_id")


@query("row_number_key", with_tel(f"SELECT {_KEY}, ts, event_id, row_number() OVER ({_BY}) AS row_num FROM tel"))
def row_number_key(spark, sf):
    return windows.with_running_number(_rows(spark, sf), KEYS, _ORDER, "row_num")


@query(
    "running_count_group",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id, row_num, CAST(ceil(row_num / 5.0::DOUBLE) AS BIGINT) AS group_id
            FROM (SELECT *, row_number() OVER ({_BY}) AS row_num FROM tel)"""
    ),
)
def running_count_group(spark, sf):
    return windows.group_every(_rows(spark, sf), KEYS, _ORDER, 5)


@query(
    "lag_after_filter",
    with_tel(
        f"""SELECT {_KEY}, fts, event_id, CAST(epoch(fts) - epoch(lag(fts) OVER (PARTITION BY {_KEY} ORDER BY fts, event_id)) AS BIGINT)
                   AS interval_seconds FROM tel WHERE CAST(epoch(fts) AS BIGINT) % 300 = 0"""
    ),
)
def lag_after_filter(spark, sf):
    rows = epoch_aligned(tel(spark, sf).select(*KEYS, "fts", "event_id"), "fts", 300)
    out = windows.lag_columns(rows, KEYS, ["fts", "event_id"], {"fts": "_prev"})
    passed = F.unix_timestamp("fts") - F.unix_timestamp("_prev")
    return out.withColumn("interval_seconds", passed).drop("_prev")


@query(
    "elapsed_group",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id,
                   (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY {_KEY}))) // 300000000 AS group_id FROM tel"""
    ),
)
def elapsed_group(spark, sf):
    return windows.elapsed_group(_rows(spark, sf), KEYS, "ts", 300)
