"""Queries over counter deltas, batch and stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from portdelta.catalog.registry import query
from portdelta.catalog.tel import KEYS, SUB_KEYS, spread_tel, stream_tel, system_messages, tel, with_tel
from portdelta.model import DELTA_COUNTERS, GAUGES, OUTPUT_COLUMNS
from portdelta.operators import deltas
from portdelta.operators.custom import combine_per_key, flat_map
from portdelta.operators.joins import join_status_stream, self_join_window
from portdelta.operators.reorder import delta_complete_window_stream, delta_lag_ordered
from portdelta.operators.rolling import delta_lag_stream, delta_stateful
from portdelta.plans import window_delta_rows
from portdelta.session import fresh_path
from portdelta.ship import by_value
from portdelta.streaming import file_sink, start_stream

by_value(__name__)

_FOUR = ["in_octets", "in_pkts", "out_octets", "out_pkts"]
_KEY = "devicename, interface"
_BY = f"PARTITION BY {_KEY} ORDER BY ts, event_id"
_W = 21600 * 1_000_000
_ORDER = ["ts", "event_id"]
_LONG, _SLIDE = "21601 seconds", "6 hours"


def _rows(spark, sf, *cols: str):
    return tel(spark, sf).select(*KEYS, *_ORDER, *cols)


def _seconds(col: str) -> str:
    return f"CAST(epoch(date_trunc('second', {col})) AS BIGINT)"


def _lag_sql(key: str, n: int, cols: list[str], time_name: str) -> str:
    by = f"(PARTITION BY {key} ORDER BY ts, event_id)"
    new = ", ".join(f"coalesce({c} - lag({c}, {n}) OVER {by}, 0) AS delta_{c}" for c in cols)
    return with_tel(
        f"""SELECT {key}, ts, event_id, {", ".join(cols)}, {new},
                   coalesce({_seconds("ts")} - {_seconds(f"lag(ts, {n}) OVER {by}")}, 0) AS {time_name} FROM tel"""
    )


def _prevs(cols: list[str]) -> list[str]:
    return ["prev_time", *[f"prev_{c}" for c in cols]]


@query("delta_lag", _lag_sql(_KEY, 1, _FOUR, "delta_time_sec"))
def delta_lag(spark, sf):
    return deltas.delta_lag(_rows(spark, sf, *_FOUR), KEYS, _FOUR, _ORDER).drop(*_prevs(_FOUR))


@query("delta_lag_sub", _lag_sql(f"{_KEY}, subinterface", 1, _FOUR, "delta_time"))
def delta_lag_sub(spark, sf):
    rows = _rows(spark, sf, "subinterface", *_FOUR)
    return deltas.delta_lag(rows, SUB_KEYS, _FOUR, _ORDER, time_name="delta_time").drop(*_prevs(_FOUR))


@query(
    "delta_lag_reset",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id, greatest(coalesce(in_octets - lag(in_octets) OVER ({_BY}), 0), 0) AS delta_in_octets FROM tel"""
    ),
)
def delta_lag_reset(spark, sf):
    out = deltas.delta_lag(_rows(spark, sf, "in_octets"), KEYS, ["in_octets"], _ORDER, on_reset="zero")
    return out.select(*KEYS, *_ORDER, "delta_in_octets")


@query(
    "lag4_delta",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id, in_octets - lag(in_octets, 4) OVER w AS delta_in_octets,
                   {_seconds("ts")} - {_seconds("lag(ts, 4) OVER w")} AS interval_seconds
            FROM tel WINDOW w AS ({_BY}) QUALIFY lag(ts, 4) OVER w IS NOT NULL"""
    ),
)
def lag4_delta(spark, sf):
    out = deltas.delta_lag(
        _rows(spark, sf, "in_octets"), KEYS, ["in_octets"], _ORDER, n=4, time_name="interval_seconds", first="drop"
    )
    return out.select(*KEYS, *_ORDER, "delta_in_octets", "interval_seconds")


def _overlap(source: str, time: str) -> str:
    """CTE ``framed``: a row per window of one second more than six hours that holds the sample."""
    us = f"epoch_us({time})"
    return f"""framed AS (
      SELECT *, {us} // {_W} * {_W} AS w FROM {source}
      UNION ALL
      SELECT *, {us} // {_W} * {_W} - {_W} AS w FROM {source} WHERE {us} % {_W} < 1000000)"""


_EXTREMES = ", ".join(
    f"max({c}) AS max_{c}, min({c}) AS min_{c}, max({c}) - min({c}) AS delta_{c}" for c in _FOUR
)


@query(
    "delta_window_301",
    with_tel(
        f"""SELECT {_KEY}, make_timestamp(w) AS window_start, make_timestamp(w + {_W} + 1000000) AS window_end,
                   {_EXTREMES}, 21601 AS delta_time FROM framed GROUP BY {_KEY}, w""",
        _overlap("tel", "fts"),
    ),
)
def delta_window_301(spark, sf):
    return deltas.delta_window(tel(spark, sf).select(*KEYS, "ts", *_FOUR), KEYS, _FOUR, "ts", _LONG, _SLIDE)


@query(
    "delta_window_tumbling",
    with_tel(
        f"""SELECT {_KEY}, make_timestamp(epoch_us(fts) // {_W} * {_W}) AS window_start,
                   make_timestamp(epoch_us(fts) // {_W} * {_W} + {_W}) AS window_end,
                   {_EXTREMES}, 21600 AS delta_time FROM tel GROUP BY {_KEY}, epoch_us(fts) // {_W}"""
    ),
)
def delta_window_tumbling(spark, sf):
    return deltas.delta_window(tel(spark, sf).select(*KEYS, "ts", *_FOUR), KEYS, _FOUR, "ts", _SLIDE, None)


@query(
    "window_offset",
    with_tel(
        f"""SELECT {_KEY}, make_timestamp((epoch_us(ts) - 60000000) // {_W} * {_W} + 60000000) AS window_start,
                   max(in_octets) - min(in_octets) AS delta_in_octets
            FROM tel GROUP BY {_KEY}, (epoch_us(ts) - 60000000) // {_W}"""
    ),
)
def window_offset(spark, sf):
    out = deltas.delta_window(
        _rows(spark, sf, "in_octets"), KEYS, ["in_octets"], "ts", _SLIDE, _SLIDE, cut_minutes=False, offset="60 seconds"
    )
    return out.select(*KEYS, "window_start", "delta_in_octets")


@query(
    "delta_bucket",
    with_tel(
        f"""SELECT {_KEY}, make_timestamp(epoch_us(ts) // {_W} * {_W}) AS start_timestamp,
                   make_timestamp(epoch_us(ts) // {_W} * {_W} + {_W}) AS end_timestamp,
                   max(in_octets) - min(in_octets) AS delta_in_octets, max(out_octets) - min(out_octets) AS delta_out_octets,
                   CAST(NULL AS BIGINT) AS delta_time
            FROM tel GROUP BY {_KEY}, epoch_us(ts) // {_W}"""
    ),
)
def delta_bucket(spark, sf):
    cols = ["in_octets", "out_octets"]
    return deltas.delta_bucket(_rows(spark, sf, *cols), KEYS, cols, "ts", _SLIDE)


@query(
    "delta_group5",
    with_tel(
        f"""SELECT {_KEY}, CAST(ceil(rn / 5.0::DOUBLE) AS BIGINT) AS group_id, min(ts) AS start_timestamp, max(ts) AS end_timestamp,
                   arg_min(in_octets, ts) AS in_octets, max(in_octets) - arg_min(in_octets, ts) AS delta_in_octets
            FROM (SELECT *, row_number() OVER ({_BY}) AS rn FROM tel) GROUP BY {_KEY}, group_id"""
    ),
)
def delta_group5(spark, sf):
    return deltas.delta_group(_rows(spark, sf, "in_octets"), KEYS, "in_octets", "ts", 5, "event_id")


@query(
    "delta_complete_window",
    with_tel(
        f"""SELECT {_KEY}, make_timestamp(w) AS window_start, make_timestamp(w + {_W}) AS window_end,
                   max(in_octets) - min(in_octets) AS delta_in_octets, max(out_octets) - min(out_octets) AS delta_out_octets,
                   21600 AS delta_time
            FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY}, w ORDER BY ts, event_id) AS rn
                  FROM (SELECT *, epoch_us(ts) // {_W} * {_W} AS w FROM tel))
            WHERE rn <= 5 GROUP BY {_KEY}, w HAVING count(*) = 5"""
    ),
)
def delta_complete_window(spark, sf):
    cols = ["in_octets", "out_octets"]
    return deltas.delta_complete_window(_rows(spark, sf, *cols), KEYS, cols, "ts", _SLIDE, 5, "event_id")


@query(
    "delta_trailing",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id, arg_max(in_octets, ts) OVER w - arg_min(in_octets, ts) OVER w AS delta_in_octets,
                   max(s) OVER w - min(s) OVER w AS interval_seconds
            FROM (SELECT *, {_seconds("ts")} AS s FROM tel)
            WINDOW w AS (PARTITION BY {_KEY} ORDER BY s RANGE BETWEEN 14400 PRECEDING AND CURRENT ROW)"""
    ),
)
def delta_trailing(spark, sf):
    out = deltas.delta_trailing(_rows(spark, sf, "in_octets"), KEYS, "in_octets", "ts", 14_400, "event_id")
    return out.select(*KEYS, *_ORDER, "delta_in_octets", "interval_seconds")


@query(
    "delta_attach_interval",
    with_tel(
        f"""SELECT t.devicename, t.interface, t.ts, t.event_id, t.in_octets, x.start_timestamp, x.end_timestamp, x.delta_in_octets
            FROM tel t JOIN extents x ON t.devicename = x.devicename AND t.interface = x.interface
             AND t.ts >= x.start_timestamp AND t.ts <= x.end_timestamp""",
        f"""extents AS (SELECT {_KEY}, min(ts) AS start_timestamp, max(ts) AS end_timestamp,
                               max(in_octets) - min(in_octets) AS delta_in_octets
                        FROM tel GROUP BY {_KEY}, epoch_us(ts) // {_W})""",
    ),
)
def delta_attach_interval(spark, sf):
    return deltas.delta_attach_interval(_rows(spark, sf, "in_octets"), KEYS, ["in_octets"], "ts", _SLIDE)


@query(
    "delta_sampled",
    with_tel(
        f"""SELECT {_KEY}, ts, event_id, in_octets, max(in_octets) OVER w - min(in_octets) OVER w AS delta_in_octets
            FROM tel WHERE epoch_us(ts) % 43200000000 < 21601000000
            WINDOW w AS (PARTITION BY {_KEY}, epoch_us(ts) // 43200000000)"""
    ),
)
def delta_sampled(spark, sf):
    return deltas.delta_sampled(_rows(spark, sf, "in_octets"), KEYS, ["in_octets"], "ts", 21_601, 43_200)


_GAUGE = {c: f"max({c})" for c in GAUGES}
_SHAPED = {c: _GAUGE.get(c, f"max({c}) - min({c})") for c in [*DELTA_COUNTERS, *GAUGES]}
_SYSTEM = """sent AS (
  SELECT * REPLACE (CASE WHEN event_id % 101 <> 0 THEN out_errors END AS out_errors) FROM tel WHERE event_id % 97 <> 0)"""
_OUTPUT = {
    "recordtype": "'juniper_inf'",
    "timestamp": "date_trunc('minute', make_timestamp(min(epoch_ms) * 1000))",
    "start_epochtime": "min(epoch_ms)",
    "end_epochtime": "max(epoch_ms)",
    "delta_time_ms": "max(epoch_ms) - min(epoch_ms)",
    "devicename": "devicename",
    "interface": "interface",
    "subinterface": "'null'",
    **_SHAPED,
}
_OUTPUT_SELECT = ", ".join(f"{_OUTPUT[c]} AS {c}" for c in OUTPUT_COLUMNS)


@query(
    "delta_output",
    with_tel(f"SELECT {_OUTPUT_SELECT} FROM framed GROUP BY {_KEY}, w", _SYSTEM, _overlap("sent", "fts")),
)
def delta_output(spark, sf):
    return window_delta_rows(system_messages(spread_tel(spark, sf)), _LONG, _SLIDE, watermark=None)


_ROLLING = f"""pts AS (SELECT {_KEY}, epoch_us(ts) AS t, in_octets AS v FROM tel),
chain AS (
  SELECT {_KEY}, min(t) AS s FROM pts GROUP BY {_KEY}
  UNION ALL
  SELECT c.devicename, c.interface, (SELECT min(p.t) FROM pts p WHERE p.devicename = c.devicename
         AND p.interface = c.interface AND p.t >= c.s + {_W}) AS s
  FROM chain c WHERE c.s IS NOT NULL),
spans AS (
  SELECT {_KEY}, s, lead(s) OVER (PARTITION BY {_KEY} ORDER BY s) AS e FROM chain WHERE s IS NOT NULL)"""
_ROLLING_SQL = with_tel(
    """SELECT x.devicename, x.interface, make_timestamp(x.s) AS start_time, make_timestamp(x.e) AS end_time,
              max(p.v) - min(p.v) AS delta_in_octets
       FROM spans x JOIN pts p ON p.devicename = x.devicename AND p.interface = x.interface AND p.t BETWEEN x.s AND x.e
       WHERE x.e IS NOT NULL GROUP BY x.devicename, x.interface, x.s, x.e""",
    _ROLLING,
).replace("WITH", "WITH RECURSIVE", 1)


@query("delta_stateful", _ROLLING_SQL)
def rolling(spark, sf):
    return delta_stateful(_rows(spark, sf, "in_octets"), KEYS, "in_octets", "ts", 21_600)


def _run(spark, df, label: str, state_store: str | None = None):
    """Run a stream over all that is there and return what it wrote."""
    path = fresh_path(spark, f"{label}-out")
    state = fresh_path(spark, f"{label}-state")
    query = start_stream(df, None, {}, state, {"availableNow": True}, batch_sink=file_sink(path), state_store=state_store)
    query.awaitTermination()
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")


# A stream holds back windows that end behind its watermark: the newest minute less six minutes.
_CLOSED = "(SELECT epoch_us(max(fts)) - 360000000 FROM tel)"


@query(
    "stream_delta_window",
    with_tel(
        f"""SELECT {_OUTPUT_SELECT} FROM framed WHERE w + {_W} + 1000000 <= (SELECT epoch_us(max(fts)) - 360000000 FROM sent)
            GROUP BY {_KEY}, w""",
        _SYSTEM,
        _overlap("sent", "fts"),
    ),
)
def stream_delta_window(spark, sf):
    rows = window_delta_rows(system_messages(stream_tel(spark, sf)), _LONG, _SLIDE)
    return _run(spark, rows, "deltas")


@query(
    "stream_self_join",
    with_tel(
        f"""SELECT a.devicename, a.interface, make_timestamp(a.w) AS window_start, make_timestamp(a.w + {_W}) AS window_end,
                   max(b.in_octets) AS max_value, min(b.in_octets) AS min_value,
                   max(b.in_octets) - min(b.in_octets) AS delta_value
            FROM marked a JOIN marked b ON a.devicename = b.devicename AND a.interface = b.interface
             AND b.w <= a.t AND a.t <= b.w + {_W}
            WHERE a.w + {_W} <= {_CLOSED}
            GROUP BY a.devicename, a.interface, a.w""",
        f"""marked AS (SELECT devicename, interface, in_octets, epoch_us(fts) AS t,
                              epoch_us(fts) // {_W} * {_W} AS w FROM tel)""",
    ),
)
def stream_self_join(spark, sf):
    rows = stream_tel(spark, sf).select(*KEYS, "fts", "in_octets")
    return _run(spark, self_join_window(rows, KEYS, "fts", "in_octets", 21_600, "6 minutes"), "pairs")


@query("stream_delta_stateful", _ROLLING_SQL)
def stream_rolling(spark, sf):
    rows = stream_tel(spark, sf).select(*KEYS, "ts", "in_octets")
    return _run(spark, delta_stateful(rows, KEYS, "in_octets", "ts", 21_600), "rolling")


@query(
    "stream_delta_lag",
    with_tel(
        f"""SELECT {_KEY}, ts, in_octets, coalesce({_seconds("ts")} - {_seconds(f"lag(ts) OVER ({_BY})")}, 0) AS delta_time_sec,
                   coalesce(in_octets - lag(in_octets) OVER ({_BY}), 0) AS delta_in_octets FROM tel"""
    ),
)
def stream_delta_lag(spark, sf):
    rows = stream_tel(spark, sf).select(*KEYS, "ts", "in_octets")
    return _run(spark, delta_lag_stream(rows, KEYS, "in_octets", "ts"), "lag")


# The watermark of these streams ends two hours behind the newest sample; events come up to one hour late.
_JITTER, _DELAY = 3600, "2 hours"
_PASSED = "(SELECT epoch_us(max(ts)) // 1000 * 1000 - 7200000000 FROM tel)"


@query(
    "stream_delta_lag_ordered",
    with_tel(
        f"""SELECT * FROM (
              SELECT {_KEY}, ts, event_id, {", ".join(_FOUR)}, coalesce({_seconds("ts")} - {_seconds(f"lag(ts) OVER ({_BY})")}, 0) AS delta_time_sec,
                     {", ".join(f"greatest(coalesce({c} - lag({c}) OVER ({_BY}), 0), 0) AS delta_{c}" for c in _FOUR)} FROM tel)
            WHERE epoch_us(ts) // {_W} * {_W} + {_W} <= {_PASSED}"""
    ),
)
def stream_delta_lag_ordered(spark, sf):
    rows = stream_tel(spark, sf, _JITTER).select(*KEYS, "ts", "event_id", *_FOUR)
    out = delta_lag_ordered(rows, KEYS, _FOUR, _ORDER, _DELAY, bucket_seconds=21_600, on_reset="zero")
    return _run(spark, out, "lag-ordered", "rocksdb")


@query(
    "stream_complete_window",
    with_tel(
        f"""SELECT {_KEY}, make_timestamp(w) AS window_start, make_timestamp(w + {_W}) AS window_end,
                   max(in_octets) - min(in_octets) AS delta_in_octets, max(out_octets) - min(out_octets) AS delta_out_octets,
                   21600::BIGINT AS delta_time
            FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY}, w ORDER BY ts, event_id) AS rn
                  FROM (SELECT *, epoch_us(ts) // {_W} * {_W} AS w FROM tel))
            WHERE rn <= 5 AND w + {_W} <= {_PASSED} GROUP BY {_KEY}, w HAVING count(*) = 5"""
    ),
)
def stream_complete_window(spark, sf):
    cols = ["in_octets", "out_octets"]
    rows = stream_tel(spark, sf, _JITTER).select(*KEYS, "ts", "event_id", *cols)
    return _run(spark, delta_complete_window_stream(rows, KEYS, cols, _ORDER, 21_600, _DELAY, 5), "complete", "rocksdb")


# Of the two streams the one that is behind counts; a row without partner is given up a minute later.
_BOTH = f"""(SELECT epoch_us(least(max(ts), max(ts) FILTER (event_id % 2 = 0))) // 1000 * 1000 - 7200000000 - 60000000 FROM tel)"""


@query(
    "stream_join_status",
    with_tel(
        f"""SELECT t.devicename, t.interface, t.ts, t.event_id, t.in_octets, s.oper_status, s.ifindex
            FROM tel t LEFT JOIN status s ON t.devicename = s.devicename AND t.interface = s.interface AND t.fts = s.fts
            WHERE s.fts IS NOT NULL OR epoch_us(t.ts) <= {_BOTH}""",
        """status AS (SELECT devicename, interface, fts, CASE WHEN user_id % 2 = 0 THEN 'UP' ELSE 'DOWN' END AS oper_status,
                             CAST(user_id AS VARCHAR) AS ifindex FROM tel WHERE event_id % 2 = 0)""",
    ),
)
def stream_join_status(spark, sf):
    rows = stream_tel(spark, sf, _JITTER).select(*KEYS, "ts", "event_id", "in_octets")
    status = stream_tel(spark, sf, _JITTER).where("event_id % 2 = 0").select(
        *KEYS, "ts", F.when(F.col("user_id") % 2 == 0, "UP").otherwise("DOWN").alias("oper_status"), F.col("user_id").cast("string").alias("ifindex")
    )
    return _run(spark, join_status_stream(rows, status, KEYS, "ts", _DELAY), "status")


@query("stream_drop_duplicates", with_tel("SELECT DISTINCT devicename, interface, fts FROM tel"))
def stream_drop_duplicates(spark, sf):
    rows = stream_tel(spark, sf).select(*KEYS, "fts").withWatermark("fts", "6 minutes")
    return _run(spark, rows.dropDuplicatesWithinWatermark([*KEYS, "fts"]), "distinct")


def _two_sides(batch: pd.DataFrame) -> pd.DataFrame:
    sides = [
        batch[["event_id"]].assign(side=side, octets=batch[f"{side}_octets"]) for side in ("in", "out")
    ]
    return pd.concat(sides)


@query(
    "map_in_pandas",
    with_tel(
        """SELECT event_id, 'in' AS side, in_octets AS octets FROM tel
           UNION ALL SELECT event_id, 'out', out_octets FROM tel"""
    ),
)
def map_in_pandas(spark, sf):
    rows = tel(spark, sf).select("event_id", "in_octets", "out_octets")
    return flat_map(rows, _two_sides, "event_id long, side string, octets long")


def _extremes(batch: pd.DataFrame) -> pd.DataFrame:
    grouped = batch.groupby(["devicename", "w"], as_index=False)["in_octets"]
    return grouped.agg(high="max", low="min")


@query(
    "grouped_agg_udf",
    with_tel(
        f"""SELECT devicename, make_timestamp(epoch_us(ts) // {_W} * {_W}) AS w, max(in_octets) - min(in_octets) AS delta_in_octets
            FROM tel GROUP BY devicename, epoch_us(ts) // {_W}"""
    ),
)
def grouped_agg(spark, sf):
    rows = tel(spark, sf).select("devicename", F.window("ts", _SLIDE)["start"].alias("w"), "in_octets")
    schema = "devicename string, w timestamp, high long, low long"
    merge = {"delta_in_octets": F.max("high") - F.min("low")}
    return combine_per_key(rows, ["devicename", "w"], _extremes, schema, merge)
