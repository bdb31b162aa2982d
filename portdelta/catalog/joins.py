"""Queries over joins and table jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from portdelta.catalog.registry import query
from portdelta.catalog.tel import KEYS, SUB_KEYS, table, tel, with_tel
from portdelta.operators import joins
from portdelta.operators.aggregates import publish_stats, window_extents
from portdelta.plans import run_incremental
from portdelta.session import fresh_path
from portdelta.streaming import file_sink, publish_counted, publish_once

_DEVICES = ["dev-click", "dev-error", "dev-purchase", "dev-signup", "dev-view"]


def _counters(spark, sf, *extra: str):
    return tel(spark, sf).withColumnRenamed("ts", "timestamp").select(*KEYS, "timestamp", "event_id", *extra)


def _status(spark, sf):
    rows = tel(spark, sf).where(F.col("event_id") % 2 == 0)
    return rows.select(
        *SUB_KEYS,
        F.col("ts").alias("timestamp"),
        F.when(F.col("user_id") % 2 == 0, "UP").otherwise("DOWN").alias("oper_status"),
        F.col("user_id").cast("string").alias("ifindex"),
    )


_STATUS = """status AS (
  SELECT devicename, interface, subinterface, fts, CASE WHEN user_id % 2 = 0 THEN 'UP' ELSE 'DOWN' END AS oper_status,
         CAST(user_id AS VARCHAR) AS ifindex FROM tel WHERE event_id % 2 = 0)"""


@query(
    "join_status_minute",
    with_tel(
        """SELECT t.devicename, t.interface, t.ts AS timestamp, t.event_id, t.in_octets, s.oper_status, s.ifindex
           FROM tel t LEFT JOIN status s ON t.devicename = s.devicename AND t.interface = s.interface
            AND CAST(t.ts AS DATE) = CAST(s.fts AS DATE) AND hour(t.ts) = hour(s.fts) AND minute(t.ts) = minute(s.fts)""",
        _STATUS,
    ),
)
def join_status(spark, sf):
    status = _status(spark, sf).drop("subinterface")
    return joins.join_status_minute(_counters(spark, sf, "in_octets"), status, KEYS)


@query(
    "join_substatus_minute",
    with_tel(
        """SELECT t.devicename, t.interface, t.ts AS timestamp, t.event_id, t.subinterface, s.oper_status, s.ifindex
           FROM tel t LEFT JOIN status s ON t.devicename = s.devicename AND t.interface = s.interface
            AND t.subinterface = s.subinterface AND t.fts = s.fts""",
        _STATUS,
    ),
)
def join_substatus(spark, sf):
    return joins.join_status_minute(_counters(spark, sf, "subinterface"), _status(spark, sf), SUB_KEYS)


def _per_user(spark, sf):
    """Counters with one interface per user, as the inventory lists them."""
    return tel(spark, sf).select(
        F.col("ts").alias("timestamp"),
        "devicename",
        F.concat(F.lit("et-0/0/"), F.col("user_id")).alias("interface"),
        "in_octets",
        "out_octets",
        F.col("ts").alias("inserted_datetime"),
    )


def _inventory(spark, sf):
    return table(spark, sf, "customer").select(
        F.explode(F.array(*[F.lit(d) for d in _DEVICES])).alias("routername"),
        F.concat(F.lit("et-0/0/"), F.col("c_custkey")).alias("interface_name"),
        F.col("c_name").alias("customername"),
        F.col("c_mktsegment").alias("location"),
        (F.col("c_nationkey") * 1000).cast("long").alias("speed"),
    )


_INVENTORY_JOIN = with_tel(
    f"""SELECT t.ts AS timestamp, t.devicename, i.interface_name AS interface, t.in_octets, t.out_octets,
               i.customername, i.routername, i.location, i.interface_name, i.speed
        FROM tel t JOIN inventory i ON t.devicename = i.routername
         AND 'et-0/0/' || t.user_id = i.interface_name""",
    f"""inventory AS (
      SELECT r AS routername, 'et-0/0/' || c_custkey AS interface_name, c_name AS customername,
             c_mktsegment AS location, c_nationkey * 1000 AS speed
      FROM customer, (VALUES {", ".join(f"('{d}')" for d in _DEVICES)}) AS d(r))""",
)


@query("join_inventory", _INVENTORY_JOIN)
def join_inventory(spark, sf):
    return joins.join_inventory(_per_user(spark, sf), _inventory(spark, sf))


@query("incremental_join", _INVENTORY_JOIN)
def incremental_join(spark, sf):
    """Two deliveries, of which the second brings rows as old as those of the first, and a run with nothing new."""
    source, dest, state = fresh_path(spark, "arrivals"), fresh_path(spark, "dest"), fresh_path(spark, "state")
    rows, inventory = _per_user(spark, sf), _inventory(spark, sf)
    early = F.coalesce((F.col("inserted_datetime") <= F.lit(dt.datetime(2024, 1, 16))) & (F.pmod(F.xxhash64("*"), F.lit(3)) > 0), F.lit(False))
    for arrived in (rows.where(early), rows.where(~early)):
        arrived.write.mode("append").parquet(source)
        run_incremental(spark, source, inventory, dest, state)
    run_incremental(spark, source, inventory, dest, state)
    return spark.read.option("basePath", dest).parquet(dest).drop("run")


def _speed(spark, sf):
    rows = tel(spark, sf).where(F.col("event_id") % 3 == 0)
    return rows.select(*KEYS, F.col("ts").alias("timestamp"), (F.col("in_octets") % 7 + 1).alias("speed"))


_SPEED = "speed AS (SELECT devicename, interface, ts AS timestamp, in_octets % 7 + 1 AS speed FROM tel WHERE event_id % 3 = 0)"
_COUNTER = "counter AS (SELECT devicename, interface, ts AS timestamp, event_id, in_octets FROM tel)"
_LEDGER = "ledger AS (SELECT devicename, interface, ts AS timestamp FROM tel WHERE event_id % 4 = 0)"


@query(
    "join_speed",
    with_tel("SELECT * FROM counter JOIN speed USING (devicename, interface, timestamp)", _COUNTER, _SPEED),
)
def join_speed(spark, sf):
    return joins.join_speed(_counters(spark, sf, "in_octets"), _speed(spark, sf))


_SEMI = """joined AS (SELECT devicename, interface, timestamp FROM counter c WHERE EXISTS (
  SELECT 1 FROM speed s WHERE s.devicename = c.devicename AND s.interface = c.interface AND s.timestamp = c.timestamp))"""
_ANTI = """fresh AS (SELECT * FROM joined j WHERE NOT EXISTS (
  SELECT 1 FROM ledger l WHERE l.devicename = j.devicename AND l.interface = j.interface AND l.timestamp = j.timestamp))"""


@query("semi_join_speed", with_tel("SELECT * FROM joined", _COUNTER, _SPEED, _SEMI))
def semi_join(spark, sf):
    return joins.semi_join_speed(_counters(spark, sf), _speed(spark, sf))


def _sent(spark, sf):
    return _counters(spark, sf).where(F.col("event_id") % 4 == 0).drop("event_id")


@query("anti_join_published", with_tel("SELECT * FROM fresh", _COUNTER, _SPEED, _LEDGER, _SEMI, _ANTI))
def anti_join(spark, sf):
    return joins.not_published(semi_join(spark, sf), _sent(spark, sf))


@query(
    "publish_stats",
    with_tel(
        """SELECT (SELECT count(*) FROM joined) AS joined_rows, (SELECT count(*) FROM fresh) AS published_rows,
                  (SELECT count(*) FROM counter) AS input_rows,
                  (SELECT count(*) FROM joined) - (SELECT count(*) FROM fresh) AS already_published_rows""",
        _COUNTER,
        _SPEED,
        _LEDGER,
        _SEMI,
        _ANTI,
    ),
)
def stats(spark, sf):
    return publish_stats(semi_join(spark, sf), anti_join(spark, sf), _counters(spark, sf))


@query(
    "publish_counts",
    with_tel(
        """SELECT (SELECT count(*) FROM joined) AS joined_rows, (SELECT count(*) FROM fresh) AS published_rows,
                  (SELECT count(*) FROM counter) AS input_rows,
                  (SELECT count(*) FROM joined) - (SELECT count(*) FROM fresh) AS already_published_rows""",
        _COUNTER,
        _SPEED,
        _LEDGER,
        _SEMI,
        _ANTI,
    ),
)
def counts(spark, sf):
    """The same numbers, taken while the new rows are written."""
    path = fresh_path(spark, "published")
    found = publish_counted(
        _counters(spark, sf), lambda rows: joins.semi_join_speed(rows, _speed(spark, sf)), _sent(spark, sf), [*KEYS, "timestamp"], lambda new: new.write.parquet(path)
    )
    return spark.createDataFrame([found], ", ".join(f"{name} long" for name in found))


@query("publish_once", with_tel("SELECT * FROM joined", _COUNTER, _SPEED, _SEMI))
def publish_all_once(spark, sf):
    sent, ledger = fresh_path(spark, "sent"), fresh_path(spark, "ledger")
    keys = [*KEYS, "timestamp"]
    joined = semi_join(spark, sf)
    early = joined.where(F.col("timestamp") <= F.lit(dt.datetime(2024, 1, 16)))
    publish_once(early, ledger, keys, file_sink(sent), batch_id=0)
    publish_once(joined, ledger, keys, file_sink(sent), batch_id=1)
    # The same batch again, as after a restart.
    publish_once(joined, ledger, keys, file_sink(sent), batch_id=1)
    return spark.read.option("basePath", sent).parquet(sent).drop("batch_id")


_WINDOW_US = 21600 * 1_000_000
_EXTENTS = f"""extents AS (
  SELECT devicename, interface, min(ts) AS start_timestamp, max(ts) AS end_timestamp
  FROM tel GROUP BY devicename, interface, epoch_us(ts) // {_WINDOW_US})"""


@query(
    "range_join_interval",
    with_tel(
        """SELECT t.devicename, t.interface, t.ts, t.in_octets, x.start_timestamp, x.end_timestamp
           FROM tel t JOIN extents x ON t.devicename = x.devicename AND t.interface = x.interface
            AND t.ts >= x.start_timestamp AND t.ts <= x.end_timestamp""",
        _EXTENTS,
    ),
)
def range_join_interval(spark, sf):
    rows = tel(spark, sf).select(*KEYS, "ts", "in_octets")
    intervals = window_extents(rows, KEYS, "ts", "6 hours")
    return joins.range_join(rows, intervals, KEYS, "ts", "start_timestamp", "end_timestamp", 21_600)


@query(
    "self_join_window",
    with_tel(
        """SELECT a.devicename, a.interface, make_timestamp(a.w) AS window_start, make_timestamp(a.w + size) AS window_end,
                  max(b.in_octets) AS max_value, min(b.in_octets) AS min_value,
                  max(b.in_octets) - min(b.in_octets) AS delta_value
           FROM marked a JOIN marked b ON a.devicename = b.devicename AND a.interface = b.interface
            AND b.w <= a.t AND a.t <= b.w + b.size
           GROUP BY a.devicename, a.interface, a.w, a.size""",
        f"""marked AS (SELECT devicename, interface, in_octets, epoch_us(fts) AS t,
                              epoch_us(fts) // {_WINDOW_US} * {_WINDOW_US} AS w, {_WINDOW_US} AS size FROM tel)""",
    ).replace("a.w + size", "a.w + a.size"),
)
def self_join(spark, sf):
    rows = tel(spark, sf).select(*KEYS, "fts", "in_octets")
    return joins.self_join_window(rows, KEYS, "fts", "in_octets", 21_600)


def _thresholds(spark, sf):
    names = F.array(*[F.lit(d) for d in _DEVICES])
    return table(spark, sf, "region").select(
        F.get(names, F.col("r_regionkey").cast("int")).alias("key"),
        (F.col("r_regionkey") * 1000).cast("string").alias("value"),
    ).where(F.col("key") != "dev-view")


_LIMITS = f"""limits AS (
  SELECT ['{"', '".join(_DEVICES)}'][CAST(r_regionkey AS INTEGER) + 1] AS key, CAST(r_regionkey * 1000 AS VARCHAR) AS value
  FROM region WHERE r_regionkey < 4)"""


@query(
    "threshold_join",
    with_tel(
        """SELECT t.event_id, t.devicename, l.value AS threshold FROM tel t LEFT JOIN limits l ON t.devicename = l.key""",
        _LIMITS,
    ),
)
def threshold_join(spark, sf):
    return joins.threshold_join(tel(spark, sf).select("event_id", "devicename"), _thresholds(spark, sf), "devicename")


@query(
    "request_enrich",
    with_tel(
        """SELECT r.request_id, r.aid, r."alarmPoint", r.devicename, r.in_octets, r.c_custkey,
                  CASE WHEN health THEN 'HEALTHCHECK' WHEN c.c_custkey IS NOT NULL THEN 'OK' ELSE 'ERROR' END AS status,
                  CASE WHEN NOT health AND c.c_custkey IS NOT NULL THEN
                    CASE WHEN r.in_octets > CAST(l.value AS BIGINT) THEN 'ABOVE ' || c.c_mktsegment ELSE 'BELOW' END
                  END AS result,
                  CASE WHEN NOT health AND c.c_custkey IS NULL THEN 'no data for ' || r.c_custkey END AS message
           FROM requests r LEFT JOIN customer c ON r.c_custkey = c.c_custkey LEFT JOIN limits l ON r.devicename = l.key""",
        """requests AS (
             SELECT *, upper(aid) = 'HEALTHCHECK' OR coalesce(upper("alarmPoint") = 'HEALTHCHECK', false) AS health FROM (
             SELECT event_id AS request_id, CASE WHEN event_id % 50 = 0 THEN 'HealthCheck' ELSE 'A' || event_id % 100 END AS aid,
                    CASE WHEN event_id % 77 = 0 THEN 'healthcheck' WHEN event_id % 2 = 0 THEN interface END AS "alarmPoint",
                    devicename, in_octets, user_id * 20 AS c_custkey FROM tel))""",
        _LIMITS,
    ),
)
def request_enrich(spark, sf):
    e = F.col("event_id")
    requests = tel(spark, sf).select(
        e.alias("request_id"),
        F.when(e % 50 == 0, "HealthCheck").otherwise(F.concat(F.lit("A"), e % 100)).alias("aid"),
        F.when(e % 77 == 0, "healthcheck").when(e % 2 == 0, F.col("interface")).alias("alarmPoint"),
        "devicename",
        "in_octets",
        (F.col("user_id") * 20).alias("c_custkey"),
    )
    lookup = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    above = F.col("in_octets") > F.col("threshold").try_cast("long")
    rule = F.when(above, F.concat(F.lit("ABOVE "), F.col("c_mktsegment"))).otherwise("BELOW")
    return joins.request_enrich(requests, lookup, _thresholds(spark, sf), "c_custkey", "devicename", rule)
