"""Queries over projections, predicates, scalar functions, sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from portdelta.catalog.registry import query
from portdelta.catalog.tel import KEYS, SENT, spread_tel, system_messages, table, tel, with_tel
from portdelta.functions import (
    bucket,
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
    parse_ts,
    ts_from_ms_minute,
    ts_from_ns,
    with_columns_map,
    with_time_parts,
)
from portdelta.model import SYSTEM_ENVELOPE
from portdelta.operators.aggregates import drop_exact_duplicates, latest_per_key, latest_row
from portdelta.operators.flatten import explode_system
from portdelta.operators.parse import parse_value
from portdelta.operators.windows import every_nth

_MARK = "2024-01-20 00:00:00"


@query(
    "project_output",
    with_tel("""SELECT 'juniper_inf' AS recordtype, devicename, interface AS port, 'null' AS subinterface,
                       in_octets + out_octets AS octets FROM tel"""),
)
def project_output(spark, sf):
    rows = tel(spark, sf).withColumnRenamed("interface", "port").drop("subinterface")
    return rows.selectExpr(
        "'juniper_inf' AS recordtype", "devicename", "port", "'null' AS subinterface", "in_octets + out_octets AS octets"
    )


@query(
    "with_columns_map",
    with_tel("""SELECT event_id, 'juniper_inf' AS recordtype, epoch_ms AS start_epochtime, epoch_ms + 300000 AS end_epochtime,
                       fts AS timestamp FROM tel"""),
)
def columns_map(spark, sf):
    rows = tel(spark, sf).select("event_id", "epoch_ms")
    new = {
        "recordtype": F.lit("juniper_inf"),
        "start_epochtime": F.col("epoch_ms"),
        "end_epochtime": F.col("epoch_ms") + 300_000,
        "timestamp": ts_from_ms_minute("epoch_ms"),
    }
    return with_columns_map(rows, new).drop("epoch_ms")


_TYPED = ", ".join(n for n in SENT if n not in ("in_octets", "out_errors"))


@query(
    "bulk_cast",
    with_tel(f"""SELECT devicename, epoch_ms AS timestamp, interface, {_TYPED},
                        CASE WHEN event_id % 97 <> 0 THEN in_octets END AS in_octets,
                        CASE WHEN event_id % 101 <> 0 THEN out_errors END AS out_errors FROM tel"""),
)
def cast_all(spark, sf):
    flat = explode_system(parse_value(system_messages(spread_tel(spark, sf)), SYSTEM_ENVELOPE))
    return bulk_cast(flat, "bigint", KEYS)


_GAPPY = """SELECT event_id, devicename, nullif(in_errors, 0) AS in_errors, nullif(in_discards, 0) AS in_discards FROM tel"""


def _gappy(spark, sf):
    return tel(spark, sf).select(
        "event_id",
        "devicename",
        F.nullif("in_errors", F.lit(0)).alias("in_errors"),
        F.nullif("in_discards", F.lit(0)).alias("in_discards"),
    )


@query("filter_has_counter", with_tel(f"SELECT * FROM ({_GAPPY}) WHERE in_errors IS NOT NULL"))
def filter_has_counter(spark, sf):
    return has_counter(_gappy(spark, sf), "in_errors")


@query("dropna_subset", with_tel(f"SELECT * FROM ({_GAPPY}) WHERE in_errors IS NOT NULL AND in_discards IS NOT NULL"))
def drop_null_rows(spark, sf):
    return dropna_subset(_gappy(spark, sf), ["in_errors", "in_discards"])


@query(
    "null_defaults",
    with_tel("""SELECT event_id, coalesce(nullif(in_errors, 0), -1) AS in_errors,
                       coalesce(CASE WHEN event_id % 3 <> 0 THEN devicename END, 'UNKNOWN') AS src FROM tel"""),
)
def defaults(spark, sf):
    rows = _gappy(spark, sf).select(
        "event_id", "in_errors", F.when(F.col("event_id") % 3 != 0, F.col("devicename")).alias("src")
    )
    return null_defaults(rows, {"in_errors": -1, "src": "UNKNOWN"})


@query(
    "clamp_negative",
    with_tel("""SELECT event_id, CASE WHEN in_errors = 0 THEN NULL ELSE greatest(in_errors - 6, 0) END AS change FROM tel"""),
)
def clamp(spark, sf):
    rows = _gappy(spark, sf).select("event_id", (F.col("in_errors") - 6).alias("change"))
    return clamp_negative(rows, ["change"])


@query(
    "direction_split",
    with_tel("""SELECT event_id, CASE WHEN event_id % 3 = 1 AND event_id % 7 <> 0 THEN CAST(out_octets - in_octets AS DOUBLE) END AS bytes_in,
                       CASE WHEN event_id % 3 = 0 AND event_id % 7 <> 0 THEN CAST(out_octets - in_octets AS DOUBLE) END AS bytes_out FROM tel"""),
)
def split_direction(spark, sf):
    rows = tel(spark, sf).select(
        "event_id",
        (F.col("event_id") % 3).cast("string").alias("orient"),
        F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("out_octets").cast("string")).alias("value"),
        F.col("in_octets").cast("string").alias("previous"),
    )
    return direction_split(rows, "orient", "value", "previous").select("event_id", "bytes_in", "bytes_out")


@query("filter_ci_equals", "SELECT event_id, event_type FROM events WHERE upper(event_type) = 'CLICK'")
def filter_ci(spark, sf):
    return table(spark, sf, "events").where(ci_equals("event_type", "Click")).select("event_id", "event_type")


@query("filter_isin", with_tel("SELECT event_id, in_errors FROM tel WHERE in_errors IN (3, 7)"))
def filter_isin(spark, sf):
    return tel(spark, sf).where(F.col("in_errors").isin(3, 7)).select("event_id", "in_errors")


@query(
    "filter_rlike_ip",
    with_tel("""SELECT event_id, 'host ' || in_discards || '.' || in_errors || '.1.2 up' AS line FROM tel WHERE event_id % 4 <> 0"""),
)
def filter_ip(spark, sf):
    address = F.concat_ws(".", "in_discards", "in_errors", F.lit("1"), F.lit("2"))
    line = F.when(F.col("event_id") % 4 == 0, "host a.b.c.d up").otherwise(F.concat(F.lit("host "), address, F.lit(" up")))
    return tel(spark, sf).select("event_id", line.alias("line")).where(like_ipv4("line"))


@query("filter_epoch_aligned", with_tel("SELECT event_id, fts FROM tel WHERE CAST(epoch(fts) AS BIGINT) % 300 = 0"))
def filter_aligned(spark, sf):
    return epoch_aligned(tel(spark, sf).select("event_id", "fts"), "fts", 300)


@query(
    "every_nth_row",
    with_tel(
        """SELECT devicename, interface, event_id, in_octets, rn FROM n WHERE rn % 5 = 0""",
        """n AS (SELECT *, row_number() OVER (PARTITION BY devicename, interface ORDER BY ts, event_id) AS rn FROM tel)""",
    ),
)
def every_nth_row(spark, sf):
    rows = tel(spark, sf).select(*KEYS, "ts", "event_id", "in_octets")
    return every_nth(rows, KEYS, ["ts", "event_id"], 5).drop("ts")


@query("incremental_filter", f"SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '{_MARK}'")
def incremental_filter(spark, sf):
    # The stored column is compared as it is, so the predicate reaches the scan.
    rows = newer_than(table(spark, sf, "events").select("event_id", "ts", "user_id"), "ts", _MARK)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("ts_from_ns", with_tel("SELECT event_id, make_timestamp((epoch_ns // 100000) * 100) AS t FROM tel"))
def from_ns(spark, sf):
    return tel(spark, sf).select("event_id", ts_from_ns("epoch_ns").alias("t"))


@query("ts_from_ms_minute", with_tel("SELECT event_id, date_trunc('minute', make_timestamp(epoch_ms * 1000)) AS t FROM tel"))
def from_ms(spark, sf):
    return tel(spark, sf).select("event_id", ts_from_ms_minute("epoch_ms").alias("t"))


@query(
    "bucket_15min",
    with_tel("""SELECT event_id, make_timestamp((epoch_ms // 900000) * 900000000) AS measurement_time_15min,
                       strftime(make_timestamp((epoch_ms // 900000) * 900000000), '%Y%m%d') AS date FROM tel"""),
)
def bucket_15min(spark, sf):
    quarter = bucket("epoch_ms", 900)
    return tel(spark, sf).select(
        "event_id", quarter.alias("measurement_time_15min"), F.date_format(quarter, "yyyyMMdd").alias("date")
    )


@query(
    "time_parts",
    "SELECT event_id, CAST(ts AS DATE) AS datetype, hour(ts) AS hour, minute(ts) AS min, second(ts) AS sec FROM events",
)
def time_parts(spark, sf):
    return with_time_parts(tel(spark, sf).select("event_id", "ts"), "ts").drop("ts")


@query(
    "interval_arith",
    """SELECT event_id, ts + INTERVAL 5 MINUTE AS later, ts - INTERVAL 1 HOUR AS earlier,
              make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS aligned,
              CAST(epoch(date_trunc('second', ts)) AS BIGINT) % 300 AS past FROM events""",
)
def interval_arith(spark, sf):
    return tel(spark, sf).selectExpr(
        "event_id",
        "ts + INTERVAL 5 MINUTES AS later",
        "ts - INTERVAL 1 HOUR AS earlier",
        "window(ts, '5 minutes').start AS aligned",
        "unix_seconds(ts) % 300 AS past",
    )


@query(
    "format_ts",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:00') AS minute_text, strftime(ts, '%Y%m%d %H:%M') AS compact,
              date_trunc('minute', ts) AS parsed FROM events""",
)
def format_ts(spark, sf):
    compact = F.date_format("ts", "yyyyMMdd HH:mm")
    return tel(spark, sf).select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:00").alias("minute_text"),
        compact.alias("compact"),
        F.to_timestamp(compact, "yyyyMMdd HH:mm").alias("parsed"),
    )


@query(
    "parse_ts_text",
    "SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN date_trunc('minute', ts) END AS parsed FROM events",
)
def parse_ts_text(spark, sf):
    text = F.when(F.col("event_id") % 6 == 0, "soon").otherwise(F.date_format("ts", "MM-dd-yyyy HH:mm"))
    return tel(spark, sf).select("event_id", parse_ts(text, "MM-dd-yyyy HH:mm").alias("parsed"))


@query(
    "math_fns",
    with_tel("""SELECT event_id, CAST(floor(in_octets / 7.0::DOUBLE) AS BIGINT) AS down, CAST(ceil(in_octets / 5.0::DOUBLE) AS BIGINT) AS up,
                       CAST(round(in_octets / 4.0::DOUBLE, 0) AS BIGINT) AS near, in_octets % 7 AS rest,
                       printf('%.3f', (in_octets % 1000) / 8.0::DOUBLE) AS shown FROM tel"""),
)
def math_fns(spark, sf):
    c = F.col("in_octets")
    return tel(spark, sf).select(
        "event_id",
        F.floor(c / 7).alias("down"),
        F.ceil(c / 5).alias("up"),
        F.round(c / 4, 0).cast("long").alias("near"),
        (c % 7).alias("rest"),
        F.format_number((c % 1000) / 8, 3).alias("shown"),
    )


@query(
    "string_fns",
    with_tel("""SELECT event_id, devicename || '|' || interface AS joined, substring(interface, 4, 3) AS part,
                       upper(devicename) AS loud, string_split(interface, '/')[3] AS port,
                       replace(devicename, '-', '_') AS plain, CAST(in_octets AS VARCHAR) AS digits FROM tel"""),
)
def string_fns(spark, sf):
    return tel(spark, sf).select(
        "event_id",
        F.concat("devicename", F.lit("|"), "interface").alias("joined"),
        F.substring("interface", 4, 3).alias("part"),
        F.upper("devicename").alias("loud"),
        F.split("interface", "/")[2].alias("port"),
        F.regexp_replace("devicename", "-", "_").alias("plain"),
        F.decode(F.encode(F.col("in_octets").cast("string"), "UTF-8"), "UTF-8").alias("digits"),
    )


@query(
    "map_get_default",
    with_tel("""SELECT event_id, in_octets AS a, coalesce(nullif(in_errors, 0), 0) AS b, 0 AS absent FROM tel"""),
)
def map_get_default(spark, sf):
    rows = tel(spark, sf).select(
        "event_id",
        F.create_map(F.lit("a"), F.col("in_octets"), F.lit("b"), F.nullif("in_errors", F.lit(0))).alias("m"),
    )
    return rows.select(
        "event_id", *[map_get("m", k, 0).alias(k) for k in ("a", "b", "absent")]
    )


@query(
    "order_by",
    with_tel("SELECT devicename, ts AS start_timestamp, event_id FROM tel ORDER BY devicename, start_timestamp"),
)
def order_by(spark, sf):
    rows = tel(spark, sf).select("devicename", F.col("ts").alias("start_timestamp"), "event_id")
    return rows.orderBy("devicename", "start_timestamp", "event_id")


@query("latest_row", with_tel("SELECT devicename, interface, ts, event_id FROM tel ORDER BY ts DESC, event_id DESC LIMIT 1"))
def latest(spark, sf):
    return latest_row(tel(spark, sf).select(*KEYS, "ts", "event_id"), "ts", ["event_id"])


@query(
    "latest_per_key",
    with_tel("""SELECT devicename, interface, ts, event_id, in_octets FROM tel
                QUALIFY row_number() OVER (PARTITION BY devicename, interface ORDER BY ts DESC, event_id DESC) = 1"""),
)
def latest_of_key(spark, sf):
    rows = tel(spark, sf).select(*KEYS, "ts", "event_id", "in_octets")
    return latest_per_key(rows, KEYS, "ts", ["event_id"])


@query(
    "drop_duplicates",
    with_tel("SELECT DISTINCT devicename, interface, fts, out_errors FROM tel"),
)
def drop_duplicates(spark, sf):
    rows = tel(spark, sf).select(*KEYS, "fts", "out_errors")
    return drop_exact_duplicates(rows.unionByName(rows))
