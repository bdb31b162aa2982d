"""Queries over parsing, flattening and validation of messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from portdelta.catalog.registry import query
from portdelta.catalog.tel import (
    SENT,
    device_messages,
    kind_messages,
    optics_messages,
    poll_messages,
    small_device_messages,
    spread_tel,
    system_list_messages,
    system_messages,
    tel,
    with_tel,
)
from portdelta.functions import with_time_parts
from portdelta.model import (
    ENVELOPE,
    FLAT_COUNTERS,
    OPTICS_ENVELOPE,
    POLL_ENVELOPE,
    SYSTEM_LIST_ENVELOPE,
)
from portdelta.operators import flatten, parse, route
from portdelta.operators.deltas import POLL_RECORD, poll_delta
from portdelta.operators.shred import shred
from portdelta.session import fresh_path
from portdelta.sinks import to_psv

_TS = "make_timestamp((epoch_ns // 100000) * 100)"


@query("parse_value", with_tel("SELECT devicename, event_id, epoch_ns, 1 AS interfaces FROM tel"))
def parse_value(spark, sf):
    rows = parse.parse_value(small_device_messages(spread_tel(spark, sf)), ENVELOPE)
    return rows.select(
        F.col("ucgDeviceName").alias("devicename"),
        F.col("ucgSequenceNum").cast("long").alias("event_id"),
        F.col("ucgJsonData.timestamp").cast("long").alias("epoch_ns"),
        F.size("ucgJsonData.interfaces.interface").cast("long").alias("interfaces"),
    )


@query(
    "parse_head",
    with_tel("""SELECT devicename AS "ucgDeviceName", 'PERF' AS "ucgSource", 'IF' AS "ucgType",
                       epoch_ms AS timestamp, interface, CAST(out_octets AS VARCHAR) AS out_octets FROM tel"""),
)
def parse_head(spark, sf):
    rows = parse.parse_head(system_messages(spread_tel(spark, sf)))
    return rows.select(
        "ucgDeviceName",
        "ucgSource",
        "ucgType",
        "timestamp",
        F.element_at(F.map_keys("interfaces"), 1).alias("interface"),
        F.element_at(F.map_values("interfaces"), 1)["state"]["counters"]["out-octets"].alias("out_octets"),
    )


def _lines(spark, sf):
    """Messages of which four in ten are unusable in different ways."""
    kind, e = F.col("event_id") % 10, F.col("event_id").cast("string")
    head = F.concat(F.lit('{"ucgDeviceName":"'), F.col("devicename"), F.lit('","n":'), e)
    text = (
        F.when(kind == 0, F.concat(F.lit("not json {"), e))
        .when(kind == 1, F.concat(F.lit('{"x":'), e, F.lit("}")))
        .when(kind == 2, F.concat(head, F.lit("}")))
        .when(kind == 3, F.concat(head, F.lit(',"ucgJsonData":{"interfaces":{}}}')))
        .otherwise(F.concat(head, F.lit(',"ucgJsonData":{"interfaces":{"interface":{}}}}')))
    )
    return spread_tel(spark, sf).select(text.alias("value"))


_LINES = """lines AS (
  SELECT event_id % 10 AS kind, CASE event_id % 10
    WHEN 0 THEN 'not json {' || event_id
    WHEN 1 THEN '{"x":' || event_id || '}'
    WHEN 2 THEN '{"ucgDeviceName":"' || devicename || '","n":' || event_id || '}'
    WHEN 3 THEN '{"ucgDeviceName":"' || devicename || '","n":' || event_id || ',"ucgJsonData":{"interfaces":{}}}'
    ELSE '{"ucgDeviceName":"' || devicename || '","n":' || event_id
         || ',"ucgJsonData":{"interfaces":{"interface":{}}}}' END AS value
  FROM tel)"""


@query("validate_envelope", with_tel("SELECT value FROM lines WHERE kind > 3", _LINES))
def validate_envelope(spark, sf):
    return parse.validate_envelope(_lines(spark, sf))[0]


@query(
    "rejected_records",
    with_tel(
        """SELECT value, CASE kind WHEN 0 THEN 'not_json' WHEN 1 THEN 'no_device' WHEN 2 THEN 'no_data'
                  ELSE 'no_interfaces' END AS reject_reason FROM lines WHERE kind <= 3""",
        _LINES,
    ),
)
def rejected_records(spark, sf):
    return parse.validate_envelope(_lines(spark, sf))[1]


_SENT_COLS = [n for n in SENT if n != "in_errors"]
_OWN = ", ".join(_SENT_COLS) + ", nullif(in_errors, 0) AS in_errors"


@query(
    "explode_interfaces",
    with_tel(f"""SELECT devicename, {_TS} AS timestamp, interface, {_OWN}, event_id % 2 AS in_unknown_protos
                 FROM tel
                 UNION ALL
                 SELECT devicename, {_TS}, 'lo0', {", ".join("NULL" if n != "in_octets" else "CASE WHEN event_id % 10 <> 0 THEN in_octets + 1 END" for n in _SENT_COLS)},
                        NULL, CASE WHEN event_id % 10 <> 0 THEN 3 END FROM tel"""),
)
def explode_interfaces(spark, sf):
    rows = flatten.explode_interfaces(parse.parse_value(device_messages(spread_tel(spark, sf)), ENVELOPE))
    return rows.select("devicename", "timestamp", "interface", *_SENT_COLS, "in_errors", "in_unknown_protos")


@query(
    "explode_subinterfaces",
    with_tel(f"""SELECT devicename, {_TS} AS timestamp, interface, subinterface, in_octets + 5000000000 AS in_octets,
                        in_pkts, out_octets, out_pkts FROM tel"""),
)
def explode_subinterfaces(spark, sf):
    rows = flatten.explode_subinterfaces(parse.parse_value(device_messages(spread_tel(spark, sf)), ENVELOPE))
    return rows.select(
        "devicename", "timestamp", "interface", "subinterface", "in_octets", "in_pkts", "out_octets", "out_pkts"
    )


def _flat_sql(interface: str, values: dict[str, str], where: str = "true", sub: str | None = None) -> str:
    counters = ", ".join(f"{values.get(name, '0')} AS {name}" for name in FLAT_COUNTERS)
    tail = f", {sub} AS subinterface" if sub else ""
    return f"""SELECT devicename AS "ucgDeviceName", %s, epoch_ns AS timestamp, {interface} AS interface,
               {counters}{tail} FROM tel WHERE {where}"""


_OWN_VALUES = {n: n for n in FLAT_COUNTERS if n in SENT} | {"in_unknown_protos": "event_id % 2"}
_LOOP_VALUES = {
    "in_octets": "CASE WHEN event_id % 10 <> 0 THEN in_octets + 1 ELSE 0 END",
    "in_unknown_protos": "CASE WHEN event_id % 10 <> 0 THEN 3 ELSE 0 END",
}
_SUB_VALUES = {
    "in_octets": "in_octets + 5000000000",
    "in_pkts": "in_pkts",
    "out_octets": "out_octets",
    "out_pkts": "out_pkts",
}
_TEXTS = """'PERF' AS "ucgSource", '' AS "ucgType" """
_TEXTS_STRICT = """'PERF' AS "ucgSource", CAST(NULL AS VARCHAR) AS "ucgType" """


@query(
    "flatten_all",
    with_tel(
        "\nUNION ALL\n".join(
            part.replace("%s", _TEXTS, 1)
            for part in [
                _flat_sql("interface", _OWN_VALUES, sub="'none'"),
                _flat_sql("'lo0'", _LOOP_VALUES, sub="'none'"),
                _flat_sql("interface", _SUB_VALUES, sub="subinterface"),
            ]
        )
    ),
)
def flatten_all(spark, sf):
    return flatten.flatten_all(parse.parse_value(device_messages(spread_tel(spark, sf)), ENVELOPE))


@query(
    "flatten_strict",
    with_tel(
        "\nUNION ALL\n".join(
            part.replace("%s", _TEXTS_STRICT, 1)
            for part in [
                _flat_sql("interface", _OWN_VALUES, "event_id % 10 <> 0"),
                _flat_sql("'lo0'", _LOOP_VALUES, "event_id % 10 <> 0"),
            ]
        )
    ),
)
def flatten_strict(spark, sf):
    return flatten.flatten_strict(parse.parse_value(device_messages(spread_tel(spark, sf)), ENVELOPE))


_TEXT_COUNTERS = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in SENT)


@query(
    "explode_interface_list",
    with_tel(f"SELECT devicename, CAST(epoch_ms AS VARCHAR) AS timestamp, interface, {_TEXT_COUNTERS} FROM tel"),
)
def explode_interface_list(spark, sf):
    return flatten.explode_interface_list(
        parse.parse_value(system_list_messages(spread_tel(spark, sf)), SYSTEM_LIST_ENVELOPE)
    )


_CH = "devicename AS \"ucgDeviceName\", 'oc-' || interface AS component"


@query(
    "flatten_optics",
    with_tel(
        "\nUNION ALL\n".join(
            f"""SELECT {_CH}, '{n}' AS channel, 'ch ' || subinterface AS description,
                in_octets % 1000 - 500 + {n} AS input_power_instant, in_discards AS laser_bias_current_instant,
                in_errors AS output_power_instant, out_discards AS target_output_power,
                event_id % 2 = 0 AS tx_laser, epoch_ns AS timestamp FROM tel"""
            for n in (0, 1)
        )
    ),
)
def flatten_optics(spark, sf):
    return flatten.flatten_optics(parse.parse_value(optics_messages(spread_tel(spark, sf)), OPTICS_ENVELOPE))


@query(
    "flatten_nested",
    with_tel("""SELECT event_id, devicename AS head_device, in_octets AS head_counters_in,
                       out_octets AS head_counters_out, n AS parts_n, n * in_octets AS parts_detail_product
                FROM tel, (VALUES (1), (2)) AS p(n)"""),
)
def flatten_nested(spark, sf):
    def part(n: int):
        product = F.struct((F.col("in_octets") * n).alias("product"))
        return F.struct(F.lit(n).alias("n"), product.alias("detail"))

    counters = F.struct(F.col("in_octets").alias("in"), F.col("out_octets").alias("out"))
    nested = tel(spark, sf).select(
        "event_id",
        F.struct(F.col("devicename").alias("device"), counters.alias("counters")).alias("head"),
        F.array(part(1), part(2)).alias("parts"),
    )
    return flatten.flatten_nested(nested)


@query(
    "shred_messages",
    with_tel(
        """SELECT 'interface' AS path, event_id, interface AS place1, NULL AS place2, in_octets AS value FROM tel
           UNION ALL SELECT 'subinterface', event_id, interface, subinterface, in_octets + 5000000000 FROM tel
           UNION ALL SELECT 'interface', event_id, 'lo0', NULL, CASE WHEN event_id % 10 <> 0 THEN in_octets + 1 END FROM tel"""
    ),
)
def shred_messages(spark, sf):
    """Interfaces and their sub-interfaces, both maps, as a table each; the message's number is the key."""
    parsed = parse.parse_value(device_messages(spread_tel(spark, sf)), ENVELOPE)
    named = parsed.select(F.col("ucgSequenceNum").cast("long").alias("event_id"), F.col("ucgJsonData.interfaces.interface").alias("interface"))
    tables = shred(named, ["event_id"])
    own, subs = tables["interface"], tables["interface.subinterfaces_subinterface"]
    own = own.select(F.lit("interface").alias("path"), "event_id", F.col("interface__key").alias("place1"), F.lit(None).cast("string").alias("place2"), F.col("`state_counters_in-octets`").alias("value"))
    place = F.col("`interface.subinterfaces_subinterface__key`").alias("place2")
    subs = subs.select(F.lit("subinterface").alias("path"), "event_id", F.col("interface__key").alias("place1"), place, F.col("`state_counters_in-octets`").alias("value"))
    return own.union(subs)


@query(
    "split_record_kinds",
    with_tel(
        f"""SELECT CASE event_id % 4 WHEN 0 THEN 'interface_counters' WHEN 1 THEN 'subinterface_counters'
                        WHEN 2 THEN 'interface_status' ELSE 'subinterface_status' END AS kind,
                   devicename, {_TS} AS timestamp, interface,
                   CASE WHEN event_id % 2 = 1 THEN subinterface ELSE '-' END AS subinterface,
                   CASE event_id % 4 WHEN 2 THEN 'UP 100000 9192' WHEN 3 THEN 'DOWN'
                        ELSE CAST(in_octets AS VARCHAR) END AS content
            FROM tel"""
    ),
)
def split_record_kinds(spark, sf):
    kinds = parse.split_record_kinds(parse.parse_value(kind_messages(spread_tel(spark, sf)), ENVELOPE))
    content = {
        "interface_counters": F.col("in_octets").cast("string"),
        "subinterface_counters": F.col("in_octets").cast("string"),
        "interface_status": F.concat_ws(" ", "admin_status", "high_speed", "mtu"),
        "subinterface_status": F.col("oper_status"),
    }
    out = None
    for name, rows in kinds.items():
        sub = F.col("subinterface") if "subinterface" in rows.columns else F.lit("-")
        one = rows.select(
            F.lit(name).alias("kind"),
            "devicename",
            "timestamp",
            "interface",
            sub.alias("subinterface"),
            content[name].alias("content"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "route_records",
    with_tel(
        f"""SELECT CASE event_id % 4 WHEN 0 THEN 'interface_counters' WHEN 1 THEN 'subinterface_counters'
                        WHEN 2 THEN 'interface_status' ELSE 'subinterface_status' END AS kind,
                   devicename, {_TS} AS timestamp, interface, CASE WHEN event_id % 2 = 1 THEN subinterface END AS subinterface,
                   CASE WHEN event_id % 4 < 2 THEN in_octets END AS in_octets, CASE event_id % 4 WHEN 2 THEN 'UP' END AS admin_status,
                   CASE event_id % 4 WHEN 3 THEN 'DOWN' END AS oper_status, NULL AS reject_reason, NULL AS value
            FROM tel
            UNION ALL
            SELECT 'rejected', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
                   CASE kind WHEN 0 THEN 'not_json' WHEN 1 THEN 'no_device' WHEN 2 THEN 'no_data' ELSE 'no_interfaces' END, value
            FROM lines WHERE kind <= 3""",
        _LINES,
    ),
)
def route_records(spark, sf):
    path = fresh_path(spark, "routed")
    messages = kind_messages(spread_tel(spark, sf)).select(F.col("value").cast("string")).union(_lines(spark, sf))
    route.write_routed(messages, path)
    wanted = ["devicename", "timestamp", "interface", "subinterface", "in_octets", "admin_status", "oper_status", "reject_reason", "value"]
    out = None
    for kind in route.KIND_COLUMNS:
        one = route.read_kind(spark, path, kind).withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.select("kind", *wanted)


def _poll(spark, sf):
    return parse.parse_value(poll_messages(spread_tel(spark, sf)), POLL_ENVELOPE, keep=("src",))


_POLL = """poll AS (
  SELECT event_id, epoch_ms, devicename, CASE WHEN event_id % 50 <> 0 THEN interface END AS if_descr,
         CASE WHEN event_id % 20 <> 0 THEN 'poller' END AS src,
         CASE WHEN event_id % 5 <> 0 THEN 'IP' ELSE 'ip' END AS data_type,
         tag, orient, (in_octets % 50) * 100 AS up_diff,
         CASE tag WHEN '100.0' THEN in_octets_cum WHEN '103' THEN out_octets ELSE in_octets_cum END AS v,
         CASE tag WHEN '100.0' THEN CASE WHEN event_id % 9 <> 0 THEN in_octets_cum - in_octets % 500 + 100 END
                  WHEN '103' THEN out_octets - out_pkts ELSE in_octets_cum END AS p
  FROM tel, (VALUES ('100.0', '1'), ('103', '0'), ('7', '1')) AS el(tag, orient))"""
_QUARTER = "make_timestamp((epoch_ms // 900000) * 900000000)"
_BYTES = """greatest(coalesce(CAST(CASE WHEN orient = '{0}' THEN v - p END AS DOUBLE), 0.0), 0.0)"""
_POLL_DELTA = f"""polled AS (
  SELECT devicename AS "deviceName", if_descr AS "ifDescr", {_QUARTER} AS measurement_time_15min,
         {_BYTES.format(1)} AS "bytesInValue", {_BYTES.format(0)} AS "bytesOutValue",
         up_diff / 100.0::DOUBLE AS "deltaTime", coalesce(src, 'UNKNOWN') AS src,
         strftime({_QUARTER}, '%Y%m%d') AS date
  FROM poll WHERE data_type = 'IP' AND tag <> '7')"""


@query(
    "explode_elements",
    with_tel(
        """SELECT devicename AS "deviceName", if_descr AS "ifDescr", src, tag AS "oidTag", orient,
                  CAST(v AS VARCHAR) AS value, CAST(p AS VARCHAR) AS "previousValue" FROM poll""",
        _POLL,
    ),
)
def explode_elements(spark, sf):
    return flatten.explode_elements(_poll(spark, sf)).select(
        "deviceName", "ifDescr", "src", "oidTag", "orient", "value", "previousValue"
    )


@query("poll_delta", with_tel("SELECT * FROM polled", _POLL, _POLL_DELTA))
def poll_deltas(spark, sf):
    return poll_delta(flatten.explode_elements(_poll(spark, sf)))


@query(
    "to_psv",
    with_tel(
        """SELECT "deviceName" || '|' || "ifDescr" || '|' || strftime(measurement_time_15min, '%Y-%m-%d %H:%M:%S')
                  || '|' || "bytesInValue" || '|' || "bytesOutValue" || '|' || "deltaTime" || '|' || src
                  || '|' || date AS value
           FROM polled WHERE src <> 'UNKNOWN'""",
        _POLL,
        _POLL_DELTA,
    ),
)
def psv(spark, sf):
    rows = poll_delta(flatten.explode_elements(_poll(spark, sf)), dataset="Poller")
    return to_psv(rows, POLL_RECORD).select("value")


@query(
    "flatten_time_parts",
    with_tel(
        f"""SELECT devicename, {_TS} AS timestamp, interface, in_octets, CAST({_TS} AS DATE) AS datetype,
                   hour({_TS}) AS hour, minute({_TS}) AS min, second({_TS}) AS sec FROM tel"""
    ),
)
def flatten_with_time_parts(spark, sf):
    rows = flatten.explode_interfaces(parse.parse_value(small_device_messages(spread_tel(spark, sf)), ENVELOPE))
    return with_time_parts(rows.select("devicename", "timestamp", "interface", "in_octets"), "timestamp")
