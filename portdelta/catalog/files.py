"""Queries over sources and sinks. What is read back was written by the query itself."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from portdelta.catalog.registry import query
from portdelta.catalog.tel import small_device_messages, spread_tel, table, tel, with_tel
from portdelta.operators.parse import parse_value
from portdelta.session import fresh_path
from portdelta.sinks import (
    append_table,
    ensure_table,
    insert_select,
    rows_to_json_value,
    stage_and_append,
    write_files,
    write_json_lines,
    write_new_table,
)
from portdelta.sources import parse_csv_message, read_envelopes, read_json_inferred, read_lines, read_properties, read_table

_COLS = ["event_id", "devicename", "interface", "in_octets"]
_PLAIN = with_tel(f"SELECT {', '.join(_COLS)} FROM tel")


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _message_folder(spark, sf: str) -> str:
    path = fresh_path(spark, "messages")
    small_device_messages(spread_tel(spark, sf)).select(F.col("value").cast("string")).write.text(path)
    return path


@query(
    "scan_json_schema",
    with_tel("""SELECT event_id, devicename, epoch_ns, interface, in_octets, out_octets FROM tel"""),
)
def scan_json_schema(spark, sf):
    rows = read_envelopes(spark, _message_folder(spark, sf))
    return rows.select(
        F.col("ucgSequenceNum").cast("long").alias("event_id"),
        F.col("ucgDeviceName").alias("devicename"),
        F.col("ucgJsonData.timestamp").cast("long").alias("epoch_ns"),
        F.explode("ucgJsonData.interfaces.interface").alias("interface", "_if"),
    ).select(
        "event_id",
        "devicename",
        "epoch_ns",
        "interface",
        F.col("_if.state.counters.in-octets").alias("in_octets"),
        F.col("_if.state.counters.out-octets").alias("out_octets"),
    )


@query("scan_json_infer", _PLAIN)
def scan_json_infer(spark, sf):
    path = fresh_path(spark, "json")
    write_files(tel(spark, sf).select(*_COLS), path, "json")
    return read_json_inferred(spark, path, multiline=False).select(*_COLS)


@query("scan_text_lines", with_tel("SELECT event_id, devicename FROM tel"))
def scan_text_lines(spark, sf):
    lines = read_lines(spark, _message_folder(spark, sf))
    return lines.select(
        F.get_json_object("value", "$.ucgSequenceNum").cast("long").alias("event_id"),
        F.get_json_object("value", "$.ucgDeviceName").alias("devicename"),
    )


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def scan_table(spark, sf):
    rows = read_table(spark, f"{sf}/customer.parquet").where(F.col("c_mktsegment") == "BUILDING")
    return rows.select("c_custkey", "c_name", "c_nationkey")


@query("scan_properties", "SELECT c_name AS key, c_custkey || '=' || c_nationkey AS value FROM customer")
def scan_properties(spark, sf):
    path = fresh_path(spark, "properties")
    table(spark, sf, "customer").select(F.concat_ws("=", "c_name", "c_custkey", "c_nationkey")).write.text(path)
    return read_properties(spark, path)


@query(
    "parse_csv_message",
    with_tel("""SELECT '10.0.' || in_discards || '.' || in_errors AS ip_address,
                       CASE WHEN event_id % 3 <> 0 THEN 'IP' END AS datatype FROM tel"""),
)
def parse_csv(spark, sf):
    address = F.concat_ws(".", F.lit("10.0"), "in_discards", "in_errors")
    text = F.concat_ws(",", address, F.when(F.col("event_id") % 3 != 0, "IP"))
    messages = tel(spark, sf).select(text.cast("binary").alias("value"))
    return parse_csv_message(messages, ["ip_address", "datatype"])


@query("write_csv_roundtrip", _PLAIN)
def write_csv_roundtrip(spark, sf):
    path, rows = fresh_path(spark, "csv"), tel(spark, sf).select(*_COLS)
    write_files(rows, path, "csv")
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query("write_json_roundtrip", _PLAIN)
def write_json_roundtrip(spark, sf):
    path, rows = fresh_path(spark, "json"), tel(spark, sf).select(*_COLS)
    write_files(rows, path, "json")
    return spark.read.schema(rows.schema).json(path)


@query("write_parquet_roundtrip", with_tel(f"SELECT {', '.join(_COLS)}, fts FROM tel"))
def write_parquet_roundtrip(spark, sf):
    path, rows = fresh_path(spark, "parquet"), tel(spark, sf).select(*_COLS, "fts")
    write_files(rows, path, "parquet")
    return spark.read.parquet(path)


@query("write_text_json", _PLAIN)
def write_text_json(spark, sf):
    path, rows = fresh_path(spark, "lines"), tel(spark, sf).select(*_COLS)
    write_json_lines(rows, path)
    return parse_value(read_lines(spark, path), rows.schema)


@query(
    "rows_to_json_value",
    with_tel("""SELECT '{"event_id":' || event_id || ',"devicename":"' || devicename || '"'
                       || CASE WHEN in_errors <> 0 THEN ',"in_errors":' || in_errors ELSE '' END || '}' AS value
                FROM tel"""),
)
def rows_to_json(spark, sf):
    rows = tel(spark, sf).select(
        "event_id", "devicename", F.when(F.col("in_errors") != 0, F.col("in_errors")).alias("in_errors")
    )
    return rows_to_json_value(rows)


@query("append_table", _PLAIN)
def append_to_table(spark, sf):
    name, path = _name("appended"), fresh_path(spark, "table")
    rows = tel(spark, sf).select(*_COLS)
    first = rows.where(F.col("event_id") % 2 == 0)
    append_table(first, name, options={"path": path})
    append_table(rows.where(F.col("event_id") % 2 != 0), name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("insert_select", with_tel("SELECT interface, devicename, in_octets, event_id FROM tel"))
def insert_rows(spark, sf):
    name, path = _name("inserted"), fresh_path(spark, "table")
    rows = tel(spark, sf).select(*_COLS)
    target = rows.select("interface", "devicename", "in_octets", "event_id")
    ensure_table(spark, name, target.schema, path)
    insert_select(rows, name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query(
    "ctas_copy",
    with_tel("SELECT devicename, interface, count(*) AS samples, max(in_octets) AS high FROM tel GROUP BY ALL"),
)
def ctas_copy(spark, sf):
    rows = tel(spark, sf).groupBy("devicename", "interface").agg(
        F.count(F.lit(1)).alias("samples"), F.max("in_octets").alias("high")
    )
    dest, path = _name("dest"), fresh_path(spark, "dest")
    ensure_table(spark, dest, rows.schema, path)
    stage_and_append(rows, _name("stage"), dest, fresh_path(spark, "stage"))
    spark.sql(f"DROP TABLE {dest}")
    return spark.read.parquet(path)


@query("write_new_table", "SELECT n_nationkey, n_name FROM nation")
def new_table(spark, sf):
    name, path = _name("fresh"), fresh_path(spark, "table")
    write_new_table(table(spark, sf, "nation").select("n_nationkey", "n_name"), name, path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)
