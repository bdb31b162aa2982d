"""All record kinds and the rejects of a topic from one parse and one write.

Each message becomes the rows of every kind it holds, or one row with the reason why it cannot be used. They
are written by one job, a folder for each kind, and replaced as a whole when the job is repeated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portdelta.model import ENVELOPE, INTERFACE_COUNTERS, struct_from
from portdelta.operators.flatten import counter_columns, message_head
from portdelta.operators.parse import CORRUPT, PERMISSIVE, once

REJECTED = "rejected"
_COUNTERS = [n.replace("-", "_") for n in INTERFACE_COUNTERS if not n.endswith("-unknown-proto-pkts")]
_HEAD, _SUB_HEAD = ["devicename", "timestamp", "interface"], ["devicename", "timestamp", "interface", "subinterface"]

# Columns of each kind, and the one whose presence makes a record of that kind.
KIND_COLUMNS = {
    "interface_counters": [*_HEAD, *_COUNTERS],
    "subinterface_counters": [*_SUB_HEAD, *_COUNTERS],
    "interface_status": [*_HEAD, "high_speed", "admin_status", "ifindex", "oper_status", "mtu"],
    "subinterface_status": [*_SUB_HEAD, "ifindex", "admin_status", "oper_status"],
    REJECTED: ["value", "reject_reason"],
}
_MARK = {"interface_counters": "in_octets", "subinterface_counters": "in_octets", "interface_status": "admin_status", "subinterface_status": "oper_status"}


def _state_types(kind: str) -> dict[str, T.DataType]:
    state = ENVELOPE["ucgJsonData"].dataType["interfaces"].dataType["interface"].dataType.valueType
    if kind.startswith("sub"):
        state = state["subinterfaces"].dataType["subinterface"].dataType.valueType
    return {f.name.replace("-", "_"): f.dataType for f in state["state"].dataType.fields}


def _record(kind: str, interface: Column, subinterface: Column, state: Column) -> Column:
    """A record of ``kind`` as a struct that has the columns of all kinds but the head's."""
    none = F.lit(None)
    values = {name: none.cast("long") for name in _COUNTERS}
    if kind.endswith("counters"):
        values = dict(zip(_COUNTERS, counter_columns(state["counters"])))
    types = _state_types(kind)
    for name in ("high_speed", "admin_status", "ifindex", "oper_status", "mtu"):
        sent = kind.endswith("status") and name in KIND_COLUMNS[kind] and name in types
        values[name] = (state[name.replace("_", "-")] if sent else none).cast("string")
    return F.struct(
        F.lit(kind).alias("kind"), interface.cast("string").alias("interface"), subinterface.cast("string").alias("subinterface"), *[c.alias(n) for n, c in values.items()]
    )


def _records(interfaces: Column) -> Column:
    """All records of a message's interfaces, those that are not sent left out."""

    def of_sub(name: Column, sub: Column) -> Column:
        index = F.coalesce(sub["value"]["index"], sub["key"])
        return F.array(*[_record(k, name, index, sub["value"]["state"]) for k in ("subinterface_counters", "subinterface_status")])

    def of_interface(entry: Column) -> Column:
        name, value = F.coalesce(entry["value"]["name"], entry["key"]), entry["value"]
        own = F.array(*[_record(k, name, F.lit(None), value["state"]) for k in ("interface_counters", "interface_status")])
        subs = F.flatten(F.transform(F.map_entries(value["subinterfaces"]["subinterface"]), lambda sub: of_sub(name, sub)))
        return F.when(subs.isNull(), own).otherwise(F.concat(own, subs))

    every = F.flatten(F.transform(F.map_entries(interfaces), of_interface))
    sent = [lambda r, k=k, c=c: (r["kind"] == k) & r[c].isNotNull() for k, c in _MARK.items()]
    return F.filter(every, lambda r: reduce(Column.__or__, [test(r) for test in sent]))


def checked_messages(df: DataFrame, col: str = "value") -> DataFrame:
    """The envelope's fields, ``reject_reason`` (NULL for a usable message) and the text as ``value``, from one parse."""
    shape = struct_from({**{f.name: f.dataType for f in ENVELOPE.fields}, CORRUPT: "string"})
    text = F.col(col).cast("string")
    parsed = df.select(text.alias("value"), once(F.from_json(text, shape, PERMISSIVE)).alias("_m")).select("value", "_m.*")
    data = F.col("ucgJsonData")
    reason = (
        # A field of the wrong type is NULL and no reason to reject; what is no JSON has no field at all.
        F.when((F.col("value").isNull() | F.col(CORRUPT).isNotNull()) & F.col("ucgDeviceName").isNull() & data.isNull(), "not_json")
        .when(F.col("ucgDeviceName").isNull(), "no_device")
        .when(data.isNull(), "no_data")
        .when(data["interfaces"]["interface"].isNull(), "no_interfaces")
    )
    return parsed.withColumn("reject_reason", reason).drop(CORRUPT)


def route_records(df: DataFrame, col: str = "value") -> DataFrame:
    """Rows of all kinds with column ``kind``; an unusable message is one row of kind ``rejected``.

    A column that a kind does not have is NULL. The message is read, parsed and exploded once.
    """
    interfaces = F.col("ucgJsonData")["interfaces"]["interface"]
    checked = checked_messages(df, col).select(*message_head(), "value", "reject_reason", interfaces.alias("_i"))
    nothing = _record("interface_counters", F.lit(None), F.lit(None), F.map_values("_i")[0]["state"])
    rejected = F.array(nothing.withField("kind", F.lit(REJECTED)))
    records = F.when(F.col("reject_reason").isNull(), _records(F.col("_i"))).otherwise(rejected)
    rows = checked.select("devicename", "timestamp", "value", "reject_reason", F.explode(records).alias("_r"))
    out = rows.select("devicename", "timestamp", "_r.*", "reject_reason", F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("value"))
    return out.select("kind", *dict.fromkeys(c for cols in KIND_COLUMNS.values() for c in cols))


def write_routed(df: DataFrame, path: str, col: str = "value") -> None:
    """Every kind and the rejects below ``path``, a folder each, in one job; a repeated job replaces them all."""
    route_records(df, col).write.mode("overwrite").partitionBy("kind").parquet(path)


def read_kind(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The rows of one kind; only its folder and its columns are read."""
    return spark.read.parquet(path).where(F.col("kind") == kind).select(*KIND_COLUMNS[kind])
