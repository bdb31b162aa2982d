"""Nested messages to flat rows. Every operator is a projection or a generator: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portdelta.functions.time import ts_from_ns
from portdelta.model import FLAT_COUNTERS, INTERFACE_COUNTERS


def normalise_names(df: DataFrame) -> DataFrame:
    """Hyphens in column names become underscores."""
    return df.toDF(*[c.replace("-", "_") for c in df.columns])


def _counter(counters: Column, name: str) -> Column:
    """One counter by its flat name; both spellings of the unknown-protocol counters count."""
    if name.endswith("_unknown_protos"):
        side = name.split("_")[0]
        return F.coalesce(counters[f"{side}-unknown-protos"], counters[f"{side}-unknown-proto-pkts"])
    return counters[name.replace("_", "-")]


def counter_columns(counters: Column) -> list[Column]:
    flat = [n.replace("-", "_") for n in INTERFACE_COUNTERS if not n.endswith("-unknown-proto-pkts")]
    return [_counter(counters, name).alias(name) for name in flat]


def message_head() -> list[Column]:
    return [
        F.col("ucgDeviceName").alias("devicename"),
        ts_from_ns(F.col("ucgJsonData.timestamp").try_cast("long")).alias("timestamp"),
    ]


def _interfaces(df: DataFrame) -> DataFrame:
    return df.select(*message_head(), F.explode("ucgJsonData.interfaces.interface").alias("_key", "_if")).select(
        "devicename", "timestamp", F.coalesce("_if.name", "_key").alias("interface"), "_if"
    )


def _subinterfaces(df: DataFrame) -> DataFrame:
    return (
        _interfaces(df)
        .select(
            "devicename",
            "timestamp",
            "interface",
            F.explode("_if.subinterfaces.subinterface").alias("_key", "_sub"),
        )
        .select(
            "devicename",
            "timestamp",
            "interface",
            F.coalesce("_sub.index", "_key").alias("subinterface"),
            "_sub",
        )
    )


def explode_interfaces(df: DataFrame) -> DataFrame:
    """One row per interface with all counters."""
    return _interfaces(df).select(
        "devicename", "timestamp", "interface", *counter_columns(F.col("_if.state.counters"))
    )


def explode_subinterfaces(df: DataFrame) -> DataFrame:
    """One row per sub-interface with all counters."""
    return _subinterfaces(df).select(
        "devicename", "timestamp", "interface", "subinterface", *counter_columns(F.col("_sub.state.counters"))
    )


def explode_status(df: DataFrame) -> DataFrame:
    """One row per interface with its status fields."""
    out = _interfaces(df).withColumn("_s", F.col("_if.state"))
    return out.select(
        "devicename",
        "timestamp",
        "interface",
        F.col("_s.high-speed").alias("high_speed"),
        F.col("_s.admin-status").alias("admin_status"),
        F.col("_s.ifindex").alias("ifindex"),
        F.col("_s.oper-status").alias("oper_status"),
        F.col("_s.mtu").alias("mtu"),
    )


def explode_subinterface_status(df: DataFrame) -> DataFrame:
    """One row per sub-interface with its status fields."""
    out = _subinterfaces(df).withColumn("_s", F.col("_sub.state"))
    return out.select(
        "devicename",
        "timestamp",
        "interface",
        "subinterface",
        F.col("_s.ifindex").alias("ifindex"),
        F.col("_s.admin-status").alias("admin_status"),
        F.col("_s.oper-status").alias("oper_status"),
    )


def _flat_head() -> list[Column]:
    return [
        "ucgDeviceName",
        F.coalesce("ucgSource", F.lit("")).alias("ucgSource"),
        F.coalesce("ucgType", F.lit("")).alias("ucgType"),
        F.coalesce(F.col("ucgJsonData.timestamp"), F.lit("0")).try_cast("long").alias("timestamp"),
    ]


def _filled(counters: Column, missing: str) -> list[Column]:
    if missing not in ("zero", "null"):
        raise ValueError(f"unknown missing policy {missing!r}")
    cols = [(name, _counter(counters, name)) for name in FLAT_COUNTERS]
    if missing == "zero":
        cols = [(name, F.coalesce(c, F.lit(0).cast("long"))) for name, c in cols]
    return [c.alias(name) for name, c in cols]


def flatten_all(df: DataFrame, missing: str = "zero") -> DataFrame:
    """Interface rows (``subinterface`` = ``none``) and sub-interface rows of each message.

    An absent counter is 0 or NULL by ``missing``. A message without a readable time yields no row.
    """
    own = F.array(F.struct(F.lit("none").alias("sub"), F.col("_if.state.counters").alias("c")))
    subs = F.transform(
        F.map_entries("_if.subinterfaces.subinterface"),
        lambda e: F.struct(e["key"].alias("sub"), e["value"]["state"]["counters"].alias("c")),
    )
    # One generator emits both kinds, so each message is parsed and read once.
    both = F.when(F.col("_if.subinterfaces.subinterface").isNull(), own).otherwise(F.concat(own, subs))
    head = ["ucgDeviceName", "ucgSource", "ucgType", "timestamp"]
    return (
        df.select(*_flat_head(), F.explode("ucgJsonData.interfaces.interface").alias("interface", "_if"))
        .where(F.col("timestamp").isNotNull())
        .select(*head, "interface", F.explode(both).alias("_r"))
        .select(*head, "interface", *_filled(F.col("_r.c"), missing), F.col("_r.sub").alias("subinterface"))
    )


def flatten_strict(df: DataFrame) -> DataFrame:
    """Interface rows only; a message with any interface lacking counters is dropped whole."""
    interfaces = F.col("ucgJsonData.interfaces.interface")
    complete = F.forall(F.map_values(interfaces), lambda v: v["state"]["counters"].isNotNull())
    head = [
        "ucgDeviceName",
        "ucgSource",
        "ucgType",
        F.coalesce(F.col("ucgJsonData.timestamp"), F.lit("0")).try_cast("long").alias("timestamp"),
    ]
    return (
        df.where(complete)
        .select(*head, F.explode(interfaces).alias("interface", "_if"))
        .where(F.col("timestamp").isNotNull())
        .select(
            "ucgDeviceName",
            "ucgSource",
            "ucgType",
            "timestamp",
            "interface",
            *_filled(F.col("_if.state.counters"), "zero"),
        )
    )


def explode_system(df: DataFrame) -> DataFrame:
    """Parsed ``system`` messages: one row per interface, counters as sent (text), time in ms."""
    out = df.select(
        F.col("system.metaData.ucgDeviceName").alias("devicename"),
        F.col("system.timestamp").alias("timestamp"),
        F.explode("system.perf.interfaces.interface").alias("_key", "_if"),
    )
    return normalise_names(
        out.select(
            "devicename", "timestamp", F.coalesce("_if.name", "_key").alias("interface"), "_if.state.counters.*"
        )
    )


def explode_interface_list(df: DataFrame) -> DataFrame:
    """As ``explode_system`` for messages that send interfaces as a list; a map is taken as its values."""
    interfaces = F.col("system.perf.interfaces.interface")
    kind = df.select(interfaces.alias("i")).schema["i"].dataType
    if isinstance(kind, T.MapType):
        interfaces = F.map_values(interfaces)
    out = df.select(
        F.col("system.metaData.ucgDeviceName").alias("devicename"),
        F.col("system.timestamp").alias("timestamp"),
        F.explode(interfaces).alias("_if"),
    )
    return normalise_names(
        out.select("devicename", "timestamp", F.col("_if.name").alias("interface"), "_if.state.counters.*")
    )


def explode_elements(df: DataFrame, col: str = "elements") -> DataFrame:
    """One row per polled element; fields of the message are copied, element fields win on a name clash."""
    fields = df.schema[col].dataType.elementType.names
    head = [c for c in df.columns if c != col and c not in fields]
    return df.select(*head, F.explode(col).alias("_e")).select(*head, "_e.*")


def flatten_optics(df: DataFrame) -> DataFrame:
    """One row per optical channel of each component."""
    state = "_ch.state"
    return (
        df.select(
            "ucgDeviceName",
            F.col("ucgJsonData.timestamp").alias("timestamp"),
            F.explode("ucgJsonData.components.component").alias("component", "_c"),
        )
        .select(
            "ucgDeviceName",
            "timestamp",
            "component",
            F.explode("_c.transceiver.physical-channels.channel").alias("channel", "_ch"),
        )
        .select(
            "ucgDeviceName",
            "component",
            "channel",
            F.col(f"{state}.description").alias("description"),
            F.col(f"{state}.input-power.instant").alias("input_power_instant"),
            F.col(f"{state}.laser-bias-current.instant").alias("laser_bias_current_instant"),
            F.col(f"{state}.output-power.instant").alias("output_power_instant"),
            F.col(f"{state}.target-output-power").alias("target_output_power"),
            F.col(f"{state}.tx-laser").alias("tx_laser"),
            "timestamp",
        )
    )


def _leaves(schema: T.StructType, path: tuple[str, ...]) -> list[tuple[tuple[str, ...], T.DataType]]:
    out: list[tuple[tuple[str, ...], T.DataType]] = []
    for field in schema.fields:
        here = path + (field.name,)
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, here)
        else:
            out.append((here, field.dataType))
    return out


def flatten_nested(df: DataFrame, sep: str = "_", explode_arrays: bool = True, outer: bool = False) -> DataFrame:
    """Any nested schema to flat columns: struct fields get prefixed names, arrays one row per element.

    ``outer`` keeps rows whose array is empty or NULL.
    """
    gen = F.explode_outer if outer else F.explode
    while True:
        leaves = _leaves(df.schema, ())
        df = df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path, _ in leaves])
        arrays = [sep.join(path) for path, kind in leaves if isinstance(kind, T.ArrayType)]
        if not explode_arrays or not arrays:
            return df
        for name in arrays:
            df = df.select(*[gen(F.col(f"`{c}`")).alias(c) if c == name else F.col(f"`{c}`") for c in df.columns])
