"""Messages to typed rows, with a second output for what could not be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portdelta.model import SYSTEM_ENVELOPE, struct_from, struct_of
from portdelta.operators.flatten import (
    explode_interfaces,
    explode_status,
    explode_subinterface_status,
    explode_subinterfaces,
)

CORRUPT = "_corrupt"
PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def once(expr: Column) -> Column:
    """``expr`` as a one-row generator, to be selected under an alias.

    The optimizer copies an expression into every filter it pushes down, window bounds included, and
    parsing JSON again for each copy is what costs. Nothing is pushed through a generator's own output.
    """
    return F.explode(F.array(expr))


def parse_value(df: DataFrame, schema: T.StructType, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bytes or text holding JSON to top-level columns; unreadable JSON gives NULL fields."""
    parsed = once(F.from_json(F.col(col).cast("string"), schema))
    return df.select(*keep, parsed.alias("_v")).select(*keep, "_v.*")


def parse_head(df: DataFrame, col: str = "value") -> DataFrame:
    """Network element, source, type, time and the interface map as sent, without exploding it."""
    return parse_value(df, SYSTEM_ENVELOPE, col).select(
        F.col("system.metaData.ucgDeviceName").alias("ucgDeviceName"),
        F.col("system.metaData.ucgSource").alias("ucgSource"),
        F.col("system.metaData.ucgType").alias("ucgType"),
        F.col("system.perf.interfaces.interface").alias("interfaces"),
        F.col("system.timestamp").try_cast("long").alias("timestamp"),
    )


def _reject_reason(parsed: Column) -> Column:
    data = parsed["ucgJsonData"]
    return (
        F.when(parsed.isNull() | parsed[CORRUPT].isNotNull(), "not_json")
        .when(parsed["ucgDeviceName"].isNull(), "no_device")
        .when(data.isNull(), "no_data")
        .when(data["interfaces"]["interface"].isNull(), "no_interfaces")
    )


def with_reject_reason(df: DataFrame, col: str = "value") -> DataFrame:
    """Adds ``reject_reason``, NULL for a usable message."""
    # The interface collection is only tested for presence, so its text is not parsed further.
    shape = struct_from(
        {
            "ucgDeviceName": "string",
            "ucgJsonData": struct_of(interfaces=struct_of(interface="string")),
            CORRUPT: "string",
        }
    )
    parsed = F.from_json(F.col(col).cast("string"), shape, PERMISSIVE)
    reason = _reject_reason(F.col("_p")).alias("reject_reason")
    return df.select("*", once(parsed).alias("_p")).select(*df.columns, reason)


def validate_envelope(df: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: messages with network element, data and interfaces, and all others with a reason."""
    checked = with_reject_reason(df, col)
    valid = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, checked.where(F.col("reject_reason").isNotNull())


def split_record_kinds(df: DataFrame) -> dict[str, DataFrame]:
    """The four record kinds of one parsed input; a message adds rows only to the kinds it holds."""
    return {
        "interface_counters": explode_interfaces(df).where(F.col("in_octets").isNotNull()),
        "subinterface_counters": explode_subinterfaces(df).where(F.col("in_octets").isNotNull()),
        "interface_status": explode_status(df).where(F.col("admin_status").isNotNull()),
        "subinterface_status": explode_subinterface_status(df).where(F.col("oper_status").isNotNull()),
    }


def avro_decode(df: DataFrame, schema_json: str, col: str = "value") -> DataFrame:
    """Avro bytes to top-level columns; needs the Avro module on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return df.select(from_avro(F.col(col), schema_json).alias("_v")).select("_v.*")


def avro_encode(df: DataFrame, col: str = "value") -> DataFrame:
    """One column as Avro bytes; needs the Avro module on the class path."""
    from pyspark.sql.avro.functions import to_avro

    return df.select(to_avro(F.col(col)).alias(col))


