"""Rows to messages, and messages to a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_to_json_value(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Each row as JSON text in column ``value``; NULL fields are left out unless asked for."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct("*"), options).alias("value"))


def to_psv(df: DataFrame, cols: list[str], null_policy: str = "null_row") -> DataFrame:
    """Columns joined with ``|`` in ``value``.

    ``null_row``: one NULL part makes the value NULL. ``skip``: NULL parts are left out.
    """
    parts = [F.col(c).cast("string") for c in cols]
    if null_policy == "skip":
        return df.withColumn("value", F.concat_ws("|", *parts))
    if null_policy != "null_row":
        raise ValueError(f"unknown null_policy {null_policy!r}")
    spaced: list[Column] = []
    for part in parts:
        spaced += [F.lit("|"), part] if spaced else [part]
    return df.withColumn("value", F.concat(*spaced))


def to_message(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as binary JSON ``value``, with an optional binary ``key`` column."""
    value = F.to_json(F.struct("*")).cast("binary").alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").cast("binary").alias("key"), value)


def write_topic(df: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """Batch write of messages through any connector; the connector pools its producers."""
    df.write.format(fmt).options(**options).mode("append").save()
