"""Aggregations. All use functions Spark combines before the shuffle, so hot keys stay small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_min(df: DataFrame, keys: Sequence[object], cols: Sequence[str]) -> DataFrame:
    """``max_<c>`` and ``min_<c>`` of each column per key."""
    return df.groupBy(*keys).agg(
        *[F.max(c).alias(f"max_{c}") for c in cols], *[F.min(c).alias(f"min_{c}") for c in cols]
    )


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def group_stats(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Average, maximum and minimum of one column per key."""
    return df.groupBy(*keys).agg(
        F.avg(col).alias(f"avg_{col}"), F.max(col).alias(f"max_{col}"), F.min(col).alias(f"min_{col}")
    )


def first_delta(df: DataFrame, keys: Sequence[str], value: str, ts: str, tie: str | None = None) -> DataFrame:
    """Earliest value per key and how far the maximum lies above it."""
    by = F.struct(ts, tie) if tie else F.col(ts)
    first = F.min_by(value, by)
    return df.groupBy(*keys).agg(
        F.min(ts).alias("start_timestamp"),
        F.max(ts).alias("end_timestamp"),
        first.alias(value),
        (F.max(value) - first).alias(f"delta_{value}"),
    )


def global_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias(f"max_{col}"))


def poll_sums(df: DataFrame, keys: Sequence[str], ts: str, window: str) -> DataFrame:
    """Bytes in, bytes out and elapsed time per key and window; windows without elapsed time are dropped."""
    return (
        df.groupBy(F.window(ts, window).alias("_w"), *keys)
        .agg(
            F.sum("bytes_in").alias("bytes_in"),
            F.sum("bytes_out").alias("bytes_out"),
            F.sum("delta_time").alias("delta_time"),
        )
        .where(F.col("delta_time").isNotNull())
        .select(F.col("_w.start").alias("window_start"), *keys, "bytes_in", "bytes_out", "delta_time")
    )


def window_extents(df: DataFrame, keys: Sequence[str], ts: str, window: str) -> DataFrame:
    """First and last time per key and window."""
    return (
        df.groupBy(*keys, F.window(ts, window).alias("_w"))
        .agg(F.min(ts).alias("start_timestamp"), F.max(ts).alias("end_timestamp"))
        .drop("_w")
    )


def window_max_of_delta(df: DataFrame, keys: Sequence[str], ts: str, window: str, col: str, delta: str) -> DataFrame:
    """As ``window_extents`` with the maximum of a value and of its delta."""
    return (
        df.groupBy(*keys, F.window(ts, window).alias("_w"))
        .agg(
            F.min(ts).alias("start_timestamp"),
            F.max(ts).alias("end_timestamp"),
            F.max(col).alias(col),
            F.max(delta).alias(delta),
        )
        .drop("_w")
    )


def latest_row(df: DataFrame, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row of the table."""
    return df.orderBy(*[F.desc(c) for c in (ts, *tie)]).limit(1)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key, by aggregation rather than by sorting the key's rows."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(ts, *tie)).alias("_r")
    return df.groupBy(*keys).agg(newest).select(*keys, "_r.*").select(*df.columns)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def publish_stats(joined: DataFrame, new: DataFrame, inputs: DataFrame | None = None) -> DataFrame:
    """One row: rows read, joined, already published and published."""
    parts = [("joined", joined), ("published", new)] + ([("input", inputs)] if inputs is not None else [])
    counts = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("k"), "n")
        counts = one if counts is None else counts.unionByName(one)
    pick = {name: F.max(F.when(F.col("k") == name, F.col("n"))) for name, _ in parts}
    out = counts.agg(*[c.alias(f"{name}_rows") for name, c in pick.items()])
    return out.withColumn("already_published_rows", F.col("joined_rows") - F.col("published_rows"))
