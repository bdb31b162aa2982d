"""Projections, predicates and casts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: unanchored pattern for a dotted quad.
IPV4_PATTERN = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"


def with_columns_map(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Adds all columns of a name to expression map in one projection."""
    return df.withColumns(exprs)


def bulk_cast(df: DataFrame, dtype: str, exclude: Iterable[str]) -> DataFrame:
    """Casts every column but the excluded ones in one projection; bad text becomes NULL."""
    keep = set(exclude)
    return df.select(*[F.col(c) if c in keep else F.col(c).try_cast(dtype).alias(c) for c in df.columns])


def has_counter(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def dropna_subset(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def newer_than(df: DataFrame, col: str, mark: object) -> DataFrame:
    """Rows after the mark; a literal mark reaches the Parquet scan."""
    return df.where(F.col(col) > F.lit(mark))


def epoch_aligned(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Rows whose whole epoch second is a multiple of ``seconds``."""
    return df.where(F.unix_seconds(F.col(ts).cast("timestamp")) % seconds == 0)


def ci_equals(col: Column | str, value: str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.upper(col) == value.upper()


def like_ipv4(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.rlike(IPV4_PATTERN)


def null_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replaces NULL by a typed default per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def clamp_negative(df: DataFrame, cols: list[str]) -> DataFrame:
    """Negative values become 0; NULL stays NULL."""
    return df.withColumns({c: F.when(F.col(c) < 0, F.lit(0)).otherwise(F.col(c)) for c in cols})


def direction_split(df: DataFrame, orient: str, value: str, previous: str) -> DataFrame:
    """Difference of two text counters, routed by direction flag: ``1`` in, ``0`` out."""
    diff = F.col(value).try_cast("double") - F.col(previous).try_cast("double")
    return df.withColumns(
        {
            "bytes_in": F.when(F.col(orient) == "1", diff),
            "bytes_out": F.when(F.col(orient) == "0", diff),
        }
    )


def map_get(col: Column | str, key: str, default: object) -> Column:
    """Map value by key; an absent key or a NULL value gives the default."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_element_at(col, F.lit(key)), F.lit(default))
