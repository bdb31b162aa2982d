"""Ordered windows over keys of any size.

A window partitioned by a key puts all rows of that key into one task. Here each key's time line is
cut into slices of fixed width, windows run per (key, slice), and what a slice must know about its
neighbours is added to it as a few marked rows ("ghosts"), so the result equals that of the uncut
window:

* ``with_row_halo``: the last or next n rows of the key, for lag, lead and row frames;
* ``with_base_rows``: one row per slice with a total over the key or over its earlier slices.

Only per-slice leftovers (a few rows per key and slice) are ever grouped by the bare key. Choose
``seconds`` so that one slice of the busiest key suits one task; a larger slice spills, but holds.
The leftovers come from a second, column-pruned read of the input: store an input that is costly to
compute before handing it over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

SLICE_SECONDS = 3600
SLICE = "_slice"
GHOST = "_ghost"

# Rows without a time form the first slice, as they sort first.
_NO_TIME = -(2**62)


def slice_of(ts: Column | str, seconds: int) -> Column:
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.floor(F.unix_seconds(col.cast("timestamp")) / seconds), F.lit(_NO_TIME))


def slice_window(keys: Sequence[str], *order: Column | str) -> WindowSpec:
    spec = Window.partitionBy(*keys, SLICE)
    return spec.orderBy(*order) if order else spec


def drop_ghosts(df: DataFrame) -> DataFrame:
    return df.where(~F.col(GHOST)).drop(SLICE, GHOST)


def _edge_rows(
    base: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], n: int, backward: bool
) -> DataFrame:
    """For each slice of a key, the n rows of the key before it (``backward``) or after it."""
    need = [c for c in dict.fromkeys([*order, *cols]) if c not in keys]
    rising = [F.asc_nulls_first(c) for c in order]
    falling = [F.desc_nulls_last(c) for c in order]
    inward, along = (falling, rising) if backward else (rising, falling)
    # The rank filter is applied before the shuffle as well, so only n rows per slice and task move.
    edges = (
        base.select(*keys, SLICE, *need)
        .withColumn("_pos", F.row_number().over(slice_window(keys, *inward)))
        .where(F.col("_pos") <= n)
    )
    line = Window.partitionBy(*keys).orderBy(*along)
    return (
        edges.select(
            *keys,
            SLICE,
            F.collect_list(F.struct(*need)).over(line.rowsBetween(-n, -1)).alias("_rows"),
            F.lag(SLICE).over(line).alias("_other"),
        )
        .where(F.col("_other") != F.col(SLICE))
        .select(*keys, SLICE, F.explode("_rows").alias("_row"))
        .select(*keys, SLICE, "_row.*", F.lit(True).alias(GHOST))
    )


def with_row_halo(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    before: int = 0,
    after: int = 0,
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Slices ``df`` and adds to each slice the neighbouring rows of its key as ghosts.

    ``order`` starts with the time column and should be total. Ghosts carry ``order`` and ``cols``.
    """
    base = df.withColumn(SLICE, slice_of(order[0], seconds))
    out = base.withColumn(GHOST, F.lit(False))
    if before:
        ghosts = _edge_rows(base, keys, order, cols, before, backward=True)
        out = out.unionByName(ghosts, allowMissingColumns=True)
    if after:
        ghosts = _edge_rows(base, keys, order, cols, after, backward=False)
        out = out.unionByName(ghosts, allowMissingColumns=True)
    return out


def base_rows(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, totals: dict[str, tuple[Column, str]], earlier: bool
) -> DataFrame:
    """One ghost per slice holding totals over the whole key, or over its ``earlier`` slices.

    ``totals`` maps a name to (aggregate over a slice, name of the function that merges slices).
    Slices are aggregated before the shuffle; only their totals meet in one group per key.
    """
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    per_slice = df.groupBy(*keys, slice_of(ts, seconds).alias(SLICE)).agg(
        *[agg.alias(name) for name, (agg, _) in totals.items()]
    )
    span = Window.partitionBy(*keys)
    if earlier:
        span = span.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.select(
        *keys,
        SLICE,
        *[merge[how](name).over(span).alias(name) for name, (_, how) in totals.items()],
        F.lit(True).alias(GHOST),
    )


def with_key_totals(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    totals: dict[str, tuple[Column, str]],
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Adds totals over the whole key to every row of the key."""
    rows = df.withColumn(SLICE, slice_of(ts, seconds)).withColumn(GHOST, F.lit(False))
    rows = rows.unionByName(base_rows(df, keys, ts, seconds, totals, earlier=False), allowMissingColumns=True)
    spec = slice_window(keys)
    return drop_ghosts(rows.withColumns({name: F.max(name).over(spec) for name in totals}))


def with_running_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Adds the position 1, 2, 3 ... of each row within its key in ``order``."""
    rows = df.withColumns({SLICE: slice_of(order[0], seconds), GHOST: F.lit(False), "_n": F.lit(1).cast("long")})
    before = base_rows(df, keys, order[0], seconds, {"_n": (F.count(F.lit(1)), "sum")}, earlier=True)
    rows = rows.unionByName(before.where(F.col("_n").isNotNull()), allowMissingColumns=True)
    spec = slice_window(keys, F.desc(GHOST), *order).rowsBetween(Window.unboundedPreceding, 0)
    return drop_ghosts(rows.withColumn(name, F.sum("_n").over(spec))).drop("_n")
