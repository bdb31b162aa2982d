"""Ordered-window operators; see ``slices`` for how large keys are split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portdelta.operators.joins import attach
from portdelta.operators.slices import (
    GHOST,
    SLICE,
    SLICE_SECONDS,
    drop_ghosts,
    slice_of,
    slice_window,
    with_key_totals,
    with_row_halo,
    with_running_number,
)


def lag_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: dict[str, str],
    n: int = 1,
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Adds the values of the n-th previous row of the key; ``cols`` maps column to new name."""
    rows = with_row_halo(df, keys, order, list(cols), before=n, seconds=seconds)
    spec = slice_window(keys, *order)
    return drop_ghosts(rows.withColumns({new: F.lag(c, n).over(spec) for c, new in cols.items()}))


def lead_lag_span(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, n: int, seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Adds ``span_<col>`` = n-th next value minus n-th previous one; rows lacking either are dropped."""
    rows = with_row_halo(df, keys, order, [col], before=n, after=n, seconds=seconds)
    spec = slice_window(keys, *order)
    span = F.lead(col, n).over(spec) - F.lag(col, n).over(spec)
    out = drop_ghosts(rows.withColumn(f"span_{col}", span))
    return out.where(F.col(f"span_{col}").isNotNull())


_RUNNING = {"sum": F.sum, "min": F.min, "max": F.max}
_COMBINE = {
    "sum": lambda a, b: F.coalesce(a + b, a, b),
    "min": F.least,
    "max": F.greatest,
}


_BLOCKS = 64


def range_blocks(range_seconds: int) -> tuple[int, int]:
    """Width of the blocks a trailing range is put together from, and how many whole ones fit into it.

    Between 16 and 64 blocks that fill the range exactly if there is such a number, else as near as can be.
    """
    for n in range(min(_BLOCKS, range_seconds), 15, -1):
        if range_seconds % n == 0:
            return range_seconds // n, n
    width = max(1, -(-range_seconds // _BLOCKS))
    return width, range_seconds // width


def _between(blocks: DataFrame, keys: Sequence[str], stats: dict[str, tuple[str, Column]], n: int) -> DataFrame:
    """``_m_<name>`` of each block: the statistic over the n - 1 blocks before it.

    Blocks of one key meet n at a time, with the n before them, so a frame is short and a group has 2n rows.
    """
    home = F.floor(F.col(SLICE) / n)
    own = blocks.withColumns({"_home": home, "_ghost_block": F.lit(False)})
    rows = own.union(blocks.withColumns({"_home": home + 1, "_ghost_block": F.lit(True)}))
    frame = Window.partitionBy(*keys, "_home").orderBy(SLICE).rangeBetween(1 - n, -1)
    rows = rows.withColumns({f"_m_{name}": _RUNNING[how](f"_s_{name}").over(frame) for name, (how, _) in stats.items()})
    return rows.where("NOT _ghost_block").select(*keys, SLICE, *[f"_m_{name}" for name in stats])


def range_stat(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    stats: dict[str, tuple[str, Column]],
    range_seconds: int,
    totals: dict[str, tuple[Column, str]] | None = None,
) -> DataFrame:
    """Adds statistics over the trailing ``range_seconds`` of the key, current second included.

    ``stats`` maps a name to (``sum``, ``min`` or ``max``, expression); ``totals`` adds whole-key totals.

    A sliding frame visits all its rows again for every row, and one group per range is too much where a key is
    busy or the range long. Time is cut into blocks of a small part of the range instead. The range of a row is
    then the beginning of its own block, up to 63 whole blocks, and the end of the block the range begins in.
    Whole blocks are summaries; the other two are running statistics. Each row goes to its block and, reduced
    to its values, to the block where it drops out of the range; no group holds more than two blocks' rows.
    """
    keys = list(keys)
    width, n = range_blocks(range_seconds)
    rest = range_seconds - n * width
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    block = slice_of(ts, width)
    own = df.select(
        "*", block.alias(SLICE), F.lit(False).alias(GHOST), second.alias("_at"), *[expr.alias(f"_v_{name}") for name, (_, expr) in stats.items()]
    )
    # The last second at which a row still has this one in its range, and the blocks that this concerns.
    leaves = F.when(F.pmod(second, F.lit(width)) + rest >= width, F.array(block + n, block + n + 1)).otherwise(F.array(block + n))
    before = df.where(F.col(ts).isNotNull()).select(
        *keys,
        F.explode(leaves).alias(SLICE),
        F.lit(True).alias(GHOST),
        (second + range_seconds).alias("_at"),
        *[expr.alias(f"_b_{name}") for name, (_, expr) in stats.items()],
    )
    blocks = df.groupBy(*keys, block.alias(SLICE)).agg(*[_RUNNING[how](expr).alias(f"_s_{name}") for name, (how, expr) in stats.items()])
    whole = _between(blocks, keys, stats, n) if n > 1 else None
    if totals:
        per_key = df.groupBy(*keys).agg(*[agg.alias(name) for name, (agg, _) in totals.items()])
        whole = attach(blocks.select(*keys, SLICE) if whole is None else whole, per_key, keys)
    rows = own.unionByName(before, allowMissingColumns=True) if n else own
    if whole is not None:
        rows = rows.unionByName(whole.withColumn(GHOST, F.lit(True)), allowMissingColumns=True)
    up = slice_window(keys, F.asc_nulls_first("_at")).rangeBetween(Window.unboundedPreceding, 0)
    down = slice_window(keys, F.desc_nulls_last("_at")).rangeBetween(Window.unboundedPreceding, 0)
    out = rows
    if n:
        out = out.withColumns({f"_b_{name}": _RUNNING[how](f"_b_{name}").over(down) for name, (how, _) in stats.items()})
    out = out.withColumns({f"_v_{name}": _RUNNING[how](f"_v_{name}").over(up) for name, (how, _) in stats.items()})
    spread = [*(totals or {}), *([f"_m_{name}" for name in stats] if n > 1 else [])]
    if spread:
        out = out.withColumns({name: F.max(name).over(slice_window(keys)) for name in spread})
    new = {}
    for name, (how, _) in stats.items():
        value = F.col(f"_v_{name}")
        for part in (["_b_"] if n else []) + (["_m_"] if n > 1 else []):
            value = _COMBINE[how](value, F.col(f"{part}{name}"))
        new[name] = value
    return drop_ghosts(out).select(*df.columns, *(totals or {}), *[c.alias(name) for name, c in new.items()])


def range_first_last(
    df: DataFrame, keys: Sequence[str], ts: str, col: str, range_seconds: int, tie: str | None = None
) -> DataFrame:
    """Adds ``first_<col>``, ``last_<col>`` and ``interval_seconds`` of the trailing range."""
    placed = F.struct(*[F.col(c) for c in (ts, tie) if c], F.col(col).alias("_value"))
    out = range_stat(df, keys, ts, {"_first": ("min", placed), "_last": ("max", placed)}, range_seconds)

    def second(edge: str) -> Column:
        return F.unix_seconds(F.col(f"{edge}.{ts}").cast("timestamp"))

    return out.withColumns(
        {
            f"first_{col}": F.col("_first._value"),
            f"last_{col}": F.col("_last._value"),
            "interval_seconds": second("_last") - second("_first"),
        }
    ).drop("_first", "_last")


def nth_in_window(df: DataFrame, keys: Sequence[str], ts: str, window: str, n: int, tie: str | None = None) -> DataFrame:
    """The n-th row of each key and aligned time window, with the window's start."""
    spec = Window.partitionBy(*keys, "window_start").orderBy(*[c for c in (ts, tie) if c])
    return (
        df.withColumn("window_start", F.window(ts, window)["start"])
        .withColumn("row_num", F.row_number().over(spec))
        .where(F.col("row_num") == n)
    )


def every_nth(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Every n-th row of each key; column ``rn`` holds its position."""
    return with_running_number(df, keys, order, "rn", seconds).where(F.col("rn") % n == 0)


def group_every(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Adds ``row_num`` and ``group_id``: 1 for the first n rows of a key, 2 for the next n, and so on."""
    out = with_running_number(df, keys, order, "row_num", seconds)
    return out.withColumn("group_id", F.ceil(F.col("row_num") / n))


def elapsed_group(df: DataFrame, keys: Sequence[str], ts: str, seconds: int) -> DataFrame:
    """Adds ``group_id``: whole ``seconds`` passed since the first sample of the key."""
    out = with_key_totals(df, keys, ts, {"_first": (F.min(ts), "min")})
    passed = F.unix_micros(ts) - F.unix_micros("_first")
    return out.withColumn("group_id", F.floor(passed / (seconds * 1_000_000))).drop("_first")


