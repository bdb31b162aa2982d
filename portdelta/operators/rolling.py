"""Rolling delta with restart: an interval lasts until the first sample at least ``span`` after its start.

That sample closes the interval, is part of it, and starts the next one, so deltas of a rising
counter add up. Intervals still open are not reported. Samples are ordered by time, then value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from portdelta.operators.slices import SLICE, SLICE_SECONDS, slice_of
from portdelta.ship import by_value

by_value(__name__)

_US = 1_000_000


def _starts(times: np.ndarray, entry: int, span: int) -> list[int]:
    """Positions of the interval starts in sorted ``times`` from the first one at or after ``entry``."""
    out = []
    at = int(np.searchsorted(times, entry))
    while at < len(times):
        out.append(at)
        at = int(np.searchsorted(times, times[at] + span))
    return out


Piece = tuple[int, int | None, int, int]


def _pieces(
    times: np.ndarray, lows: np.ndarray, highs: np.ndarray, starts: list[int], since: int | None
) -> list[Piece]:
    """Share of each interval in these samples: start, end if closed here, maximum and minimum.

    ``since`` is the start of the interval still open before the first sample.
    """
    begins = [int(times[i]) for i in starts]
    cuts = list(starts)
    if since is not None and (not starts or starts[0] > 0):
        begins, cuts = [since, *begins], [0, *cuts]
    high, low = np.maximum.reduceat(highs, cuts), np.minimum.reduceat(lows, cuts)
    rows: list[Piece] = [(b, None, int(h), int(m)) for b, h, m in zip(begins, high, low)]
    # A start also closes the interval before it, with its first sample: the lowest of that time.
    open_before = [since, *[int(times[i]) for i in starts[:-1]]]
    for prev, i in zip(open_before, starts):
        if prev is not None:
            rows.append((prev, int(times[i]), int(lows[i]), int(lows[i])))
    return rows


def _slice_table(times: np.ndarray, begin: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """How a slice continues a chain: for an entry at or before ``upto``, the last start is ``leaves``.

    An entry lies less than ``span`` behind the slice's begin, or is the first sample after that;
    entries that end in the same last start share one row.
    """
    n = len(times)
    jump = np.searchsorted(times, times + span)
    last = np.where(jump < n, jump, np.arange(n))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    first_free = min(int(np.searchsorted(times, begin + span)), n - 1)
    leaves = last[: first_free + 1]
    final = np.append(leaves[1:] != leaves[:-1], True)
    return times[: first_free + 1][final], times[leaves[final]]


Table = tuple[np.ndarray, np.ndarray]

# 256 tables of one level become one of the next. Two levels of hours span seven years, so few are left per key.
_BITS, _LEVELS = 8, 2
_UP = "_up"


def _composed(parts: Sequence[Table], span: int) -> Table:
    """The table of consecutive slices taken as one.

    An entry beyond the last time of a slice still lies before the next one begins, so it ends up at the first
    row of what follows. The result is thus as long as the first table and one row, however many there are.
    """
    upto, leaves = parts[-1]
    for before, left in reversed(parts[:-1]):
        at = np.searchsorted(upto, left + span)
        on = np.where(at < len(upto), leaves[np.minimum(at, len(upto) - 1)], left)
        upto, leaves = np.append(before, upto[0]), np.append(on, leaves[0])
        final = np.append(leaves[1:] != leaves[:-1], True)
        upto, leaves = upto[final], leaves[final]
    return upto, leaves


def _parts(rows: pa.Table) -> tuple[np.ndarray, list[Table]]:
    """Tables of a group, in the order of their slices, and the numbers of these."""
    table = np.stack([rows[c].to_numpy() for c in (SLICE, "upto", "leaves")], axis=1)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    numbers, begin = np.unique(table[:, 0], return_index=True)
    return numbers, [(p[:, 1], p[:, 2]) for p in np.split(table, begin[1:])]


def _entered(parts: Sequence[Table], since: int | None, span: int) -> list[int | None]:
    """Start of the interval that is open when each slice begins, if ``since`` is that of the first."""
    known = []
    for upto, leaves in parts:
        known.append(since)
        at = 0 if since is None else int(np.searchsorted(upto, since + span))
        if at < len(upto):
            since = int(leaves[at])
    return known


def _samples(df: DataFrame, keys: Sequence[str], col: str, ts: str, width: int) -> DataFrame:
    """Copies and samples of one time shrink to one row before they move."""
    return (
        df.where(F.col(ts).isNotNull() & F.col(col).isNotNull())
        .select(
            *keys,
            slice_of(ts, width).alias(SLICE),
            F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"),
            F.col(col).cast("long").alias("_v"),
        )
        .groupBy(*keys, SLICE, "_t")
        .agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )


def _with_longs(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> T.StructType:
    fields = {f.name: f.dataType for f in df.schema.fields}
    long = T.LongType()
    return T.StructType([T.StructField(k, fields[k], True) for k in keys] + [T.StructField(n, long, True) for n in names])


def jump_levels(times: DataFrame, keys: Sequence[str], width: int, span: int) -> list[DataFrame]:
    """Tables ``upto, leaves`` of slices, of groups of 256 slices, and of groups of 256 such groups.

    ``times`` has ``keys``, the slice of ``width`` seconds and the time ``_t``; ``span`` is in microseconds. No
    group of a level holds more than 256 tables, and none of them has more rows than times in one span and
    the rows that were added by composing: the length of a key's time line does not matter.
    """
    keys = list(keys)
    schema = _with_longs(times, keys, [SLICE, "upto", "leaves"])

    def out(key: tuple, table: Table) -> pa.Table:
        n = len(table[0])
        return pa.table([pa.repeat(k, n) for k in key] + [pa.array(c, pa.int64()) for c in table], names=[*keys, SLICE, "upto", "leaves"])

    def describe(key: tuple, rows: pa.Table) -> pa.Table:
        return out(key, _slice_table(np.sort(rows["_t"].to_numpy()), key[-1].as_py() * width * _US, span))

    def compose(key: tuple, rows: pa.Table) -> pa.Table:
        return out(key, _composed(_parts(rows)[1], span))

    levels = [times.groupBy(*keys, SLICE).applyInArrow(describe, schema)]
    for _ in range(_LEVELS):
        levels.append(_with_up(levels[-1]).groupBy(*keys, _UP).applyInArrow(compose, schema))
    return levels


def _with_up(level: DataFrame) -> DataFrame:
    return level.withColumn(_UP, F.shiftright(SLICE, _BITS))


def open_intervals(levels: Sequence[DataFrame], keys: Sequence[str], span: int) -> DataFrame:
    """``since`` of every slice: start of the interval that is open when it begins, from the top level down."""
    keys = list(keys)
    schema = _with_longs(levels[0], keys, [SLICE, "since"])

    def out(key: tuple, numbers: np.ndarray, known: Sequence[int | None]) -> pa.Table:
        arrays = [pa.repeat(k, len(known)) for k in key] + [pa.array(c, pa.int64()) for c in (numbers, known)]
        return pa.table(arrays, names=[*keys, SLICE, "since"])

    def first(key: tuple, rows: pa.Table) -> pa.Table:
        numbers, parts = _parts(rows)
        return out(key, numbers, _entered(parts, None, span))

    def descend(key: tuple, rows: pa.Table, above: pa.Table) -> pa.Table:
        numbers, parts = _parts(rows)
        return out(key[:-1], numbers, _entered(parts, above["since"][0].as_py(), span))

    opened = levels[-1].groupBy(*keys).applyInArrow(first, schema)
    for level in reversed(levels[:-1]):
        above = opened.withColumnRenamed(SLICE, _UP).groupBy(*keys, _UP)
        opened = _with_up(level).groupBy(*keys, _UP).cogroup(above).applyInArrow(descend, schema)
    return opened


def _batch(df: DataFrame, keys: Sequence[str], col: str, ts: str, span_s: int, seconds: int) -> DataFrame:
    keys = list(keys)
    width, span = max(seconds, 4 * span_s), span_s * _US
    samples = _samples(df, keys, col, ts, width)

    def result(key: tuple, names: Sequence[str], columns: Sequence[Sequence]) -> pa.Table:
        n = len(columns[0])
        arrays = [pa.repeat(k, n) for k in key] + [pa.array(c, pa.int64()) for c in columns]
        return pa.table(arrays, names=[*keys, *names])

    def cut(key: tuple, rows: pa.Table, opened: pa.Table) -> pa.Table:
        times = rows["_t"].to_numpy()
        order = np.argsort(times)
        times = times[order]
        lows, highs = (rows[c].to_numpy()[order] for c in ("_low", "_high"))
        since = opened["since"][0].as_py()
        starts = _starts(times, int(times[0]) if since is None else since + span, span)
        pieces = _pieces(times, lows, highs, starts, since)
        return result(key[:-1], ["start", "end", "high", "low"], list(zip(*pieces)))

    # Only the short tables of slices are chained, level by level; samples stay in their slice.
    opened = open_intervals(jump_levels(samples.select(*keys, SLICE, "_t"), keys, width, span), keys, span)
    pieces = (
        samples.groupBy(*keys, SLICE)
        .cogroup(opened.groupBy(*keys, SLICE))
        .applyInArrow(cut, _with_longs(df, keys, ["start", "end", "high", "low"]))
    )
    return (
        pieces.groupBy(*keys, "start")
        .agg(F.max("end").alias("end"), F.max("high").alias("high"), F.min("low").alias("low"))
        .where(F.col("end").isNotNull())
        .select(
            *keys,
            F.timestamp_micros("start").alias("start_time"),
            F.timestamp_micros("end").alias("end_time"),
            (F.col("high") - F.col("low")).alias(f"delta_{col}"),
        )
    )


def _with_keys(out: pd.DataFrame, keys: Sequence[str], values: tuple) -> pd.DataFrame:
    for i, (k, v) in enumerate(zip(keys, values)):
        out.insert(i, k, v)
    return out


def _timeout(idle: int | None) -> str:
    return GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout


def _stream(df: DataFrame, keys: Sequence[str], col: str, ts: str, span_s: int, idle: int | None) -> DataFrame:
    keys, span = list(keys), span_s * _US
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = ["start", "end", "delta"]
    out_schema = T.StructType(
        [T.StructField(k, fields[k], True) for k in keys] + [T.StructField(n, T.LongType(), True) for n in names]
    )
    state_schema = T.StructType([T.StructField(n, T.LongType(), True) for n in ("start", "high", "low")])

    def roll(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        since, high, low = state.get if state.exists else (None, None, None)
        # Of one time only the extremes count; samples older than the open interval are late and left out.
        kept = [b if since is None else b[b["_t"] >= since] for b in batches]
        rows = pd.concat([b.groupby("_t")["_v"].agg(["min", "max"]) for b in kept])
        if rows.empty:
            if idle:
                state.setTimeoutDuration(idle * 1000)
            return
        rows = rows.groupby(level=0).agg({"min": "min", "max": "max"}).sort_index()
        times, lows, highs = rows.index.to_numpy(), rows["min"].to_numpy(), rows["max"].to_numpy()
        starts = _starts(times, int(times[0]) if since is None else since + span, span)
        pieces = _pieces(times, lows, highs, starts, since)
        if since is not None:
            pieces.append((since, None, high, low))
        parts = pd.DataFrame(pieces, columns=["start", "end", "high", "low"]).astype({"end": "Int64"})
        whole = parts.groupby("start", as_index=False).agg({"end": "max", "high": "max", "low": "min"})
        newest = whole.iloc[-1]
        state.update((int(newest["start"]), int(newest["high"]), int(newest["low"])))
        if idle:
            state.setTimeoutDuration(idle * 1000)
        closed = whole[whole["end"].notna()]
        out = pd.DataFrame(
            {"start": closed["start"], "end": closed["end"], "delta": closed["high"] - closed["low"]}
        ).astype("int64")
        yield _with_keys(out, keys, key)

    rolled = (
        df.where(F.col(ts).isNotNull() & F.col(col).isNotNull())
        .select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"), F.col(col).cast("long").alias("_v"))
        .groupBy(*keys)
        .applyInPandasWithState(roll, out_schema, state_schema, "append", _timeout(idle))
    )
    return rolled.select(
        *keys,
        F.timestamp_micros("start").alias("start_time"),
        F.timestamp_micros("end").alias("end_time"),
        F.col("delta").alias(f"delta_{col}"),
    )


def delta_stateful(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    ts: str,
    span_seconds: int = 300,
    slice_seconds: int = SLICE_SECONDS,
    idle_seconds: int | None = None,
) -> DataFrame:
    """Rolling delta per key; a stream keeps start, maximum and minimum of the open interval as state.

    On a stream, a sample older than the start of its key's open interval is late and left out: the
    interval it belongs to is closed. The state of a key without samples for ``idle_seconds`` is dropped;
    that runs by the clock, so not under a trigger that ends by itself.
    """
    if df.isStreaming:
        return _stream(df, keys, col, ts, span_seconds, idle_seconds)
    return _batch(df, keys, col, ts, span_seconds, slice_seconds)


def delta_lag_stream(df: DataFrame, keys: Sequence[str], col: str, ts: str, idle_seconds: int | None = None) -> DataFrame:
    """Previous-sample delta on a stream; the last sample of each key is its state.

    A sample older than the newest one seen is late: it appears with NULL deltas. The state of a key without
    samples for ``idle_seconds`` is dropped.
    """
    keys, idle = list(keys), idle_seconds
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = ["t", "value", "delta_time_sec", "delta"]
    out_schema = T.StructType(
        [T.StructField(k, fields[k], True) for k in keys] + [T.StructField(n, T.LongType(), True) for n in names]
    )
    state_schema = T.StructType([T.StructField(n, T.LongType(), True) for n in ("t", "v")])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat([b[["_t", "_v"]] for b in batches]).sort_values(["_t", "_v"])
        if idle:
            state.setTimeoutDuration(idle * 1000)
        if state.exists:
            t0, v0 = state.get
            late = rows[rows["_t"] < t0]
            rows = rows[rows["_t"] >= t0]
            if len(late):
                none = pd.array([pd.NA] * len(late), dtype="Int64")
                out = pd.DataFrame({"t": late["_t"].to_numpy(), "value": late["_v"].to_numpy()})
                yield _with_keys(out.assign(delta_time_sec=none, delta=none), keys, key)
        else:
            t0, v0 = rows["_t"].iloc[0], rows["_v"].iloc[0]
        if rows.empty:
            return
        times, values = rows["_t"].to_numpy(), rows["_v"].to_numpy()
        prev_t, prev_v = np.append([t0], times[:-1]), np.append([v0], values[:-1])
        state.update((int(times[-1]), int(values[-1])))
        out = pd.DataFrame(
            {
                "t": times,
                "value": values,
                "delta_time_sec": times // _US - prev_t // _US,
                "delta": values - prev_v,
            }
        )
        yield _with_keys(out, keys, key)

    stepped = (
        df.where(F.col(ts).isNotNull() & F.col(col).isNotNull())
        .select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"), F.col(col).cast("long").alias("_v"))
        .groupBy(*keys)
        .applyInPandasWithState(step, out_schema, state_schema, "append", _timeout(idle))
    )
    return stepped.select(
        *keys,
        F.timestamp_micros("t").alias(ts),
        F.col("value").alias(col),
        "delta_time_sec",
        F.col("delta").alias(f"delta_{col}"),
    )
