"""Streams in the order of time: state that waits for the watermark and is released by timers.

Both operators need the RocksDB state store (``start_stream(..., state_store="rocksdb")``). A sample behind
the watermark is late and left out; what the watermark has not passed yet stays in state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from portdelta.operators.deltas import lag_deltas
from portdelta.ship import by_value

by_value(__name__)

# Columns handed to Python may not begin with an underscore. A null whole number would turn its column into
# floats on the way, so it is sent as the smallest long.
_TIME, _END = "at_micros", "window_end_micros"
_NULL = -(2**63)


def _fields(df: DataFrame, keys: Sequence[str], longs: Sequence[str]) -> T.StructType:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return T.StructType([T.StructField(k, kinds[k], True) for k in keys] + [T.StructField(c, T.LongType(), True) for c in longs])


def _frame(keys: Sequence[str], key: tuple, names: Sequence[str], rows: Sequence[Sequence[int | None]]) -> pd.DataFrame:
    out = pd.DataFrame({c: pd.array(list(v), dtype="Int64") for c, v in zip(names, zip(*rows))})
    for i, (k, v) in enumerate(zip(keys, key)):
        out.insert(i, k, v)
    return out


def _tuples(batch: pd.DataFrame, names: Sequence[str]) -> list[list[int | None]]:
    return [[None if v == _NULL else int(v) for v in row] for row in batch[list(names)].to_numpy().tolist()]


def _longs(cols: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("long"), F.lit(_NULL)).alias(c) for c in cols]


class PreviousSample(StatefulProcessor):
    """Holds samples in buckets of time until the watermark has passed the bucket, then pairs each with the one before.

    State: one map entry for each bucket and batch with the samples that came, and the last sample released. A
    timer at a bucket's end releases it, so a release handles one bucket, never a key's whole batch.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], bucket_us: int) -> None:
        self.keys, self.names, self.n_order = list(keys), [*order, *cols], len(order)
        self.bucket = bucket_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long, part long", "flat array<long>")
        self.last = handle.getValueState("last", "sample array<long>")
        self.parts = handle.getValueState("parts", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        part = self.parts.get()[0] if self.parts.exists() else 0
        for batch in rows:
            for bucket, some in batch.groupby(batch[_TIME] // self.bucket):
                flat = [v for row in _tuples(some, self.names) for v in row]
                self.waiting.updateValue((int(bucket), part), (flat,))
                # Timers are in milliseconds; a second one for the same end changes nothing.
                self.handle.registerTimer(-(-(int(bucket) + 1) * self.bucket // 1000))
                part += 1
        self.parts.update((part,))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        end, width = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()), len(self.names)
        # The first of a key's timers in a batch takes all buckets that are due, so the others find few entries.
        due = sorted(k for k in self.waiting.keys() if -(-(k[0] + 1) * self.bucket // 1000) <= end)
        for bucket in dict.fromkeys(k[0] for k in due):
            rows = []
            for k in (k for k in due if k[0] == bucket):
                flat = list(self.waiting.getValue(k)[0])
                rows += [flat[i : i + width] for i in range(0, len(flat), width)]
                self.waiting.removeKey(k)
            rows.sort(key=lambda r: [(v is not None, v or 0) for v in r])
            before = list(self.last.get()[0]) if self.last.exists() else [None] * width
            out = []
            for row in rows:
                out.append([*row, before[0], *before[self.n_order :]])
                before = row
            self.last.update((before,))
            cols = self.names[self.n_order :]
            yield _frame(self.keys, key, [*self.names, "prev_time", *[f"prev_{c}" for c in cols]], out)

    def close(self) -> None:
        pass


def delta_lag_ordered(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    order: Sequence[str],
    watermark: str,
    bucket_seconds: int = 300,
    on_reset: str = "negative",
    time_name: str = "delta_time_sec",
    first: str = "zero",
) -> DataFrame:
    """``delta_lag`` (previous sample) on a stream whose samples may come in any order within ``watermark``.

    A sample appears once the watermark has passed its bucket of ``bucket_seconds``, so what comes out equals the
    batch result over all samples that were not late. ``order`` is the time column and whole numbers that break
    ties; counters are whole numbers. The result has ``keys``, ``order``, ``cols`` and the deltas. The last
    sample of every key stays as state.
    """
    keys, ts = list(keys), order[0]
    rows = df.withWatermark(ts, watermark).where(F.col(ts).isNotNull())
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    # The time is carried as microseconds under its own name; Spark tells late rows by the column it replaces.
    rows = rows.select(*keys, ts, *_longs([*order[1:], *cols]), micros.alias(_TIME))
    names = [_TIME, *order[1:], *cols]
    schema = _fields(rows, keys, [*names, "prev_time", *[f"prev_{c}" for c in cols]])
    processor = PreviousSample(keys, [_TIME, *order[1:]], cols, bucket_seconds * 1_000_000)
    paired = rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "EventTime")
    out = paired.withColumn(ts, F.timestamp_micros(_TIME)).withColumn("prev_time", F.timestamp_micros("prev_time")).drop(_TIME)
    deltas = lag_deltas(out, cols, ts, on_reset, time_name, first)
    return deltas.select(*keys, *order, *cols, time_name, *[f"delta_{c}" for c in cols])


class FirstOfWindow(StatefulProcessor):
    """The first ``n`` samples of one key and window; a timer at the window's end reports and frees them."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], n: int) -> None:
        self.keys, self.names, self.n_order, self.n = list(keys), [*order, *cols], len(order), n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getListState("first", "sample array<long>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        had = [list(s[0]) for s in self.first.get()] if self.first.exists() else []
        if not had:
            self.handle.registerTimer(-(-int(key[-1]) // 1000))
        for batch in rows:
            some = batch.nsmallest(self.n, self.names[: self.n_order]) if len(batch) > self.n else batch
            had = sorted(had + _tuples(some, self.names), key=lambda r: [(v is not None, v or 0) for v in r])[: self.n]
        self.first.put([(s,) for s in had])
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        had = [list(s[0]) for s in self.first.get()]
        self.first.clear()
        if len(had) == self.n:
            spans = []
            for values in list(zip(*had))[self.n_order :]:
                sent = [v for v in values if v is not None]
                spans.append(max(sent) - min(sent) if sent else None)
            yield _frame(self.keys, key, self.names[self.n_order :], [spans])

    def close(self) -> None:
        pass


def delta_complete_window_stream(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str], window_seconds: int, watermark: str, n: int = 5
) -> DataFrame:
    """``delta_complete_window`` on a stream: delta over the first ``n`` samples of each closed window.

    A window is reported once the watermark has passed its end, whatever the order its samples came in; windows
    with fewer samples are left out. State is at most ``n`` samples for each key and open window.
    """
    keys, ts, width = list(keys), order[0], window_seconds * 1_000_000
    rows = df.withWatermark(ts, watermark).where(F.col(ts).isNotNull())
    rows = rows.select(*keys, ts, *_longs([*order[1:], *cols]), F.unix_micros(F.col(ts).cast("timestamp")).alias(_TIME))
    rows = rows.withColumn(_END, (F.floor(F.col(_TIME) / width) + 1) * width)
    by = [*keys, _END]
    processor = FirstOfWindow(by, [_TIME, *order[1:]], cols, n)
    spans = rows.groupBy(*by).transformWithStateInPandas(processor, _fields(rows, by, cols), "Append", "EventTime")
    return spans.select(
        *keys,
        F.timestamp_micros(F.col(_END) - width).alias("window_start"),
        F.timestamp_micros(_END).alias("window_end"),
        *[F.col(c).alias(f"delta_{c}") for c in cols],
        F.lit(window_seconds).cast("long").alias("delta_time"),
    )
