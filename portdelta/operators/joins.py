"""Enrichment, correlation and publish-once joins.

No side is force-broadcast: Spark broadcasts one only if its size is below the session's threshold
(the repeats of a salted side come on top, so the bound is ``salt`` times that). Beyond it adaptive
execution splits hot keys; where that is off, callers may ask for ``salt``, which repeats the lookup side
once per salt value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from portdelta.ship import by_value

_SALT = "_salt"


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, salt: int) -> DataFrame:
    """Equi join whose left keys may be hot or NULL; every right row meets every salt value once."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only the left side may be salted")
    if salt <= 1:
        return left.join(right, list(on), how)
    # The salt comes from the row itself, so a retried task gives the same split.
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salt))
    many = right.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))).alias(_SALT))
    return left.withColumn(_SALT, spread).join(many, [*on, _SALT], how).drop(_SALT)


def attach(rows: DataFrame, groups: DataFrame, on: Sequence[str], salt: int = 1) -> DataFrame:
    """Adds to each row the columns of its group; NULL is a value of ``on`` like any other.

    With ``groups`` aggregated from ``rows`` this does what a window over ``on`` does, without bringing
    all rows of a group into one task.
    """
    # Structs compare field by field with NULL equal to NULL, and stay a plain equi-join key.
    whole = F.struct(*on).alias("_id")
    extra = [c for c in groups.columns if c not in on]
    out = salted_join(rows.select("*", whole), groups.select(whole, *extra), ["_id"], "inner", salt)
    return out.select(*rows.columns, *extra)


def join_status_minute(
    counters: DataFrame,
    status: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    latest_only: bool = False,
) -> DataFrame:
    """Counter rows with the status sent in the same minute; counters without one keep NULLs.

    Several status rows in one minute multiply the counter row unless ``latest_only``.
    """
    minute = F.date_trunc("minute", ts).alias("_minute")
    extra = [c for c in status.columns if c not in keys and c != ts]
    right = status.select(*keys, minute, ts, *extra)
    if latest_only:
        newest = F.max_by(F.struct(*extra), F.struct(ts, *extra)).alias("_s")
        right = right.groupBy(*keys, "_minute").agg(newest).select(*keys, "_minute", "_s.*")
    else:
        right = right.drop(ts)
    # The minute is part of the key, so even one busy interface spreads over many tasks.
    return (
        counters.select("*", minute)
        .join(right, [*keys, "_minute"], "left")
        .select(*counters.columns, *extra)
    )


def join_inventory(counters: DataFrame, inventory: DataFrame, salt: int = 1) -> DataFrame:
    """Counters of interfaces listed in the inventory, with customer, location and speed."""
    right = inventory.select(
        F.col("routername").alias("devicename"),
        F.col("interface_name").alias("interface"),
        "customername",
        "location",
        "speed",
    )
    return salted_join(counters, right, ["devicename", "interface"], "inner", salt).select(
        "timestamp",
        "devicename",
        "interface",
        "in_octets",
        "out_octets",
        "customername",
        F.col("devicename").alias("routername"),
        "location",
        F.col("interface").alias("interface_name"),
        "speed",
    )


_SAMPLE_KEY = ["devicename", "interface", "timestamp"]


def join_speed(counters: DataFrame, speed: DataFrame) -> DataFrame:
    """Counters and speed of the same network element, interface and time; key columns appear once."""
    return counters.join(speed, _SAMPLE_KEY, "inner")


def semi_join_speed(counters: DataFrame, speed: DataFrame) -> DataFrame:
    """Keys of the counter rows that have a speed row; one output per counter row."""
    return counters.join(speed, _SAMPLE_KEY, "left_semi").select(*_SAMPLE_KEY)


def not_published(df: DataFrame, ledger: DataFrame, keys: Sequence[str] = tuple(_SAMPLE_KEY)) -> DataFrame:
    """Rows whose key is not in the ledger; NULL counts as a value of the key."""
    sent = ledger.select(*[F.col(k).alias(f"_sent_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_sent_{k}")) for k in keys])
    return df.join(sent, same, "left_anti")


# A node of one level covers 16 of the level below; the top level of 300-second buckets has nodes of 227 days.
_LEVEL_BITS, _TOP_LEVEL = 4, 4


def interval_nodes(lo: Column, hi: Column) -> Column:
    """The fewest ``(level, node)`` that cover the buckets from ``lo`` to ``hi``, both included: an array of structs.

    A level takes part with the nodes that lie inside while the one above them does not: 30 at most, but all of
    them on the top level.
    """

    def inside(k: int) -> tuple[Column, Column]:
        return F.shiftright(lo + (1 << _LEVEL_BITS * k) - 1, _LEVEL_BITS * k), F.shiftright(hi + 1, _LEVEL_BITS * k) - 1

    def on_level(level: int, nodes: Column) -> Column:
        return F.transform(nodes, lambda x: F.struct(F.lit(level).alias("level"), x.alias("node")))

    parts = []
    for level in range(_TOP_LEVEL + 1):
        first, last = inside(level)
        runs = [(first, last)]
        if level < _TOP_LEVEL:
            up_first, up_last = inside(level + 1)
            has_up = up_first <= up_last
            left = F.when(has_up, F.shiftleft(up_first, _LEVEL_BITS) - 1).otherwise(last)
            right = F.when(has_up, F.shiftleft(up_last + 1, _LEVEL_BITS)).otherwise(last + 1)
            runs = [(first, left), (right, last)]
        for a, b in runs:
            nodes = F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
            parts.append(on_level(level, nodes))
    return F.concat(*parts)


def with_interval_nodes(intervals: DataFrame, start: str, end: str, bucket_seconds: int) -> DataFrame:
    """Each interval once for every node that covers it, as ``_level`` and ``_node``."""
    lo, hi = (F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / bucket_seconds) for c in (start, end))
    right = intervals.where(F.col(start) <= F.col(end)).select("*", F.explode(interval_nodes(lo, hi)).alias("_at"))
    return right.select(*intervals.columns, F.col("_at.level").alias("_level"), F.col("_at.node").alias("_node"))


def range_join(
    df: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    ts: str,
    start: str,
    end: str,
    bucket_seconds: int = 300,
) -> DataFrame:
    """Rows with each interval of the same key that contains their time, both ends included.

    Intervals are cut into nodes of a tree over the time line, few of them however long an interval is; a row
    looks for its interval on each level that its key's intervals use, five at most. Level and node join the
    key, which keeps the join an equi join and cuts busy keys. ``bucket_seconds`` is the width of the lowest
    level's nodes: take it near the shortest usual interval.
    """
    right = with_interval_nodes(intervals, start, end, bucket_seconds)
    levels = right.groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))
    bucket = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / bucket_seconds)
    left = df.where(F.col(ts).isNotNull()).join(levels, list(keys)).select(*df.columns, bucket.alias("_bucket"), F.explode("_levels").alias("_level"))
    node = F.expr(f"shiftright(_bucket, {_LEVEL_BITS} * _level)")
    return (
        left.withColumn("_node", node)
        .join(right, [*keys, "_level", "_node"], "inner")
        .where((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end)))
        .drop("_bucket", "_level", "_node")
    )


# Status rows that a task gathers before it bundles them, and rows of a bundle at most.
_GATHERED, _BUNDLE = 200_000, 2048


def _bundles(keys: list[str], ts: str, extra: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of equal keys as one: the newest time and the list of their other columns, of bounded length."""

    def bundle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        numbered = table.select([*keys, ts]).append_column("_row", pa.array(np.arange(table.num_rows)))
        groups = numbered.group_by(keys, use_threads=False).aggregate([(ts, "max"), ("_row", "list")]).combine_chunks()
        rows = groups.column("_row_list").combine_chunks()
        starts, sizes = rows.offsets.to_numpy()[:-1], rows.value_lengths().to_numpy()
        pieces = -(-sizes // _BUNDLE)
        group = np.repeat(np.arange(len(sizes)), pieces)
        piece = np.arange(len(group)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        offsets = np.append(starts[group] + piece * _BUNDLE, len(rows.flatten())).astype(np.int32)
        struct = pa.StructArray.from_arrays([table.column(c).combine_chunks() for c in extra], names=extra)
        bundled = pa.ListArray.from_arrays(pa.array(offsets), struct.take(rows.flatten()))
        columns = [groups.column(c).take(pa.array(group)).combine_chunks() for c in [*keys, f"{ts}_max"]]
        yield from pa.Table.from_arrays([*columns, bundled], names=[*keys, ts, "_rows"]).to_batches(max_chunksize=1000)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for batch in batches:
            kept.append(batch)
            n += batch.num_rows
            if n >= _GATHERED:
                yield from bundle(pa.Table.from_batches(kept))
                kept, n = [], 0
        if n:
            yield from bundle(pa.Table.from_batches(kept))

    return run


def bundled(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """``keys``, ``ts`` and ``_rows``: rows of equal keys together, on a stream those of one micro-batch.

    ``ts`` is the newest time of the bundle and ``_rows`` the list of the other columns. It keeps no state. Rows of
    one key may come in several bundles; each has a bounded number of rows.
    """
    keys = list(keys)
    extra = [c for c in df.columns if c not in keys and c != ts]
    kinds = df.select(*keys, ts, *extra).schema
    schema = StructType([*kinds.fields[: len(keys) + 1]]).add("_rows", ArrayType(StructType(kinds.fields[len(keys) + 1 :])))
    return df.select(*keys, ts, *extra).repartition(*keys).mapInArrow(_bundles(keys, ts, extra), schema)


def join_status_stream(
    counters: DataFrame,
    status: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    delay: str = "10 minutes",
) -> DataFrame:
    """``join_status_minute`` on two streams: counters with the status of their minute, whichever comes first.

    Both sides may be ``delay`` late. A counter row without status appears, with NULLs, once the watermark is a
    minute past it; by then both sides have dropped what can find no partner any more. Status rows of one minute that
    come together are one row of the join and of its state, so a counter row meets them at once; it is repeated for
    each behind the join. Such a bundle is as late as its newest row.
    """
    keys = list(keys)
    extra = [c for c in status.columns if c not in keys and c != ts]
    left = counters.withWatermark(ts, delay).withColumn("_minute", F.date_trunc("minute", ts))
    own = [F.col(k).alias(f"_status_{k}") for k in keys]
    named = status.select(*own, F.date_trunc("minute", ts).alias("_status_minute"), F.col(ts).alias("_status_ts"), (F.struct(*extra) if extra else F.lit(True)).alias("_status"))
    right = bundled(named, [*(f"_status_{k}" for k in keys), "_status_minute"], "_status_ts").withWatermark("_status_ts", delay)
    same = [F.col(k) == F.col(f"_status_{k}") for k in keys] + [F.col("_minute") == F.col("_status_minute")]
    # The minutes agree; Spark needs the bounds on the times themselves to know when state can go.
    minute = F.expr("INTERVAL 1 MINUTE")
    bounds = [F.col("_status_ts") >= F.col(ts) - minute, F.col("_status_ts") <= F.col(ts) + minute]
    joined = left.join(right, reduce(Column.__and__, same + bounds), "left")
    each = joined.select(*counters.columns, F.explode_outer("_rows").alias("_one"))
    return each.select(*counters.columns, *[F.col("_one._status")[c].alias(c) for c in extra])


def self_join_window(
    df: DataFrame, keys: Sequence[str], ts: str, col: str, window_seconds: int = 300, watermark: str | None = None
) -> DataFrame:
    """Maximum, minimum and delta over every sample that shares a closed window with a sample of the window.

    Window ends count as inside, so the previous window belongs to it when a sample lies on the
    common boundary. The pairs of samples are never formed: one aggregate over windows of double
    length keeps the two halves apart, in batch and on streams alike.
    """
    if watermark:
        df = df.withWatermark(ts, watermark)
    double = F.window(ts, f"{2 * window_seconds} seconds", f"{window_seconds} seconds")
    middle = F.col("_w.start") + F.expr(f"INTERVAL {window_seconds} SECONDS")
    own = F.col(ts) >= middle
    value = F.col(col)
    parts = df.select(*keys, ts, col, double.alias("_w")).groupBy("_w", *keys).agg(
        F.max(F.when(own, value)).alias("_max"),
        F.min(F.when(own, value)).alias("_min"),
        F.max(F.when(~own, value)).alias("_before_max"),
        F.min(F.when(~own, value)).alias("_before_min"),
        F.max(F.col(ts) == middle).alias("_touches"),
        F.max(own).alias("_has_own"),
    )
    high = F.when(F.col("_touches"), F.greatest("_max", "_before_max")).otherwise(F.col("_max"))
    low = F.when(F.col("_touches"), F.least("_min", "_before_min")).otherwise(F.col("_min"))
    return parts.where("_has_own").select(
        *keys,
        middle.alias("window_start"),
        F.col("_w.end").alias("window_end"),
        high.alias("max_value"),
        low.alias("min_value"),
        (high - low).alias("delta_value"),
    )


# Fixed value: requests of this kind only ask whether the service is up.
HEALTHCHECK = "HEALTHCHECK"


def request_enrich(
    requests: DataFrame,
    lookup: DataFrame,
    thresholds: DataFrame,
    key: str,
    threshold_key: str,
    rule: Column,
    salt: int = 1,
) -> DataFrame:
    """Requests (``aid``, ``alarmPoint``, ...) answered from ``lookup`` (column ``key`` plus payload).

    Adds ``status`` (``HEALTHCHECK``, ``OK`` or ``ERROR``), ``result`` and ``message``. Health checks
    pass by the lookup; a request whose key is unknown gets an error answer. ``rule`` is the
    comparison, written over request columns, lookup payload and ``threshold`` (text).
    """
    health = (F.upper("aid") == HEALTHCHECK) | (F.upper("alarmPoint") == HEALTHCHECK)
    health = F.coalesce(health, F.lit(False))
    limits = thresholds.select(F.col("key").alias(threshold_key), F.col("value").alias("threshold"))
    asked = requests.withColumns(
        {"_health": health, "_key": F.when(~health, F.col(key))}
    )
    known = lookup.withColumnRenamed(key, "_key").withColumn("_known", F.lit(True))
    joined = salted_join(asked, known, ["_key"], "left", salt)
    joined = salted_join(joined, limits, [threshold_key], "left", salt)
    found = F.col("_known").isNotNull()
    shown = F.coalesce(F.col(key).cast("string"), F.lit("unknown key"))
    return joined.select(
        *requests.columns,
        F.when(F.col("_health"), HEALTHCHECK).when(found, "OK").otherwise("ERROR").alias("status"),
        F.when(~F.col("_health") & found, rule).alias("result"),
        F.when(~F.col("_health") & ~found, F.concat(F.lit("no data for "), shown)).alias(
            "message"
        ),
    )


def threshold_join(df: DataFrame, thresholds: DataFrame, on: str, salt: int = 1) -> DataFrame:
    """Adds ``threshold`` from a key/value table; rows without one keep NULL."""
    limits = thresholds.select(F.col("key").alias(on), F.col("value").alias("threshold"))
    return salted_join(df, limits, [on], "left", salt).select(*df.columns, "threshold")


by_value(__name__)
