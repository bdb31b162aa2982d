"""Sliced windows against uncut ones, on keys far busier than a slice should be."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portdelta.operators import deltas, joins, windows
from portdelta.operators.rolling import delta_stateful
from portdelta.operators.slices import with_key_totals

KEYS = ["k"]


@pytest.fixture(scope="module")
def samples(spark):
    """A hot key, a sparse key with long gaps, a NULL key, NULL times and NULL values."""
    rng, base, rows = random.Random(7), dt.datetime(2024, 1, 1), []
    for n in range(900):
        key = "hot" if n % 3 else rng.choice(["sparse", None, "other"])
        span = 90_000 if key == "sparse" else 9_000
        when = base + dt.timedelta(seconds=rng.randrange(span))
        rows.append((key, None if n % 101 == 0 else when, n, None if n % 57 == 0 else rng.randrange(10_000)))
    return spark.createDataFrame(rows, "k string, ts timestamp, id long, v long").repartition(5).cache()


def _same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    assert a.columns == b.columns
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("n", [1, 4])
@pytest.mark.parametrize("seconds", [60, 600])
def test_lag(samples, n, seconds):
    spec = Window.partitionBy("k").orderBy("ts", "id")
    want = samples.withColumns({"p": F.lag("v", n).over(spec), "pt": F.lag("ts", n).over(spec)})
    got = windows.lag_columns(samples, KEYS, ["ts", "id"], {"v": "p", "ts": "pt"}, n, seconds)
    _same(got, want)


def test_lead_lag(samples):
    spec = Window.partitionBy("k").orderBy("ts", "id")
    want = samples.withColumn("span_v", F.lead("v", 3).over(spec) - F.lag("v", 3).over(spec)).where("span_v is not null")
    _same(windows.lead_lag_span(samples, KEYS, ["ts", "id"], "v", 3, seconds=120), want)


def test_running_number(samples):
    want = samples.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")).cast("long"))
    _same(windows.with_running_number(samples, KEYS, ["ts", "id"], "n", seconds=300), want)


def test_range_and_totals(samples):
    trailing = Window.partitionBy("k").orderBy(F.unix_seconds("ts")).rangeBetween(-240, 0)
    whole = Window.partitionBy("k")
    want = samples.withColumns(
        {"s": F.sum("v").over(trailing), "hi": F.max("v").over(trailing), "t": F.sum("v").over(whole)}
    )
    stats = {"s": ("sum", F.col("v")), "hi": ("max", F.col("v"))}
    got = windows.range_stat(samples, KEYS, "ts", stats, 240, {"t": (F.sum("v"), "sum")})
    _same(got, want)


@pytest.mark.parametrize("seconds", [1, 60, 240, 3600])
def test_range_first_last(samples, seconds):
    spec = Window.partitionBy("k").orderBy(F.unix_seconds("ts")).rangeBetween(-seconds, 0)
    by, second = F.struct("ts", "id"), F.unix_seconds("ts")
    want = samples.withColumns(
        {
            "first_v": F.min_by("v", by).over(spec),
            "last_v": F.max_by("v", by).over(spec),
            "interval_seconds": F.max(second).over(spec) - F.min(second).over(spec),
        }
    )
    _same(windows.range_first_last(samples, KEYS, "ts", "v", seconds, "id"), want)


def test_attached_and_sampled_deltas(samples):
    spec = Window.partitionBy("k", F.window("ts", "5 minutes")["start"])
    timed = samples.where("ts is not null")
    want = timed.withColumns(
        {
            "start_timestamp": F.min("ts").over(spec),
            "end_timestamp": F.max("ts").over(spec),
            "delta_v": F.max("v").over(spec) - F.min("v").over(spec),
        }
    )
    _same(deltas.delta_attach_interval(samples, KEYS, ["v"], "ts", "5 minutes"), want)
    slot = F.floor(F.unix_seconds("ts") / 600)
    spec = Window.partitionBy("k", slot)
    want = timed.where(F.unix_seconds("ts") % 600 < 301).withColumn("delta_v", F.max("v").over(spec) - F.min("v").over(spec))
    _same(deltas.delta_sampled(samples, KEYS, ["v"], "ts"), want)


def test_key_totals(samples):
    want = samples.withColumns({"a": F.min("ts").over(Window.partitionBy("k")), "b": F.max("v").over(Window.partitionBy("k"))})
    _same(with_key_totals(samples, KEYS, "ts", {"a": (F.min("ts"), "min"), "b": (F.max("v"), "max")}, 300), want)


def _rolling_by_hand(rows, span):
    out = []
    for key in {r["k"] for r in rows}:
        mine = sorted((r["ts"], r["v"]) for r in rows if r["k"] == key and r["ts"] is not None and r["v"] is not None)
        start, seen = None, []
        for when, value in mine:
            if start is None:
                start, seen = when, [value]
            elif when >= start + dt.timedelta(seconds=span):
                seen.append(value)
                out.append((key, start, when, max(seen) - min(seen)))
                start, seen = when, [value]
            else:
                seen.append(value)
    return out


@pytest.mark.parametrize("span, width", [(300, 600), (60, 1), (1000, 7000)])
def test_rolling_against_a_loop(samples, span, width):
    got = delta_stateful(samples, KEYS, "v", "ts", span, width)
    want = _rolling_by_hand(samples.collect(), span)
    key = lambda r: (str(r[0]), r[1])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)




@pytest.mark.parametrize("salt", [1, 5])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, samples, salt, how):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("other", 3), ("unused", 4)], "k string, w long")
    _same(joins.salted_join(samples, right, KEYS, how, salt), samples.join(right, KEYS, how))


def test_range_join(spark, samples):
    base = dt.datetime(2024, 1, 1)
    spans = [("hot", 0, 1000), ("hot", 900, 905), ("sparse", 5, 80_000), ("other", 50, 50), ("other", 60, 10)]
    rows = [(k, base + dt.timedelta(seconds=a), base + dt.timedelta(seconds=b)) for k, a, b in spans]
    spans = spark.createDataFrame(rows, "k string, a timestamp, b timestamp")
    want = samples.join(spans, KEYS).where("ts >= a and ts <= b")
    _same(joins.range_join(samples, spans, KEYS, "ts", "a", "b", 200), want)


def test_rolling_chain_of_a_hot_key_stays_in_bounded_groups(spark):
    """Two million seconds of one key: no group holds more than 256 tables of one span's times."""
    from portdelta.operators import rolling
    from portdelta.operators.slices import SLICE

    width, span, step = 1200, 300, 7
    samples = spark.range(0, 2_000_000 // step).selectExpr("'hot' AS k", f"timestamp_seconds(1700000000 + id * {step} + id % 3) AS ts", "id % 997 AS v")
    times = rolling._samples(samples, ["k"], "v", "ts", width).select("k", SLICE, "_t")
    levels = rolling.jump_levels(times, ["k"], width, span * 1_000_000)
    sizes = []
    for level in levels:
        group = rolling._with_up(level).groupBy("k", rolling._UP).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(SLICE).alias("tables"))
        sizes.append(group.agg(F.max("n"), F.max("tables"), F.sum("n")).first())
    assert sizes[0][2] > 20_000  # what met in one group before
    assert all(n <= 256 * (span // step + 4) and tables <= 256 for n, tables, _ in sizes)
    assert levels[-1].count() <= span // step + 4
    got = delta_stateful(samples, ["k"], "v", "ts", span, width)
    t = [1700000000 + i * step + i % 3 for i in range(2_000_000 // step)]
    starts, last = [], None
    for x in t:
        if last is None or x >= last + span:
            starts.append(x)
            last = x
    assert [r[0].timestamp() for r in got.orderBy("start_time").select("start_time").collect()] == starts[:-1]


def test_composed_tables_equal_one_table_of_the_whole():
    import numpy as np

    from portdelta.operators import rolling

    rng = random.Random(11)
    for _ in range(200):
        span, width = 50, 200
        times = np.array(sorted(rng.sample(range(0, 3000), rng.randrange(1, 120))))
        slices = [times[times // width == s] for s in sorted(set(times // width))]
        parts = [rolling._slice_table(s, int(s[0]) // width * width, span) for s in slices]
        upto, leaves = rolling._composed(parts, span)
        begin = int(times[0]) // width * width
        for since in [None, *range(begin - 2 * span, begin)]:
            want = since
            for x in times:
                if want is None or x >= want + span:
                    want = x
            assert rolling._entered([(upto, leaves), (times[:1], times[:1])], since, span)[1] == want


@pytest.mark.parametrize("seconds", [0, 1, 7, 16, 97, 300, 1021, 20_000])
def test_trailing_statistics_for_any_range(samples, seconds):
    trailing = Window.partitionBy("k").orderBy(F.unix_seconds("ts")).rangeBetween(-seconds, 0)
    whole = Window.partitionBy("k")
    stats = {"total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.struct("v", "id"))}
    want = samples.withColumns({"total": F.sum("v").over(trailing), "low": F.min("v").over(trailing), "high": F.max(F.struct("v", "id")).over(trailing), "every": F.sum("v").over(whole)})
    _same(windows.range_stat(samples, KEYS, "ts", stats, seconds, {"every": (F.sum("v"), "sum")}), want)


def test_groups_of_a_long_range_on_a_hot_key_stay_small(spark, monkeypatch):
    rows = spark.range(0, 200_000).selectExpr("'hot' AS k", "timestamp_seconds(1700000000 + id) AS ts", "id", "id % 991 AS v")
    seen = []
    real = windows.drop_ghosts
    monkeypatch.setattr(windows, "drop_ghosts", lambda df: seen.append(df) or real(df))
    got = windows.range_stat(rows, KEYS, "ts", {"low": ("min", F.col("v")), "n": ("sum", F.lit(1))}, 86_400)
    group = seen[0].groupBy("k", "_slice").count().agg(F.max("count")).first()[0]
    assert group <= 2 * 86_400 // 64 + 1  # a block and what leaves it, a thirty-second of the range
    assert got.agg(F.max("n")).first()[0] == 86_401
    last = got.where("id = 199999").first()
    assert (last["low"], last["n"]) == (0, 86_401)


def _intervals(spark, seed):
    rng, base = random.Random(seed), dt.datetime(2024, 1, 1)
    rows = []
    for n in range(150):
        a = base + dt.timedelta(seconds=rng.randrange(0, 400 * 86_400), microseconds=rng.randrange(10**6))
        b = a + dt.timedelta(seconds=rng.choice([0, 1, 299, 300, 5_000, 86_400, 40 * 86_400, 365 * 86_400, -5]))
        rows.append((rng.choice(["p", "q", None]), a, b, n))
    times = [(rng.choice(["p", "q", None]), base + dt.timedelta(seconds=rng.randrange(0, 800 * 86_400)), i) for i in range(1500)]
    times += [(k, t, 5_000 + n) for k, a, b, n in rows for t in (a, b)] + [("p", None, 9_999)]
    return spark.createDataFrame(times, "k string, ts timestamp, id long"), spark.createDataFrame(rows, "k string, a timestamp, b timestamp, n long")


@pytest.mark.parametrize("bucket", [1, 300, 86_400])
def test_interval_join_of_seconds_and_years(spark, bucket):
    df, intervals = _intervals(spark, bucket)
    want = df.join(intervals, "k").where("ts >= a AND ts <= b").select("k", "ts", "id", "a", "b", "n")
    got = joins.range_join(df, intervals, KEYS, "ts", "a", "b", bucket)
    _same(got, want)
    assert got.count() > 1000


def test_an_interval_needs_few_nodes_however_long_it_is(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 7)
    lengths = [1, 300, 3_600, 86_400, 30 * 86_400, 365 * 86_400]
    rows = [("p", base + dt.timedelta(seconds=s), base + dt.timedelta(seconds=s + n), n) for n in lengths for s in range(0, 50_000, 977)]
    intervals = spark.createDataFrame(rows, "k string, a timestamp, b timestamp, n long")
    nodes = joins.with_interval_nodes(intervals, "a", "b", 300)
    most = {r["n"]: r["m"] for r in nodes.groupBy("k", "a", "n").count().groupBy("n").agg(F.max("count").alias("m")).collect()}
    assert most[1] <= 2 and most[365 * 86_400] <= 4 * 30 + 2 and max(most.values()) < 122  # 105,000 buckets before
    # Nodes of an interval do not overlap, so no row meets it twice.
    seconds = nodes.selectExpr("n", "a", "_node * pow(16, _level) AS lo", "(_node + 1) * pow(16, _level) AS hi")
    after = Window.partitionBy("n", "a").orderBy("lo")
    assert seconds.withColumn("next", F.lead("lo").over(after)).where("next IS NOT NULL AND next <> hi").count() == 0
