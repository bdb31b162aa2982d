"""Streams against their batch twins, late data, restarts, fan-out."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from portdelta.operators import deltas, joins
from portdelta.operators.rolling import delta_lag_stream, delta_stateful
from portdelta.plans import poll_stream, request_stream, window_delta_rows, window_delta_stream
from portdelta.sources import read_topic
from portdelta.streaming import fan_out, file_sink, publish_once_stream, run_for, start_stream, table_sink, topic_sink, unless_done

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "devicename string, interface string, ts timestamp, in_octets long"
KEYS = ["devicename", "interface"]
NOW = {"availableNow": True}


def _minute(n: float) -> dt.datetime:
    return BASE + dt.timedelta(minutes=n)


class Feed:
    """A folder that a stream reads file by file, and where its results go."""

    def __init__(self, spark, root, schema=SCHEMA):
        self.spark, self.root, self.schema = spark, root, schema
        self.files = 0

    def put(self, *rows):
        self.files += 1
        out = f"{self.root}/in/{self.files:03d}"
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.parquet(out)

    def stream(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        options = {"path": f"{self.root}/in/*", "maxFilesPerTrigger": "1"}
        return read_topic(self.spark, "parquet", options, schema)

    def run(self, df, name="q", sink=None):
        out = f"{self.root}/{name}-out"
        sink = sink or file_sink(out)
        start_stream(df, None, {}, f"{self.root}/{name}-state", NOW, batch_sink=sink).awaitTermination()
        return self.spark.read.option("basePath", out).parquet(out).drop("batch_id")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _samples(*minutes):
    return [("d", "i", _minute(m), int(m * 10)) for m in minutes]


def test_closed_windows_equal_batch(feed):
    rows = _samples(*range(0, 24))
    feed.put(*rows[:9])
    feed.put(*rows[9:])
    got = _rows(feed.run(deltas.delta_window(feed.stream(), KEYS, ["in_octets"], "ts", watermark="6 minutes")))
    batch = deltas.delta_window(feed.spark.createDataFrame(rows, SCHEMA), KEYS, ["in_octets"], "ts")
    closed = batch.where(F.col("window_end") <= F.lit(_minute(23 - 6)))
    assert got == _rows(closed) and len(got) == 4
    # A later sample closes the rest.
    feed.put(("d", "i", _minute(60), 0))
    again = _rows(feed.run(deltas.delta_window(feed.stream(), KEYS, ["in_octets"], "ts", watermark="6 minutes")))
    assert again == _rows(batch)


def test_late_rows_are_left_out(feed):
    feed.put(*_samples(0, 1, 30))
    # The watermark of a batch filters from the batch after the next one on.
    feed.put(*_samples(31))
    feed.put(("d", "i", _minute(2), 999))
    feed.put(*_samples(60))
    got = feed.run(deltas.delta_window(feed.stream(), KEYS, ["in_octets"], "ts", watermark="6 minutes"))
    first = got.where(F.col("window_start") == F.lit(BASE)).first()
    assert first["max_in_octets"] == 10


def test_self_join_window(feed):
    rows = [("d", "i", _minute(m), v) for m, v in [(0, 5), (3, 9), (5, 4), (6, 7), (11, 1), (12, 2)]]
    feed.put(*rows)
    feed.put(("d", "i", _minute(90), 0))
    got = feed.run(joins.self_join_window(feed.stream(), KEYS, "ts", "in_octets", watermark="6 minutes"))
    want = {(0, 9, 5), (5, 9, 4), (10, 2, 1)}
    assert {(r["window_start"].minute, r["max_value"], r["min_value"]) for r in got.collect()} == want


def test_rolling_state_survives_a_restart(feed):
    rows = _samples(0, 1, 4, 5, 7, 12, 13, 18, 19)
    want = None
    for part in (rows[:3], rows[3:5], rows[5:]):
        feed.put(*part)
        want = feed.run(delta_stateful(feed.stream(), KEYS, "in_octets", "ts"))
    assert _rows(want) == _rows(delta_stateful(feed.spark.createDataFrame(rows, SCHEMA), KEYS, "in_octets", "ts"))


def test_previous_sample_state(feed):
    feed.put(*_samples(0, 1))
    feed.put(*_samples(3), ("d", "i", _minute(0.5), 7), ("e", "i", _minute(9), 1))
    got = feed.run(delta_lag_stream(feed.stream(), KEYS, "in_octets", "ts"))
    assert [(r["ts"].minute, r["delta_time_sec"], r["delta_in_octets"]) for r in got.orderBy("ts").collect()] == [
        (0, 0, 0),
        # The late sample, half a minute past.
        (0, None, None),
        (1, 60, 10),
        (3, 120, 20),
        (9, 0, 0),
    ]


def test_publish_once_over_restarts(feed):
    keys = [*KEYS, "ts"]
    sink = publish_once_stream(f"{feed.root}/ledger", keys, file_sink(f"{feed.root}/q-out"), ts="ts")
    feed.put(*_samples(1, 2))
    feed.run(feed.stream(), sink=sink)
    feed.put(*_samples(2, 3), *_samples(3))
    out = feed.run(feed.stream(), sink=sink)
    assert [r["ts"].minute for r in out.orderBy("ts").collect()] == [1, 2, 3]


def test_fan_out_and_its_sinks(spark, feed):
    table = f"fan_{abs(hash(feed.root))}"
    sinks = [
        file_sink(f"{feed.root}/q-out"),
        table_sink(table, options={"path": f"{feed.root}/table"}),
        topic_sink("parquet", {"path": f"{feed.root}/topic"}),
    ]
    feed.put(*_samples(1, 2))
    assert feed.run(feed.stream(), sink=fan_out(sinks)).count() == 2
    assert spark.table(table).count() == 2
    values = [bytes(r["value"]).decode() for r in spark.read.parquet(f"{feed.root}/topic").collect()]
    assert sorted(json.loads(v)["in_octets"] for v in values) == [10, 20]
    spark.sql(f"DROP TABLE {table}")


def test_a_finished_sink_is_not_repeated(spark, feed):
    calls = []

    def append(batch, batch_id):
        batch.write.mode("append").parquet(f"{feed.root}/q-out")

    def fails_once(batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("topic is down")

    sink = fan_out([unless_done(append, f"{feed.root}/done"), fails_once])
    feed.put(*_samples(1, 2))
    with pytest.raises(Exception, match="topic is down"):
        feed.run(feed.stream(), sink=sink)
    assert feed.run(feed.stream(), sink=sink).count() == 2
    assert calls == [0, 0]


def test_duplicates_within_the_watermark(feed):
    feed.put(*_samples(1, 1, 2))
    feed.put(*_samples(2, 3))
    rows = feed.stream().withWatermark("ts", "6 minutes").dropDuplicatesWithinWatermark([*KEYS, "ts"])
    assert [r["ts"].minute for r in feed.run(rows).orderBy("ts").collect()] == [1, 2, 3]


def test_run_for_stops_a_query_and_raises_its_errors(spark, feed):
    rate = read_topic(spark, "rate", {"rowsPerSecond": "1"})
    query = start_stream(rate, "noop", {}, f"{feed.root}/rate", {"processingTime": "1 second"}, name="rate")
    run_for(query, 2, poll=1)
    assert not query.isActive

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    feed.put(*_samples(1))
    query = start_stream(feed.stream(), None, {}, f"{feed.root}/fail", {"processingTime": "1 second"}, batch_sink=fail)
    with pytest.raises(Exception, match="sink is down"):
        run_for(query, 60, poll=1)


def test_raw_topic_dump(spark, feed):
    feed_in = f"{feed.root}/text"
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(feed_in)
    lines = spark.readStream.text(feed_in)
    start_stream(lines, "text", {"path": f"{feed.root}/dump"}, f"{feed.root}/c", NOW).awaitTermination()
    assert sorted(r[0] for r in spark.read.text(f"{feed.root}/dump").collect()) == ["a", "b"]


def _system(minute, octets):
    counters = {"in-octets": str(octets), "out-octets": str(octets), "last-clear": "3"}
    ms = int(_minute(minute).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    body = {"interfaces": {"interface": {"e": {"name": "e", "state": {"counters": counters}}}}}
    record = {"system": {"metaData": {"ucgDeviceName": "d"}, "perf": body, "timestamp": str(ms)}}
    return (bytearray(json.dumps(record).encode()),)


def test_window_delta_job(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "value binary")
    feed.put(*[_system(m, m * 10) for m in range(6)])
    feed.put(_system(90, 0))
    window_delta_stream(feed.stream(), file_sink(f"{feed.root}/out"), f"{feed.root}/c", NOW).awaitTermination()
    rows = spark.read.parquet(f"{feed.root}/out").orderBy("start_epochtime", "end_epochtime").collect()
    got = [(r["in_octets"], r["last_clear"], r["delta_time_ms"], r["timestamp"].minute) for r in rows]
    assert got == [(0, 3, 0, 0), (50, 3, 300_000, 0), (0, 3, 0, 5)]
    assert window_delta_rows(feed.spark.read.parquet(f"{feed.root}/in/*"), watermark=None).count() == 5


def test_poll_job(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "value binary, src string")
    element = {"oidTag": "100", "sysUpTime": "600", "previousSysUpTime": "300", "orient": "1", "value": "5", "previousValue": "2"}
    record = {"finishTime": "1800000", "dataType": "IP", "deviceName": "d", "ifDescr": "e", "elements": [element]}
    feed.put((bytearray(json.dumps(record).encode()), "src"))
    poll_stream(feed.stream(), "text", {"path": f"{feed.root}/out"}, f"{feed.root}/c", "SRC", NOW).awaitTermination()
    assert spark.read.text(f"{feed.root}/out").first()[0] == "d|e|1970-01-01 00:30:00|3.0|0.0|3.0|src|19700101"


def test_request_job(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "aid string, alarmPoint string, id long")
    feed.put(("healthcheck", "p", 1), ("a", "p", 1), ("a", "p", 2))
    lookup = spark.createDataFrame([(1, "one")], "id long, name string")
    limits = spark.createDataFrame([("a", "3")], "key string, value string")
    rule = F.concat("name", F.lit(" "), "threshold")
    query = request_stream(feed.stream(), lookup, limits, "id", "aid", rule, file_sink(f"{feed.root}/out"), f"{feed.root}/c", NOW)
    query.awaitTermination()
    answers = [json.loads(bytes(r["value"])) for r in spark.read.parquet(f"{feed.root}/out").collect()]
    assert sorted(a["status"] for a in answers) == ["ERROR", "HEALTHCHECK", "OK"]
    assert [a["result"] for a in answers if a["status"] == "OK"] == ["one 3"]


def _late_stream(spark, tmp_path, batches, operator):
    """What ``operator`` gives for micro-batches of (key, second, value)."""
    from pyspark.sql import functions as F

    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "k string, s long, v long").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("k string, s long, v long").option("maxFilesPerTrigger", 1).parquet(source)
    rows = operator(stream.select("k", F.timestamp_seconds("s").alias("ts"), "v"))
    query = rows.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(out)
    query.awaitTermination()
    return spark.read.parquet(out)


def test_rolling_stream_leaves_late_samples_out(spark, tmp_path):
    from portdelta.operators.rolling import delta_stateful

    batches = [[("a", 0, 10), ("a", 60, 12)], [("a", 100, 20), ("a", 150, 25)], [("a", 50, -1), ("a", 160, 26)], [("a", 210, 40), ("b", 5, 1)]]
    got = _late_stream(spark, tmp_path, batches, lambda df: delta_stateful(df, ["k"], "v", "ts", 100))
    late = ("a", 50, -1)
    kept = spark.createDataFrame([r for b in batches for r in b if r != late], "k string, s long, v long")
    want = delta_stateful(kept.selectExpr("k", "timestamp_seconds(s) AS ts", "v"), ["k"], "v", "ts", 100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 2


def test_lag_stream_shows_late_samples_without_delta(spark, tmp_path):
    from portdelta.operators.rolling import delta_lag_stream

    batches = [[("a", 0, 10), ("a", 60, 12)], [("a", 100, 20)], [("a", 50, 11), ("a", 160, 26)]]
    got = _late_stream(spark, tmp_path, batches, lambda df: delta_lag_stream(df, ["k"], "v", "ts"))
    rows = sorted((int(r.ts.timestamp()), r.v, r.delta_time_sec, r.delta_v) for r in got.collect())
    assert [r[1:] for r in rows] == [(10, 0, 0), (11, None, None), (12, 60, 2), (20, 40, 8), (26, 60, 6)]


def _ordered_feed(spark, tmp_path, schema):
    feed = Feed(spark, str(tmp_path), schema)

    def run(df, name):
        out = f"{feed.root}/{name}-out"
        query = start_stream(df, None, {}, f"{feed.root}/{name}-state", NOW, batch_sink=file_sink(out), state_store="rocksdb")
        query.awaitTermination()
        return spark.read.option("basePath", out).parquet(out).drop("batch_id")

    return feed, run


FOUR = ["a", "b", "c", "d"]
_FOUR_SCHEMA = "k string, ts timestamp, id long, a long, b long, c long, d long"


def _shuffled(n, seed):
    """Samples of two keys with falling counters, nulls and a large number, out of order by less than five minutes."""
    import random

    rng = random.Random(seed)
    rows = [(rng.choice(["x", None]), _minute(i / 6), i, 2**60 + i, i if i % 7 else None, (i * 37) % 11, 5 * i) for i in range(n)]
    return sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(290)))


@pytest.mark.parametrize("policy", ["negative", "zero", "null"])
def test_shuffled_samples_give_the_batch_deltas(spark, tmp_path, policy):
    from portdelta.operators.reorder import delta_lag_ordered

    feed, run = _ordered_feed(spark, tmp_path, _FOUR_SCHEMA)
    rows = _shuffled(240, 4)
    assert rows != sorted(rows, key=lambda r: r[1])
    for at in range(0, 240, 60):
        feed.put(*rows[at : at + 60])
    feed.put(("x", _minute(600), 1000, 0, 0, 0, 0))
    got = run(delta_lag_ordered(feed.stream(), ["k"], FOUR, ["ts", "id"], "5 minutes", 120, policy), "lag")
    batch = deltas.delta_lag(spark.createDataFrame(rows, _FOUR_SCHEMA), ["k"], FOUR, ["ts", "id"], on_reset=policy)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(*got.columns).collect()))
    assert got.count() == 240


def test_a_sample_behind_the_watermark_is_left_out_and_state_survives_a_restart(spark, tmp_path):
    from portdelta.operators.reorder import delta_lag_ordered

    feed, run = _ordered_feed(spark, tmp_path, _FOUR_SCHEMA)
    kept = [("x", _minute(m), m, m, m, m, m) for m in (1, 2, 0, 14, 13)]
    feed.put(*kept[:3])
    feed.put(*kept[3:])
    run(delta_lag_ordered(feed.stream(), ["k"], FOUR, ["ts", "id"], "5 minutes", 60), "late")
    feed.put(("x", _minute(3), 99, 9, 9, 9, 9), ("x", _minute(60), 60, 60, 60, 60, 60))
    feed.put(("y", _minute(200), 0, 0, 0, 0, 0))
    got = run(delta_lag_ordered(feed.stream(), ["k"], FOUR, ["ts", "id"], "5 minutes", 60), "late")
    want = [(0, 0), (1, 1), (2, 1), (13, 11), (14, 1), (60, 46)]
    assert [(r["id"], r["delta_a"]) for r in got.orderBy("ts").collect()] == want


def test_complete_windows_on_a_stream(spark, tmp_path):
    from portdelta.operators.reorder import delta_complete_window_stream

    feed, run = _ordered_feed(spark, tmp_path, _FOUR_SCHEMA)
    rows = _shuffled(240, 9)
    # A window of two samples only, which is left out.
    rows += [("z", _minute(50), 500, 1, 1, 1, 1), ("z", _minute(51), 501, 1, 1, 1, 1)]
    for at in range(0, len(rows), 70):
        feed.put(*rows[at : at + 70])
    feed.put(("x", _minute(600), 1000, 0, 0, 0, 0))
    # Late: its window is reported already.
    feed.put(("x", _minute(0), 1001, 0, 0, 0, 0), ("x", _minute(601), 1002, 0, 0, 0, 0))
    stream = delta_complete_window_stream(feed.stream(), ["k"], FOUR, ["ts", "id"], 300, "5 minutes", 5)
    got = run(stream, "complete")
    batch = deltas.delta_complete_window(spark.createDataFrame(rows, _FOUR_SCHEMA), ["k"], FOUR, "ts", "300 seconds", 5, "id")
    assert _rows_of(got) == _rows_of(batch.select(*got.columns)) and got.count() > 10


def _rows_of(df):
    return sorted(map(str, df.collect()))


def test_closed_windows_leave_no_state(spark, tmp_path):
    from portdelta.operators.reorder import delta_complete_window_stream

    feed, _ = _ordered_feed(spark, tmp_path, _FOUR_SCHEMA)
    feed.put(*_shuffled(240, 2))
    feed.put(("x", _minute(600), 1000, 0, 0, 0, 0))
    rows = delta_complete_window_stream(feed.stream(), ["k"], FOUR, ["ts", "id"], 300, "5 minutes", 5)
    query = start_stream(rows, "noop", {}, f"{feed.root}/state", NOW, state_store="rocksdb")
    query.awaitTermination()
    left = spark.read.format("statestore").option("stateVarName", "first").option("flattenCollectionTypes", "true").load(f"{feed.root}/state")
    assert {r["key"][-1] for r in left.select("key").collect()} == {int(_minute(605).replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000}


_STATUS_SCHEMA = "devicename string, interface string, ts timestamp, oper_status string"


def test_two_streams_join_by_the_minute_and_free_their_state(spark, tmp_path):
    counters, status = Feed(spark, f"{tmp_path}/c"), Feed(spark, f"{tmp_path}/s", _STATUS_SCHEMA)
    counters.put(*_samples(0.1, 1.5, 2.2, 7.0))
    # Status of minute 1 twice; that of minute 2 comes a batch later, that of minute 7 before its counter.
    status.put(("d", "i", _minute(1.1), "UP"), ("d", "i", _minute(1.9), "DOWN"), ("d", "i", _minute(7.9), "UP"), ("e", "i", _minute(0.1), "UP"))

    def run():
        out = f"{tmp_path}/out"
        rows = joins.join_status_stream(counters.stream(), status.stream(), KEYS, "ts", "10 minutes")
        query = start_stream(rows, None, {}, f"{tmp_path}/state", NOW, batch_sink=file_sink(out))
        query.awaitTermination()
        held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        got = spark.read.option("basePath", out).parquet(out)
        return sorted((r["ts"].minute, r["oper_status"] or "-") for r in got.collect()), held

    early, held = run()
    # Minute 0 has no status, but the watermark has not passed it.
    assert early == [(1, "DOWN"), (1, "UP"), (7, "UP")] and held > 0
    counters.put(*_samples(50))
    status.put(("d", "i", _minute(2.9), "UP"))
    status.put(("d", "i", _minute(50.5), "UP"))
    counters.put(*_samples(51))
    status.put(("d", "i", _minute(52), "UP"))
    later, held = run()
    assert later == [(0, "-"), (1, "DOWN"), (1, "UP"), (2, "UP"), (7, "UP"), (50, "UP")]
    # Only rows near the watermark are left; a minute past it all the others are gone.
    assert held <= 4


def test_status_rows_of_a_minute_that_come_together_are_one_row_of_state(spark, tmp_path):
    counters, status = Feed(spark, f"{tmp_path}/c"), Feed(spark, f"{tmp_path}/s", _STATUS_SCHEMA)
    counters.put(*_samples(0.2, 7.0, 7.5))
    status.put(*[("d", "i", _minute(7 + i / 100), f"s{i}") for i in range(60)], (None, "i", _minute(7), "no key"), ("d", "i", None, "no time"))
    out = f"{tmp_path}/out"
    rows = joins.join_status_stream(counters.stream(), status.stream(), KEYS, "ts", "10 minutes")
    query = start_stream(rows, None, {}, f"{tmp_path}/state", NOW, batch_sink=file_sink(out))
    query.awaitTermination()
    got = spark.read.option("basePath", out).parquet(out).collect()
    assert sorted((r["ts"].second, r["oper_status"]) for r in got) == sorted((s, f"s{i}") for s in (0, 30) for i in range(60))
    # Three counter rows, the bundle of minute 7 and the two rows that meet nothing.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6


def test_bundles_hold_all_rows_and_few_each(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(joins, "_BUNDLE", 4)
    monkeypatch.setattr(joins, "_GATHERED", 20)
    keys = [["a", "b", None][i % 3] if i < 30 else "c" for i in range(47)]
    table = pa.table({"k": keys, "t": pa.array(range(47), pa.timestamp("us")), "x": pa.array(range(47)), "y": [[i] for i in range(47)]})
    got = [r for b in joins._bundles(["k"], "t", ["x", "y"])(table.to_batches(max_chunksize=7)) for r in b.to_pylist()]
    assert max(len(r["_rows"]) for r in got) == 4
    assert all(keys[v["x"]] == r["k"] and v["y"] == [v["x"]] for r in got for v in r["_rows"])
    assert sorted(v["x"] for r in got for v in r["_rows"]) == list(range(47))
    assert all(r["t"] >= table["t"][v["x"]].as_py() for r in got for v in r["_rows"])
    assert {r["t"] for r in got} <= set(table["t"].to_pylist())
    assert list(joins._bundles(["k"], "t", ["x"])(iter([]))) == []


def test_counts_of_each_micro_batch_come_from_the_listener(spark, feed):
    import time

    from portdelta.streaming import BatchCounts, counted

    told = []
    feed.put(*_samples(1, 2, 3))
    feed.put(*_samples(4))
    rows = counted(counted(feed.stream(), "read").where("in_octets > 10"), "kept")
    with BatchCounts(lambda *batch: told.append(batch)) as counts:
        out = f"{feed.root}/counted"
        query = start_stream(rows, None, {}, f"{feed.root}/counted-state", NOW, name="counted", batch_sink=file_sink(out))
        query.awaitTermination()
        end = time.monotonic() + 30
        while str(query.id) not in counts.ended and time.monotonic() < end:
            time.sleep(0.1)
    assert counts.rows["counted"] == {0: {"read": 3, "kept": 2}, 1: {"read": 1, "kept": 1}}
    assert [t[1] for t in told] == [0, 1] and counts.ended[str(query.id)] is None
    assert spark.read.parquet(out).count() == 3


def _staged_batches(spark, tmp_path, monkeypatch, events):
    """Files that ``stream_events`` wrote, and the event numbers of each micro-batch."""
    from portdelta.catalog import tel

    events.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(tel, "fresh_path", lambda spark, label: f"{tmp_path}/staged")
    stream, batches = tel.stream_events(spark, str(tmp_path)), []
    sink = lambda batch, n: batches.append(sorted(r[0] for r in batch.select("event_id").collect()))
    start_stream(stream, None, {}, f"{tmp_path}/state", NOW, batch_sink=sink).awaitTermination()
    return len(list((tmp_path / "staged").glob("*.parquet"))), [b for b in batches if b]


def _events(spark, n, second):
    return spark.range(0, n, 1, 3).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(second).alias("ts"), F.lit(1).cast("long").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value")
    )


def test_micro_batches_of_a_larger_table_have_more_files(spark, tmp_path, monkeypatch):
    n = 360_000
    files, batches = _staged_batches(spark, tmp_path, monkeypatch, _events(spark, n, F.col("id")))
    assert files >= 16
    assert [x for b in batches for x in b] == list(range(n))
    assert len(batches) == 4


def test_parts_without_events_do_not_shift_the_micro_batches(spark, tmp_path, monkeypatch):
    # Two quartiles of the times are the same, so that one part has no events.
    files, batches = _staged_batches(spark, tmp_path, monkeypatch, _events(spark, 1000, F.greatest(F.col("id"), F.lit(600))))
    assert [x for b in batches for x in b] == list(range(1000))
    assert files == 2 * len(batches)
