"""Sources, sinks, joins with state, and end-to-end jobs."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from portdelta.model import ENVELOPE
from portdelta.operators import joins
from portdelta.operators.aggregates import latest_per_key, publish_stats
from portdelta.plans import batch_delta_job, flatten_lines_job, run_incremental
from portdelta.plans.incremental import EPOCH, last_mark
from portdelta.sinks import append_table, ensure_table, insert_select, stage_and_append, write_files, write_new_table
from portdelta.sources import kafka_options, pulsar_options, read_envelopes, read_json_inferred, read_properties
from portdelta.streaming import file_sink, publish_once

BASE = dt.datetime(2024, 1, 1)


def _minute(n: float) -> dt.datetime:
    return BASE + dt.timedelta(minutes=n)


def test_option_helpers():
    tls = {"cert": "c", "key": "k", "trust": "t"}
    got = pulsar_options("url", "topic", "sub", tls=tls)
    assert got["predefinedSubscription"] == "sub" and got["pulsar.client.authParams"] == "tlsCertFile:c,tlsKeyFile:k"
    assert "pulsar.client.authParams" not in pulsar_options("url", "topic")
    read = kafka_options("s", "t", "earliest", "sasl_ssl", "PLAIN", "jaas", "")
    assert read["subscribe"] == "t" and read["failOnDataLoss"] == "false"
    assert read["kafka.security.protocol"] == "SASL_SSL"
    assert kafka_options("s", "t", write=True)["topic"] == "t"


def test_multiline_and_properties(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text('{\n "a": 1,\n "b": {"c": "x"}\n}')
    assert read_json_inferred(spark, str(tmp_path / "m")).first()["b"]["c"] == "x"
    (tmp_path / "p.txt").write_text("a=1\n\nb = 2=3\nno value\n")
    rows = read_properties(spark, str(tmp_path / "p.txt")).collect()
    assert sorted(map(tuple, rows)) == [("a", "1"), ("b", "2=3")]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n long, s string")
    write_new_table(df, "t_new", str(tmp_path / "new"))
    with pytest.raises(Exception, match="exist"):
        write_new_table(df, "t_new", str(tmp_path / "new2"))
    assert not ensure_table(spark, "t_new", df.schema)
    insert_select(df.select("s", "n"), "t_new")
    append_table(df, "t_new")
    assert spark.table("t_new").count() == 3 and spark.table("t_new").select("n").distinct().count() == 1
    stage_and_append(df, "t_stage", "t_new", str(tmp_path / "stage"))
    assert spark.table("t_new").count() == 4 and not spark.catalog.tableExists("t_stage")
    bad = df.withColumn("n", F.assert_true(F.lit(False)).cast("long"))
    with pytest.raises(Exception):
        stage_and_append(bad, "t_stage2", "t_new", str(tmp_path / "stage2"))
    assert spark.table("t_new").count() == 4
    spark.sql("DROP TABLE t_new")


def test_status_join(spark):
    counters = spark.createDataFrame(
        [("d", "i", _minute(0.1), 1), ("d", "i", _minute(1.1), 2)], "devicename string, interface string, timestamp timestamp, v long"
    )
    status = spark.createDataFrame(
        [("d", "i", _minute(0.2), "UP"), ("d", "i", _minute(0.9), "DOWN"), ("d", "i", _minute(2), "UP")],
        "devicename string, interface string, timestamp timestamp, oper_status string",
    )
    keys = ["devicename", "interface"]
    rows = joins.join_status_minute(counters, status, keys).collect()
    assert sorted((r["v"], r["oper_status"] or "-") for r in rows) == [(1, "DOWN"), (1, "UP"), (2, "-")]
    rows = joins.join_status_minute(counters, status, keys, latest_only=True).collect()
    assert sorted((r["v"], r["oper_status"] or "-") for r in rows) == [(1, "DOWN"), (2, "-")]


def test_null_keys_count_as_published(spark):
    df = spark.createDataFrame([("d", None, BASE), ("d", "i", BASE)], "devicename string, interface string, timestamp timestamp")
    assert joins.not_published(df, df.limit(1)).count() == 1
    assert joins.not_published(df, df).count() == 0
    stats = publish_stats(df, joins.not_published(df, df.limit(1))).first()
    assert (stats["joined_rows"], stats["published_rows"], stats["already_published_rows"]) == (2, 1, 1)


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame([("a", BASE, 1), ("a", BASE, 2), ("b", BASE, 1)], "k string, ts timestamp, id long")
    assert sorted(map(tuple, latest_per_key(df, ["k"], "ts", ["id"]).collect())) == [("a", BASE, 2), ("b", BASE, 1)]


def test_requests(spark):
    requests = spark.createDataFrame(
        [("healthcheck", "x", 1, 5), ("a", "HEALTHCHECK", 9, 5), ("a", None, 1, 5), ("a", "p", 2, 1), ("a", "p", 3, 5), ("a", "p", None, 5)],
        "aid string, alarmPoint string, id long, v long",
    )
    lookup = spark.createDataFrame([(1, "dev"), (2, "dev")], "id long, name string")
    limits = spark.createDataFrame([("a", "3")], "key string, value string")
    rule = F.when(F.col("v") > F.col("threshold").cast("long"), "high").otherwise("low")
    rows = joins.request_enrich(requests, lookup, limits, "id", "aid", rule).collect()
    got = sorted((str(r["id"]), r["aid"], r["status"], r["result"], r["message"]) for r in rows)
    assert got == sorted(
        [
            ("1", "healthcheck", "HEALTHCHECK", None, None),
            ("9", "a", "HEALTHCHECK", None, None),
            ("1", "a", "OK", "high", None),
            ("2", "a", "OK", "low", None),
            ("3", "a", "ERROR", None, "no data for 3"),
            ("None", "a", "ERROR", None, "no data for unknown key"),
        ]
    )


def _source(spark, *rows):
    schema = "timestamp timestamp, devicename string, interface string, in_octets long, out_octets long, inserted_datetime timestamp"
    return spark.createDataFrame([(t, "d", "i", n, n, t) for t, n in rows], schema)


_INVENTORY = "routername string, interface_name string, customername string, location string, speed long"


def _delivered(spark, path, *rows):
    _source(spark, *rows).coalesce(1).write.mode("append").parquet(path)


def _joined(spark, dest):
    return sorted(r["in_octets"] for r in spark.read.option("basePath", dest).parquet(dest).collect())


def test_incremental_runs_take_each_file_once(spark, tmp_path):
    source, dest, state = (str(tmp_path / n) for n in ("source", "dest", "state"))
    inventory = spark.createDataFrame([("d", "i", "customer", "place", 10)], _INVENTORY)
    _delivered(spark, source, (_minute(5), 1), (_minute(6), 2), (_minute(6), 3))
    assert last_mark(spark, state) == EPOCH
    assert run_incremental(spark, source, inventory, dest, state, run_time=dt.datetime(2024, 1, 1, 6, tzinfo=dt.timezone.utc))
    assert last_mark(spark, state) == _minute(6).replace(tzinfo=dt.timezone.utc)
    assert spark.read.parquet(f"{state}/done").first()["run_time"] == "2024-01-01 06:00:00"
    assert not run_incremental(spark, source, inventory, dest, state)
    # Committed later, with times before the mark.
    _delivered(spark, source, (_minute(0), 4))
    assert run_incremental(spark, source, inventory, dest, state)
    assert _joined(spark, dest) == [1, 2, 3, 4]
    assert not run_incremental(spark, source, inventory, dest, state)
    assert _joined(spark, dest) == [1, 2, 3, 4]
    assert last_mark(spark, state) == _minute(6).replace(tzinfo=dt.timezone.utc)


def test_a_run_that_was_cut_off_is_repeated_with_its_own_files(spark, tmp_path, monkeypatch):
    from portdelta.plans import incremental

    source, dest, state = (str(tmp_path / n) for n in ("source", "dest", "state"))
    inventory = spark.createDataFrame([("d", "i", "customer", "place", 10)], _INVENTORY)
    _delivered(spark, source, (_minute(0), 1))

    def written_but_not_noted(*_):
        raise RuntimeError("lost")

    # The folder is written; the driver ends before the mark is.
    monkeypatch.setattr(incremental, "len", written_but_not_noted, raising=False)
    with pytest.raises(RuntimeError, match="lost"):
        run_incremental(spark, source, inventory, dest, state)
    monkeypatch.undo()
    assert _joined(spark, dest) == [1]
    _delivered(spark, source, (_minute(1), 2))
    assert run_incremental(spark, source, inventory, dest, state)
    assert _joined(spark, dest) == [1]
    assert run_incremental(spark, source, inventory, dest, state)
    assert _joined(spark, dest) == [1, 2] and not run_incremental(spark, source, inventory, dest, state)


def test_counts_come_with_the_write(spark, tmp_path):
    import shutil

    from portdelta.streaming import publish_counted

    rows = spark.createDataFrame([(i,) for i in range(50)], "k long")
    rows.write.parquet(str(tmp_path / "in"))
    inputs = spark.read.parquet(str(tmp_path / "in"))
    sent = spark.createDataFrame([(i,) for i in range(0, 50, 4)], "k long")

    def write(new):
        new.write.parquet(str(tmp_path / "out"))
        # Nothing can read the input again for its counts.
        shutil.rmtree(tmp_path / "in")

    got = publish_counted(inputs, lambda df: df.where("k % 2 = 0"), sent, ["k"], write)
    assert got == {"input_rows": 50, "joined_rows": 25, "published_rows": 12, "already_published_rows": 13}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12


def test_publish_once(spark, tmp_path):
    sent, ledger = str(tmp_path / "sent"), str(tmp_path / "ledger")
    keys = ["devicename", "interface", "timestamp"]

    def rows(*minutes):
        return spark.createDataFrame([("d", "i", _minute(m), str(m)) for m in minutes], "devicename string, interface string, timestamp timestamp, v string")

    assert not publish_once(rows(1).limit(0), ledger, keys, file_sink(sent))
    publish_once(rows(1, 1, 2), ledger, keys, file_sink(sent), batch_id=0)
    publish_once(rows(2, 3, 2000), ledger, keys, file_sink(sent), batch_id=1)
    publish_once(rows(2, 3, 2000), ledger, keys, file_sink(sent), batch_id=1)
    out = spark.read.option("basePath", sent).parquet(sent)
    assert sorted(r["v"] for r in out.collect()) == ["1", "2", "2000", "3"]
    entries = spark.read.option("basePath", ledger).parquet(ledger)
    assert entries.count() == entries.select(*keys).distinct().count() == 4


def _device(name, minute, interfaces):
    ns = int(_minute(minute).replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000_000
    return json.dumps({"ucgDeviceName": name, "ucgJsonData": {"interfaces": {"interface": interfaces}, "timestamp": ns}})


def test_batch_job(spark, tmp_path):
    lines = []
    for m in range(3):
        sub = {"0": {"index": "0", "state": {"counters": {"in-octets": m}}}}
        counters = {"in-octets": 10 * m, "in-pkts": m, "out-octets": m, "out-pkts": m}
        lines.append(_device("d", m, {"e": {"name": "e", "state": {"counters": counters}}}))
        lines.append(_device("d", m, {"e": {"name": "e", "subinterfaces": {"subinterface": sub}}}))
        lines.append(_device("d", m, {"e": {"name": "e", "state": {"admin-status": "UP", "oper-status": "UP"}}}))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    paths = [str(tmp_path / p) for p in ("csv1", "csv2", "out1", "out2")]
    batch_delta_job(spark, str(tmp_path / "in" / "*.json"), *paths)
    assert spark.read.option("header", True).csv(paths[0]).count() == 3
    rows = spark.read.json(paths[2]).orderBy("timestamp").collect()
    assert [(r["delta_in_octets"], r["delta_time_sec"], r["admin_status"]) for r in rows] == [(0, 0, "UP"), (10, 60, "UP"), (10, 60, "UP")]
    rows = spark.read.json(paths[3]).orderBy("timestamp").collect()
    assert [(r["delta_in_octets"], r["delta_time"], r["subinterface"]) for r in rows] == [(0, 0, "0"), (1, 60, "0"), (1, 60, "0")]


def test_flatten_job(spark, tmp_path):
    df = spark.createDataFrame([(_device("d", 0, {"e": {}}),), ("bad",)], "value string")
    flatten_lines_job(df, str(tmp_path / "out"), str(tmp_path / "bad"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0])["interface"] == "e"
    assert spark.read.json(str(tmp_path / "bad")).first()["reject_reason"] == "not_json"


def test_envelopes_are_read_with_one_schema(spark, tmp_path):
    write_files(spark.createDataFrame([(_device("d", 0, {"e": {}}),)], "value string"), str(tmp_path / "x"), "text")
    df = read_envelopes(spark, str(tmp_path / "x"))
    assert df.schema == ENVELOPE and df.first()["ucgDeviceName"] == "d"


def test_a_batch_opens_few_ledger_files_after_many_batches(spark, tmp_path, monkeypatch):
    from portdelta.streaming import publish

    ledger, sent = str(tmp_path / "ledger"), str(tmp_path / "sent")
    day = dt.timedelta(days=1)

    def batch(n):
        # One key of a day long ago, one of the day before yesterday, two of today; one was sent before.
        rows = [(BASE - 300 * day, n), (BASE + (n // 10 - 2) * day, n), (BASE + n // 10 * day, n), (BASE + n // 10 * day, max(n - 1, 0)), (None, n)]
        return spark.createDataFrame(rows, "timestamp timestamp, k long").coalesce(1)

    opened = []
    real = publish.read_ledger
    monkeypatch.setattr(publish, "read_ledger", lambda *a: opened.append(df := real(*a)) or df)
    for n in range(30):
        publish.publish_once(batch(n), ledger, ["timestamp", "k"], file_sink(sent), n, compact_after=8)
    # The last batch again, as after a restart.
    publish.publish_once(batch(29), ledger, ["timestamp", "k"], file_sink(sent), 29, compact_after=8)
    # Four days of nine folders at most; each of 30 batches wrote four.
    assert max(len(df.inputFiles()) for df in opened[-10:]) <= 4 * 9
    got = spark.read.option("basePath", sent).parquet(sent)
    want = {r for n in range(30) for r in map(tuple, batch(n).collect())}
    assert got.count() == len(want) and {(r["timestamp"], r["k"]) for r in got.collect()} == want


def test_keys_are_known_while_compaction_is_cut_off(spark, tmp_path, monkeypatch):
    from portdelta.streaming import publish

    ledger, sent = str(tmp_path / "ledger"), str(tmp_path / "sent")
    rows = spark.createDataFrame([(BASE, 1), (BASE, 2)], "timestamp timestamp, k long")
    for n in range(3):
        publish.publish_once(rows.where(f"k <= {n + 1}"), ledger, ["timestamp", "k"], file_sink(sent), n, compact_after=99)
    # Written, but the folders it covers are still there.
    spark.read.parquet(ledger).drop("part").selectExpr("*", "'upto-1' AS part").write.mode("append").partitionBy("day", "part").parquet(ledger)
    publish.publish_once(rows, ledger, ["timestamp", "k"], file_sink(sent), 3, compact_after=2)
    assert spark.read.option("basePath", sent).parquet(sent).count() == 2
    folders = publish._folders(spark, ledger, ["2024-01-01"])["2024-01-01"]
    assert len([f for f in folders if "=upto-" in f]) == 1
