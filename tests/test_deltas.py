"""Delta operators on the golden series, properties, and edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from portdelta.operators import deltas, windows
from portdelta.operators.rolling import delta_stateful

KEYS = ["devicename", "interface"]


def _col(df, order, col):
    return [r[col] for r in df.orderBy(order).collect()]


def test_delta_lag(golden):
    out = deltas.delta_lag(golden, KEYS, ["in_octets"], ["ts"])
    assert _col(out, "ts", "delta_in_octets") == [0, 67, 66, 66, 66, 66, 66, 66, 66, 132, 66]
    assert _col(out, "ts", "delta_time_sec") == [0] + [60] * 10


def test_overlapping_window(golden):
    out = deltas.delta_window(golden, KEYS, ["in_octets"], "ts")
    rows = out.orderBy("window_start").select(F.date_format("window_start", "HH:mm"), "delta_in_octets", "delta_time")
    assert [tuple(r) for r in rows.collect()] == [
        ("13:45", 0, 301),
        ("13:50", 331, 301),
        ("13:55", 396, 301),
        ("14:00", 0, 301),
    ]


def test_tumbling_window(golden):
    out = deltas.delta_window(golden, KEYS, ["in_octets"], "ts", "5 minutes", None)
    assert _col(out, "window_start", "delta_in_octets") == [265, 330, 0]


def test_deltas_add_up(golden):
    """Overlapping windows and previous-sample deltas lose no step; tumbling windows do."""
    total = 5197712 - 5196985
    lag = deltas.delta_lag(golden, KEYS, ["in_octets"], ["ts"])
    over = deltas.delta_window(golden, KEYS, ["in_octets"], "ts")
    tumbling = deltas.delta_window(golden, KEYS, ["in_octets"], "ts", "5 minutes", None)
    assert lag.agg(F.sum("delta_in_octets")).first()[0] == total
    assert over.agg(F.sum("delta_in_octets")).first()[0] == total
    assert tumbling.agg(F.sum("delta_in_octets")).first()[0] == 595


def test_duplicates_and_order_do_not_change_window_deltas(golden):
    once = deltas.delta_window(golden, KEYS, ["in_octets"], "ts").collect()
    twice = deltas.delta_window(golden.union(golden.orderBy(F.desc("ts"))), KEYS, ["in_octets"], "ts").collect()
    assert sorted(map(tuple, once)) == sorted(map(tuple, twice))


def test_groups_of_five(golden):
    out = deltas.delta_group(golden, KEYS, "in_octets", "ts").orderBy("group_id")
    assert [(r["in_octets"], r["delta_in_octets"]) for r in out.collect()] == [
        (5196985, 265),
        (5197316, 330),
        (5197712, 0),
    ]


def test_complete_windows(golden):
    out = deltas.delta_complete_window(golden, KEYS, ["in_octets"], "ts", "5 minutes")
    assert _col(out, "window_start", "delta_in_octets") == [265, 330]


def test_trailing_range(golden):
    out = deltas.delta_trailing(golden, KEYS, "in_octets", "ts").orderBy("ts")
    assert [(r["delta_in_octets"], r["interval_seconds"]) for r in out.collect()] == [
        (0, 0),
        (67, 60),
        (133, 120),
        (199, 180),
        (265, 240),
        (264, 240),
        (264, 240),
        (264, 240),
        (264, 240),
        (330, 240),
        (330, 240),
    ]


def test_stride_of_four(golden):
    out = deltas.delta_lag(golden, KEYS, ["in_octets"], ["ts"], n=4, first="null")
    assert _col(out, "ts", "delta_in_octets") == [None] * 4 + [265, 264, 264, 264, 264, 330, 330]


def test_rolling_restart(golden):
    out = delta_stateful(golden, KEYS, "in_octets", "ts").orderBy("start_time")
    rows = [(f"{r['start_time']:%H:%M}", f"{r['end_time']:%H:%M}", r["delta_in_octets"]) for r in out.collect()]
    assert rows == [("13:50", "13:55", 331), ("13:55", "14:00", 396)]


def test_sampled_windows(golden):
    out = deltas.delta_sampled(golden, KEYS, ["in_octets"], "ts").orderBy("ts")
    # 13:50 to 13:55 belong to the sampled part; 13:56 to 13:59 do not; 14:00 opens the next one.
    assert [(f"{r['ts']:%H:%M}", r["delta_in_octets"]) for r in out.collect()] == [
        (f"13:{50 + i}", 331) for i in range(6)
    ] + [("14:00", 0)]


def test_bucket_leaves_elapsed_time_open(golden):
    out = deltas.delta_bucket(golden, KEYS, ["in_octets"], "ts", "5 minutes")
    assert _col(out, "start_timestamp", "delta_in_octets") == [265, 330, 0]
    assert _col(out, "start_timestamp", "delta_time") == [None] * 3


@pytest.mark.parametrize("policy, want", [("negative", [0, 50, -120, 30]), ("zero", [0, 50, 0, 30]), ("null", [0, 50, None, 30])])
def test_counter_reset(spark, policy, want):
    base = dt.datetime(2024, 1, 1)
    rows = [("d", "i", base + dt.timedelta(minutes=m), v) for m, v in enumerate([100, 150, 30, 60])]
    df = spark.createDataFrame(rows, "devicename string, interface string, ts timestamp, in_octets long")
    out = deltas.delta_lag(df, KEYS, ["in_octets"], ["ts"], on_reset=policy)
    assert _col(out, "ts", "delta_in_octets") == want


def test_unknown_policy_is_refused(golden):
    with pytest.raises(ValueError):
        deltas.delta_lag(golden, KEYS, ["in_octets"], ["ts"], on_reset="wrap")
    with pytest.raises(ValueError):
        deltas.delta_lag(golden, KEYS, ["in_octets"], ["ts"], first="skip")


def test_samples_around_a_boundary(spark):
    """Half a second after the boundary is cut to the boundary's minute; a minute later is not."""
    base = dt.datetime(2024, 1, 1, 0, 5)
    rows = [("d", "i", base - dt.timedelta(minutes=1), 1), ("d", "i", base + dt.timedelta(milliseconds=500), 5)]
    rows.append(("d", "i", base + dt.timedelta(seconds=61), 9))
    df = spark.createDataFrame(rows, "devicename string, interface string, ts timestamp, in_octets long")
    out = deltas.delta_window(df, KEYS, ["in_octets"], "ts")
    assert _col(out, "window_start", "delta_in_octets") == [4, 4]


def test_two_samples_at_one_time(spark):
    when = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("d", "i", when, 2, 20), ("d", "i", when, 1, 10)],
        "devicename string, interface string, ts timestamp, event_id long, in_octets long",
    )
    out = deltas.delta_lag(df, KEYS, ["in_octets"], ["ts", "event_id"])
    assert _col(out, "event_id", "delta_in_octets") == [0, 10]


def test_every_nth_and_elapsed_groups(golden):
    assert _col(windows.every_nth(golden, KEYS, ["ts"], 5), "ts", "rn") == [5, 10]
    assert _col(windows.elapsed_group(golden, KEYS, "ts", 300), "ts", "group_id") == [0] * 5 + [1] * 5 + [2]


def test_poll_values(spark):
    rows = [
        ("IP", "d", "e0", "1800000", "100.0", "1", "150", "100", "600", "300", "src"),
        ("IP", "d", "e0", "1800000", "103", "0", "50", "100", "600", "300", None),
        ("ip", "d", "e0", "1800000", "103", "0", "50", "10", "600", "300", "src"),
        ("IP", "d", "e0", "1800000", "5", "0", "50", "10", "600", "300", "src"),
        ("IP", "d", "e0", "1800000", "100", "1", "x", "10", "600", "300", "src"),
        ("IP", "d", "e0", "1800000", "100", "1", "30", "10", "y", "300", "src"),
    ]
    names = "dataType deviceName ifDescr finishTime oidTag orient value previousValue sysUpTime previousSysUpTime src"
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))
    got = [(r["bytesInValue"], r["bytesOutValue"], r["deltaTime"], r["src"]) for r in deltas.poll_delta(df).collect()]
    assert sorted(got) == sorted([(50.0, 0.0, 3.0, "src"), (0.0, 0.0, 3.0, "UNKNOWN"), (0.0, 0.0, 3.0, "src")])
    assert deltas.poll_delta(df, dataset="SRC").count() == 2
