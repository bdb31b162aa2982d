"""Parsing, flattening, validation."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from portdelta.functions import like_ipv4, map_get, parse_ts, ts_from_ns
from portdelta.model import ENVELOPE, OPTICS_ENVELOPE, POLL_ENVELOPE, SYSTEM_ENVELOPE, SYSTEM_LIST_ENVELOPE
from portdelta.operators import flatten, parse
from portdelta.sinks import rows_to_json_value, to_message, to_psv
from portdelta.sources import parse_csv_message


def _messages(spark, *records):
    texts = [(r if isinstance(r, str) else json.dumps(r)).encode() for r in records]
    return spark.createDataFrame([(bytearray(t),) for t in texts], "value binary")


def _device(interfaces, time=1_716_563_270_797_799_700, **extra):
    return {"ucgDeviceName": "dev", "ucgJsonData": {"interfaces": {"interface": interfaces}, "timestamp": time}, **extra}


def _counters(**values):
    return {"state": {"counters": {k.replace("_", "-"): v for k, v in values.items()}}}


def test_time_keeps_four_digits(spark):
    df = _messages(spark, _device({"e0": {"name": "e0", **_counters(in_octets=1)}}))
    row = flatten.explode_interfaces(parse.parse_value(df, ENVELOPE)).first()
    assert row["timestamp"].isoformat() == "2024-05-24T15:07:50.797700"


def test_name_falls_back_to_the_map_key(spark):
    df = _messages(spark, _device({"key": {"name": "name", **_counters(in_octets=1)}, "bare": _counters(in_octets=2)}))
    rows = flatten.explode_interfaces(parse.parse_value(df, ENVELOPE)).collect()
    assert sorted((r["interface"], r["in_octets"]) for r in rows) == [("bare", 2), ("name", 1)]


def test_both_spellings_of_unknown_protocols(spark):
    df = _messages(
        spark, _device({"a": _counters(in_unknown_protos=1, out_unknown_proto_pkts=4), "b": _counters(in_unknown_proto_pkts=2)})
    )
    rows = flatten.explode_interfaces(parse.parse_value(df, ENVELOPE)).collect()
    assert sorted((r["in_unknown_protos"], r["out_unknown_protos"] or 0) for r in rows) == [(1, 4), (2, 0)]


def test_large_subinterface_counters(spark):
    sub = {"0": {"index": "0", **_counters(in_octets=47_440_161_820, out_octets=4_416_796_485_711)}}
    df = _messages(spark, _device({"re0": {"name": "re0", "subinterfaces": {"subinterface": sub}}}))
    row = flatten.explode_subinterfaces(parse.parse_value(df, ENVELOPE)).first()
    assert (row["subinterface"], row["in_octets"], row["out_octets"]) == ("0", 47_440_161_820, 4_416_796_485_711)


def test_missing_counters_by_policy(spark):
    df = parse.parse_value(_messages(spark, _device({"a": {"name": "a"}, "b": _counters(in_octets=None)})), ENVELOPE)
    assert {r["in_octets"] for r in flatten.flatten_all(df).collect()} == {0}
    assert {r["in_octets"] for r in flatten.flatten_all(df, missing="null").collect()} == {None}
    with pytest.raises(ValueError):
        flatten.flatten_all(df, missing="skip")


def test_flatten_all_has_interface_and_subinterface_rows(spark):
    sub = {"7": {"index": "7", **_counters(in_octets=3)}, "8": {}}
    df = _messages(spark, _device({"a": {**_counters(in_octets=1), "subinterfaces": {"subinterface": sub}}, "b": {}}))
    rows = flatten.flatten_all(parse.parse_value(df, ENVELOPE)).collect()
    got = sorted((r["interface"], r["subinterface"], r["in_octets"], r["ucgSource"]) for r in rows)
    assert got == [("a", "7", 3, ""), ("a", "8", 0, ""), ("a", "none", 1, ""), ("b", "none", 0, "")]


def test_unreadable_time_drops_the_record_and_missing_time_is_zero(spark):
    good, bad = _device({"a": {}}), _device({"a": {}}, time="soon")
    none = _device({"a": {}})
    del none["ucgJsonData"]["timestamp"]
    rows = flatten.flatten_all(parse.parse_value(_messages(spark, good, bad, none), ENVELOPE)).collect()
    assert sorted(r["timestamp"] for r in rows) == [0, 1_716_563_270_797_799_700]


def test_strict_flatten_drops_the_whole_record(spark):
    whole = _device({"a": _counters(in_octets=1), "b": _counters()})
    broken = _device({"a": _counters(in_octets=1), "b": {"state": {}}})
    rows = flatten.flatten_strict(parse.parse_value(_messages(spark, whole, broken), ENVELOPE)).collect()
    assert sorted((r["interface"], r["in_octets"]) for r in rows) == [("a", 1), ("b", 0)]


def test_rejects_carry_a_reason(spark):
    texts = [
        "no json",
        "17",
        '{"ucgJsonData": {}}',
        '{"ucgDeviceName": "d"}',
        '{"ucgDeviceName": "d", "ucgJsonData": {}}',
        '{"ucgDeviceName": "d", "ucgJsonData": {"interfaces": {}}}',
        '{"ucgDeviceName": "d", "ucgJsonData": {"interfaces": {"interface": {}}}}',
    ]
    valid, rejected = parse.validate_envelope(_messages(spark, *texts))
    got = {bytes(r["value"]).decode(): r["reject_reason"] for r in rejected.collect()}
    want = ["not_json", "not_json", "no_device", "no_data", "no_interfaces", "no_interfaces"]
    assert got == dict(zip(texts, want))
    assert [bytes(r["value"]).decode() for r in valid.collect()] == texts[-1:]


def test_bad_json_adds_no_rows(spark):
    df = parse.parse_value(_messages(spark, "no json", "{}", _device({})), ENVELOPE)
    assert df.count() == 3
    assert flatten.flatten_all(df).count() == 0
    assert all(rows.count() == 0 for rows in parse.split_record_kinds(df).values())


def test_message_is_parsed_once(spark, capsys):
    """Filters and window bounds above the parse must not bring copies of it."""
    from portdelta.plans import window_delta_rows

    window_delta_rows(_messages(spark, "{}"), watermark=None).explain()
    assert capsys.readouterr().out.count("from_json(") == 1


def test_system_message_as_map_and_as_list(spark):
    one = {"name": "e1", **_counters(in_octets="12")}
    shapes = [({"k": one}, SYSTEM_ENVELOPE), ([one], SYSTEM_LIST_ENVELOPE)]
    for interfaces, schema in shapes:
        record = {"system": {"metaData": {"ucgDeviceName": "d"}, "perf": {"interfaces": {"interface": interfaces}}, "timestamp": "5"}}
        df = parse.parse_value(_messages(spark, record), schema)
        row = flatten.explode_interface_list(df).first()
        assert (row["devicename"], row["timestamp"], row["interface"], row["in_octets"]) == ("d", "5", "e1", "12")


def test_optics(spark):
    state = {"description": "x", "input-power": {"instant": -3}, "tx-laser": True}
    comp = {"oc": {"name": "oc", "transceiver": {"physical-channels": {"channel": {"0": {"index": "0", "state": state}}}}}}
    df = _messages(spark, {"ucgDeviceName": "d", "ucgJsonData": {"components": {"component": comp}, "timestamp": 9}})
    row = flatten.flatten_optics(parse.parse_value(df, OPTICS_ENVELOPE)).first()
    assert tuple(row) == ("d", "oc", "0", "x", -3, None, None, None, True, 9)


def test_poll_elements(spark):
    record = {"deviceName": "d", "type": "outer", "elements": [{"oidTag": "1", "type": "inner"}, {"oidTag": "2"}]}
    rows = flatten.explode_elements(parse.parse_value(_messages(spark, record), POLL_ENVELOPE)).collect()
    assert [(r["deviceName"], r["oidTag"], r["type"]) for r in rows] == [("d", "1", "inner"), ("d", "2", None)]


def test_flatten_nested(spark):
    schema = "a struct<b: long, `c.d`: struct<e: string>>, l array<struct<x: long, y: array<long>>>"
    df = spark.createDataFrame([((1, ("s",)), [(2, [3, 4]), (5, [])])], schema)
    out = flatten.flatten_nested(df)
    assert out.columns == ["a_b", "a_c.d_e", "l_x", "l_y"]
    assert sorted(map(tuple, out.collect())) == [(1, "s", 2, 3), (1, "s", 2, 4)]
    assert flatten.flatten_nested(df, outer=True).count() == 3
    assert flatten.flatten_nested(df, explode_arrays=False).columns == ["a_b", "a_c.d_e", "l"]


def test_separated_record_with_a_null_part(spark):
    df = spark.createDataFrame([("a", None), ("b", 1)], "x string, y long")
    assert [r["value"] for r in to_psv(df, ["x", "y"]).orderBy("x").collect()] == [None, "b|1"]
    assert [r["value"] for r in to_psv(df, ["x", "y"], "skip").orderBy("x").collect()] == ["a", "b|1"]
    with pytest.raises(ValueError):
        to_psv(df, ["x"], "empty")


def test_messages_out(spark):
    df = spark.createDataFrame([("a", None)], "x string, y long")
    assert rows_to_json_value(df).first()[0] == '{"x":"a"}'
    assert rows_to_json_value(df, keep_nulls=True).first()[0] == '{"x":"a","y":null}'
    row = to_message(df, key="x").first()
    assert (bytes(row["key"]), bytes(row["value"])) == (b"a", b'{"x":"a"}')


def test_small_functions(spark):
    df = spark.createDataFrame([("1.2.3.4 x", "a.b", {"k": 5})], "ip string, no string, m map<string,long>")
    row = df.select(like_ipv4("ip"), like_ipv4("no"), map_get("m", "k", 0), map_get("m", "z", 0)).first()
    assert tuple(row) == (True, False, 5, 0)
    times = spark.sql("select '10-03-2023 13:50' a, '2023' b, 1716563270797799700L n")
    row = times.select(parse_ts("a", "MM-dd-yyyy HH:mm"), parse_ts("b", "MM-dd-yyyy HH:mm"), ts_from_ns("n")).first()
    assert (row[0].isoformat(), row[1], row[2].microsecond) == ("2023-10-03T13:50:00", None, 797700)


def test_separated_messages(spark):
    df = _messages(spark, "10.0.0.1,IP", "10.0.0.2", "a,b,c")
    rows = sorted(map(tuple, parse_csv_message(df, ["ip", "kind"]).collect()))
    assert rows == [("10.0.0.1", "IP"), ("10.0.0.2", None), ("a", "b")]
    dotted = parse_csv_message(_messages(spark, "a.b"), ["x", "y"], sep=".")
    assert tuple(dotted.first()) == ("a", "b")


def test_avro_is_optional(spark):
    df = spark.createDataFrame([("a",)], "value string").select(F.col("value").cast("binary"))
    try:
        out = parse.avro_decode(parse.avro_encode(df), '{"type": "bytes"}')
    except Exception as error:  # the module may be missing from the class path
        assert "avro" in str(error).lower()
    else:
        assert out.columns


def test_all_kinds_and_rejects_from_one_parse_and_one_write(spark, tmp_path, capfd):
    from portdelta.operators import route

    good = _sent("d", {"e0": {"name": "e0", "state": {"counters": {"in-octets": 5}, "admin-status": "UP", "mtu": "9192"},
                                 "subinterfaces": {"subinterface": {"7": {"state": {"counters": {"in-octets": 9}, "oper-status": "DOWN"}}}}},
                          "e1": {"state": {"counters": {"in-pkts": 1}}}})
    bad_field = _sent("d", {"e2": {"state": {"counters": {"in-octets": "many"}, "admin-status": "UP"}}})
    texts = [good, bad_field, "{broken", '{"x": 1}', '{"ucgDeviceName": "d"}', '{"ucgDeviceName": "d", "ucgJsonData": {"interfaces": {}}}', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    path = str(tmp_path / "routed")
    for _ in range(2):  # the second run replaces all folders
        route.write_routed(df, path)
    rows = {k: route.read_kind(spark, path, k).collect() for k in route.KIND_COLUMNS}
    assert [(r["interface"], r["in_octets"]) for r in rows["interface_counters"]] == [("e0", 5)]
    assert [(r["interface"], r["subinterface"], r["in_octets"]) for r in rows["subinterface_counters"]] == [("e0", "7", 9)]
    assert sorted((r["interface"], r["admin_status"], r["mtu"]) for r in rows["interface_status"]) == [("e0", "UP", "9192"), ("e2", "UP", None)]
    assert [(r["subinterface"], r["oper_status"]) for r in rows["subinterface_status"]] == [("7", "DOWN")]
    assert sorted(r["reject_reason"] for r in rows["rejected"]) == ["no_data", "no_device", "no_interfaces", "not_json", "not_json"]
    assert {r["value"] for r in rows["rejected"]} == set(texts[2:])
    # One scan feeds one parse.
    route.route_records(spark.read.schema("value string").parquet(_stored_texts(df, tmp_path))).explain("simple")
    plan = capfd.readouterr().out
    assert plan.count("FileScan") == 1 and plan.count("from_json(") == 1


def _stored_texts(df, tmp_path):
    df.write.parquet(str(tmp_path / "texts"))
    return str(tmp_path / "texts")


def _sent(device, interfaces):
    return json.dumps({"ucgDeviceName": device, "ucgJsonData": {"interfaces": {"interface": interfaces}, "timestamp": 1_700_000_000_000_000_000}})


_DEEP = """id long, head struct<name: string, tags: array<string>, pos: struct<x: int, y: int>>,
  parts array<struct<n: int, sub: array<struct<v: long, m: map<string, array<int>>>>>>, limits map<string, struct<lo: int, hi: int>>, grid array<array<int>>, plain string"""


def _deep_rows():
    return [
        (1, ("a", ["t1", None, "t3"], (1, None)), [(1, [(10, {"k": [1, 2], "e": []}), (11, None)]), (2, []), (3, None)], {"cpu": (1, 9), "mem": None}, [[1], [], None, [2, 3]], "p"),
        (2, None, None, None, None, None),
        (3, ("c", [], None), [None, (5, [None])], {}, [], "q"),
        (4, (None, None, (None, None)), [], {"x": (None, None)}, [None], None),
    ]


def test_shredded_siblings_do_not_multiply(spark):
    from portdelta.operators.shred import shred

    df = spark.createDataFrame([(1, [1, 2, 3], ["a", "b"], {"k": 1.0})], "id long, a array<int>, b array<string>, m map<string, double>")
    tables = shred(df, ["id"])
    assert {n: t.count() for n, t in tables.items()} == {"root": 1, "a": 3, "b": 2, "m": 1}
    assert [tuple(r) for r in tables["a"].collect()] == [(1, 0, 1), (1, 1, 2), (1, 2, 3)]
    assert tables["m"].columns == ["id", "m__key", "value"] and tables["root"].columns == ["id", "a__size", "b__size", "m__size"]


def test_every_table_is_flat_and_the_input_comes_back(spark):
    from pyspark.sql import types as T

    from portdelta.operators.shred import shred, unshred

    df = spark.createDataFrame(_deep_rows(), _DEEP)
    tables = shred(df, ["id"])
    assert sorted(tables) == ["grid", "grid.value", "head_tags", "limits", "parts", "parts.sub", "parts.sub.m", "parts.sub.m.value", "root"]
    assert not any(isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType) for t in tables.values() for f in t.schema.fields)
    again = unshred(tables, df.schema, ["id"])
    assert again.columns == df.columns
    want = {r["id"]: r.asDict(recursive=True) for r in df.collect()}
    assert {r["id"]: r.asDict(recursive=True) for r in again.collect()} == want
