"""Telemetry derived row by row from the ``events`` table, as rows and as messages of network elements.

All derivations are projections: the data grows with ``events`` and nothing is grouped or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from portdelta.session import fresh_path


# Counter expressions over event number e, user u and value in cents c; valid in Spark and in DuckDB.
COUNTERS = {
    "in_octets": "c",
    "in_octets_cum": "e * 1000 + c % 1000",
    "in_pkts": "c % 1000 + u",
    "in_multicast_pkts": "c % 17",
    "in_unicast_pkts": "c % 501",
    "in_discards": "e % 5",
    "in_errors": "e % 13",
    "in_broadcast_pkts": "u % 19",
    "out_octets": "c + e",
    "out_pkts": "e % 1000",
    "out_multicast_pkts": "e % 23",
    "out_unicast_pkts": "c + u",
    "out_discards": "u % 7",
    "out_errors": "e % 3",
    "out_broadcast_pkts": "c % 29",
    "in_fcs_errors": "e % 11",
    "last_clear": "u % 2",
    "carrier_transitions": "e % 31",
}
SENT = [name for name in COUNTERS if name != "in_octets_cum"]
KEYS = ["devicename", "interface"]
SUB_KEYS = [*KEYS, "subinterface"]

# The views as SQL, to be put after WITH.
TEL = f"""
base AS (
  SELECT event_id AS e, user_id AS u, ts, event_type, CAST(round(value * 100) AS BIGINT) AS c FROM events
),
tel AS (
  SELECT e AS event_id, u AS user_id, ts, date_trunc('minute', ts) AS fts, epoch_us(ts) // 1000 AS epoch_ms,
         epoch_us(ts) * 1000 + 7 AS epoch_ns,
         'dev-' || event_type AS devicename,
         'et-0/0/' || CAST(u % 4 AS VARCHAR) AS interface,
         CAST(u % 3 AS VARCHAR) AS subinterface,
         {", ".join(f"{expr} AS {name}" for name, expr in COUNTERS.items())}
  FROM base
)"""


def with_tel(select: str, *ctes: str) -> str:
    """SQL text over ``tel``; ``ctes`` are further named queries."""
    return "WITH " + ",\n".join([TEL, *ctes]) + "\n" + select


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shape_events(events: DataFrame) -> DataFrame:
    """``events`` rows, batch or stream, as telemetry samples."""
    base = events.selectExpr(
        "event_id AS e",
        "user_id AS u",
        "CAST(ts AS TIMESTAMP) AS ts",
        "event_type",
        "CAST(round(value * 100) AS BIGINT) AS c",
    )
    return base.selectExpr(
        "e AS event_id",
        "u AS user_id",
        "ts",
        "date_trunc('minute', ts) AS fts",
        "unix_millis(ts) AS epoch_ms",
        "unix_micros(ts) * 1000 + 7 AS epoch_ns",
        "'dev-' || event_type AS devicename",
        "'et-0/0/' || CAST(u % 4 AS STRING) AS interface",
        "CAST(u % 3 AS STRING) AS subinterface",
        *[f"{expr} AS {name}" for name, expr in COUNTERS.items()],
    )


def tel(spark: SparkSession, sf: str) -> DataFrame:
    return shape_events(table(spark, sf, "events"))


def spread_tel(spark: SparkSession, sf: str) -> DataFrame:
    """The samples dealt out evenly, for queries that build and parse messages."""
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shape_events(table(spark, sf, "events").repartition(pieces))


# Micro-batches of a stream, files of each at least, and rows of a file in larger tables.
_BATCHES, _FILES, _FILE_ROWS = 4, 2, 20_000


def stream_events(spark: SparkSession, sf: str, jitter_seconds: int = 0) -> DataFrame:
    """``events`` as a file stream of several micro-batches, in the order of time.

    With ``jitter_seconds`` an event comes up to that much later, by its number, so batches overlap in time.
    A micro-batch has more files the larger the table is, so that it is read by as many tasks as there are cores.
    All have the same number of files, as the source counts files; parts without rows write none.
    """
    events = table(spark, sf, "events")
    comes = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(jitter_seconds * 1_000_000 + 1))
    events = events.withColumn("_us", comes)
    cuts = events.approxQuantile("_us", [i / _BATCHES for i in range(1, _BATCHES)], 0.01)
    path = fresh_path(spark, "events")
    late = F.size(F.filter(F.array(*[F.lit(int(c)) for c in cuts]), lambda c: F.col("_us") > c))
    events = events.withColumn("_part", F.coalesce(late, F.lit(0)))
    sizes = {r["_part"]: r["count"] for r in events.groupBy("_part").count().collect()}
    files = max(_FILES, min(sizes.values(), default=0) // _FILE_ROWS)
    for i in sorted(sizes) or [0]:
        part = events.where(F.col("_part") == i).drop("_us", "_part")
        part.repartition(files).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.drop("_us", "_part").schema).option("maxFilesPerTrigger", files)
    return stream.parquet(path)


def stream_tel(spark: SparkSession, sf: str, jitter_seconds: int = 0) -> DataFrame:
    """The samples of ``tel`` as a stream of several micro-batches."""
    return shape_events(stream_events(spark, sf, jitter_seconds))


def _dash(name: str) -> str:
    return name.replace("_", "-")


def _single(key: Column, value: Column) -> Column:
    return F.create_map(key, value)


def _counter_struct(**values: Column) -> Column:
    return F.struct(*[v.alias(_dash(name)) for name, v in values.items()])


def _binary(json: Column) -> Column:
    return json.cast("binary").alias("value")


def _device_json(interfaces: Column) -> Column:
    return F.to_json(
        F.struct(
            F.col("devicename").alias("ucgDeviceName"),
            F.struct(
                F.struct(interfaces.alias("interface")).alias("interfaces"),
                F.col("epoch_ns").alias("timestamp"),
            ).alias("ucgJsonData"),
            F.col("event_id").cast("string").alias("ucgSequenceNum"),
            F.lit("PERF").alias("ucgSource"),
        )
    )


def device_messages(samples: DataFrame) -> DataFrame:
    """One message per sample: its interface with one sub-interface, and ``lo0`` without a name.

    Counters that are zero errors are not sent; every tenth message has no counters for ``lo0``.
    """
    e = F.col("event_id")
    sent = {name: F.col(name) for name in SENT}
    sent["in_errors"] = F.when(F.col("in_errors") != 0, F.col("in_errors"))
    sent["in_unknown_protos"] = e % 2
    sub = F.struct(
        F.col("subinterface").alias("index"),
        F.struct(
            _counter_struct(
                in_octets=F.col("in_octets") + 5_000_000_000,
                in_pkts=F.col("in_pkts"),
                out_octets=F.col("out_octets"),
                out_pkts=F.col("out_pkts"),
            ).alias("counters")
        ).alias("state"),
    )
    own = F.struct(
        F.col("interface").alias("name"),
        F.struct(_counter_struct(**sent).alias("counters")).alias("state"),
        F.struct(_single(F.col("subinterface"), sub).alias("subinterface")).alias("subinterfaces"),
    )
    loop = F.struct(
        F.struct(
            F.when(
                e % 10 != 0, _counter_struct(in_octets=F.col("in_octets") + 1, in_unknown_proto_pkts=F.lit(3))
            ).alias("counters")
        ).alias("state")
    )
    # The two interfaces differ in shape, so their JSON texts are put together.
    interfaces = F.concat(
        F.lit('{"'), F.col("interface"), F.lit('":'), F.to_json(own), F.lit(',"lo0":'), F.to_json(loop), F.lit("}")
    )
    text = F.concat(
        F.lit('{"ucgDeviceName":"'),
        F.col("devicename"),
        F.lit('","ucgJsonData":{"interfaces":{"interface":'),
        interfaces,
        F.lit('},"timestamp":'),
        F.col("epoch_ns").cast("string"),
        F.lit('},"ucgSequenceNum":"'),
        e.cast("string"),
        F.lit('","ucgSource":"PERF"}'),
    )
    return samples.select(_binary(text))


def small_device_messages(samples: DataFrame) -> DataFrame:
    """One message per sample with one interface and two counters."""
    one = F.struct(
        F.col("interface").alias("name"),
        F.struct(
            _counter_struct(in_octets=F.col("in_octets"), out_octets=F.col("out_octets")).alias("counters")
        ).alias("state"),
    )
    return samples.select(_binary(_device_json(_single(F.col("interface"), one))))


def kind_messages(samples: DataFrame) -> DataFrame:
    """Messages of four kinds by event number: counters, sub-interface counters, status, sub-status."""
    kind = F.col("event_id") % 4
    status = F.struct(
        F.when(kind == 0, _counter_struct(in_octets=F.col("in_octets"))).alias("counters"),
        F.when(kind == 2, F.lit("UP")).alias("admin-status"),
        F.when(kind == 2, F.lit(100000)).alias("high-speed"),
        F.when(kind == 2, F.lit("9192")).alias("mtu"),
    )
    sub = F.struct(
        F.col("subinterface").alias("index"),
        F.struct(
            F.when(kind == 1, _counter_struct(in_octets=F.col("in_octets"))).alias("counters"),
            F.when(kind == 3, F.lit("DOWN")).alias("oper-status"),
        ).alias("state"),
    )
    one = F.struct(
        F.col("interface").alias("name"),
        F.when(kind % 2 == 0, status).alias("state"),
        F.when(kind % 2 == 1, F.struct(_single(F.col("subinterface"), sub).alias("subinterface"))).alias(
            "subinterfaces"
        ),
    )
    return samples.select(_binary(_device_json(_single(F.col("interface"), one))))


def _system_interface(gaps: bool) -> Column:
    sent = {name: F.col(name).cast("string") for name in SENT}
    if gaps:
        sent["in_octets"] = F.when(F.col("event_id") % 97 != 0, sent["in_octets"])
        sent["out_errors"] = F.when(F.col("event_id") % 101 == 0, "abc").otherwise(sent["out_errors"])
    return F.struct(
        F.col("interface").alias("name"), F.struct(_counter_struct(**sent).alias("counters")).alias("state")
    )


def _system_json(interfaces: Column) -> Column:
    return F.to_json(
        F.struct(
            F.struct(
                F.struct(
                    F.col("devicename").alias("ucgDeviceName"),
                    F.lit("PERF").alias("ucgSource"),
                    F.lit("IF").alias("ucgType"),
                ).alias("metaData"),
                F.struct(F.struct(interfaces.alias("interface")).alias("interfaces")).alias("perf"),
                F.col("epoch_ms").cast("string").alias("timestamp"),
            ).alias("system")
        )
    )


def system_messages(samples: DataFrame) -> DataFrame:
    """``system`` messages: counters as text; some lack the lead counter, some hold a word for a number."""
    return samples.select(_binary(_system_json(_single(F.col("interface"), _system_interface(gaps=True)))))


def system_list_messages(samples: DataFrame) -> DataFrame:
    """``system`` messages that send their interfaces as a list."""
    return samples.select(_binary(_system_json(F.array(_system_interface(gaps=False)))))


def optics_messages(samples: DataFrame) -> DataFrame:
    """Optics messages: one component with two channels."""

    def channel(number: int) -> Column:
        return F.struct(
            F.lit(str(number)).alias("index"),
            F.struct(
                F.concat(F.lit("ch "), F.col("subinterface")).alias("description"),
                F.struct((F.col("in_octets") % 1000 - 500 + number).alias("instant")).alias("input-power"),
                F.struct(F.col("in_discards").alias("instant")).alias("laser-bias-current"),
                F.struct(F.col("in_errors").alias("instant")).alias("output-power"),
                F.col("out_discards").alias("target-output-power"),
                (F.col("event_id") % 2 == 0).alias("tx-laser"),
            ).alias("state"),
        )

    channels = F.create_map(F.lit("0"), channel(0), F.lit("1"), channel(1))
    component = F.struct(
        F.struct(F.struct(channels.alias("channel")).alias("physical-channels")).alias("transceiver")
    )
    return samples.select(
        _binary(
            F.to_json(
                F.struct(
                    F.col("devicename").alias("ucgDeviceName"),
                    F.struct(
                        F.struct(_single(F.concat(F.lit("oc-"), F.col("interface")), component).alias("component")).alias(
                            "components"
                        ),
                        F.col("epoch_ns").alias("timestamp"),
                    ).alias("ucgJsonData"),
                )
            )
        )
    )


def poll_messages(samples: DataFrame) -> DataFrame:
    """Poll messages with three elements: bytes in, bytes out, and an object nobody asks for."""
    e, up = F.col("event_id"), F.col("event_id") * 100

    def element(tag: str, orient: str, value: Column, previous: Column) -> Column:
        return F.struct(
            F.lit(tag).alias("oidTag"),
            up.cast("string").alias("sysUpTime"),
            (up - (F.col("in_octets") % 50) * 100).cast("string").alias("previousSysUpTime"),
            F.lit(orient).alias("orient"),
            value.cast("string").alias("value"),
            previous.cast("string").alias("previousValue"),
        )

    cum = F.col("in_octets_cum")
    elements = F.array(
        element("100.0", "1", cum, F.when(e % 9 != 0, cum - F.col("in_octets") % 500 + 100)),
        element("103", "0", F.col("out_octets"), F.col("out_octets") - F.col("out_pkts")),
        element("7", "1", cum, cum),
    )
    body = F.struct(
        F.col("epoch_ms").cast("string").alias("finishTime"),
        (F.col("epoch_ms") - 300_000).cast("string").alias("startTime"),
        F.when(e % 5 != 0, "IP").otherwise("ip").alias("dataType"),
        F.col("devicename").alias("deviceName"),
        F.when(e % 50 != 0, F.col("interface")).alias("ifDescr"),
        elements.alias("elements"),
    )
    return samples.select(_binary(F.to_json(body)), F.when(e % 20 != 0, "poller").alias("src"))
