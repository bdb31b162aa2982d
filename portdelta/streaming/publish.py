"""Publish each key once: new rows are those whose key is not in the ledger of sent keys.

The ledger has a folder for each day of the keys' times, and in it one for each batch. A batch opens the folders
of its own days only, whatever others there are. A repeated batch reads the ledger without its own entries and
replaces them, so a failure between the sink and the ledger neither loses nor repeats keys in a sink that
replaces its batches. When a day has gathered many batches, one job writes their keys to a single folder
``part=upto-<batch>``; the folders it covers go after that. A key that is found in both meanwhile does no harm.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portdelta.operators.joins import not_published
from portdelta.streaming.run import BatchSink

_DAY, _PART = "day", "part"
_BATCH, _UPTO = f"{_PART}=batch-", f"{_PART}=upto-"
# Fixed value: folder of a NULL partition value.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_COMPACT_AFTER = 16


def _one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def _folders(spark: SparkSession, path: str, days: Iterable[str]) -> dict[str, list[str]]:
    """Folders of batches and of compacted batches, by day; only these days' folders are listed."""
    jvm = spark._jvm
    out: dict[str, list[str]] = {}
    for day in days:
        where = jvm.org.apache.hadoop.fs.Path(f"{path}/{_DAY}={day}")
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()] if files.exists(where) else []
        out[day] = [f"{path}/{_DAY}={day}/{n}" for n in names if n.startswith((_BATCH, _UPTO))]
    return out


def _number(folder: str) -> int:
    return int(folder.rsplit("-", 1)[1])


def _key_schema(like: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in like.schema.fields if f.name in keys])


def read_ledger(spark: SparkSession, path: str, like: DataFrame, keys: Sequence[str], days: Iterable[str], batch_id: int) -> DataFrame:
    """Keys sent on ``days`` by other batches than ``batch_id``; empty if there are none."""
    own = f"{_BATCH}{batch_id}"
    folders = [f for found in _folders(spark, path, days).values() for f in found if f.rsplit("/", 1)[1] != own]
    schema = _key_schema(like, keys)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def compact_ledger(spark: SparkSession, path: str, like: DataFrame, keys: Sequence[str], days: Iterable[str], before: int, least: int = _COMPACT_AFTER) -> int:
    """Put the batches before ``before`` of each day that has ``least`` folders or more into one; tells how many days.

    Batches from ``before`` on may still be repeated and stay as they are.
    """
    due = {}
    for day, folders in _folders(spark, path, days).items():
        old = [f for f in folders if f.rsplit("/", 1)[1].startswith(_UPTO) or _number(f) < before]
        if len(old) >= least:
            due[day] = old
    if not due:
        return 0
    old = [f for folders in due.values() for f in folders]
    upto = max(_number(f) for f in old)
    schema = T.StructType([*_key_schema(like, keys).fields, T.StructField(_DAY, T.StringType(), True)])
    rows = spark.read.schema(schema).option("basePath", path).parquet(*old).dropDuplicates()
    rows = rows.withColumn(_PART, F.lit(f"upto-{upto}")).hint("rebalance", _DAY)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_DAY, _PART).parquet(path)
    for folder in (f for f in old if f.rsplit("/", 1)[1] != f"{_UPTO}{upto}"):
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(due)


def publish_once(
    df: DataFrame,
    ledger: str,
    keys: Sequence[str],
    sink: BatchSink,
    batch_id: int = 0,
    ts: str = "timestamp",
    compact_after: int = _COMPACT_AFTER,
) -> bool:
    """Send the rows of ``df`` whose key is new, one row per key, and enter the keys in the ledger.

    Returns whether there was anything to look at. Only ledger days that the batch has are read, each with fewer
    than ``compact_after`` folders and what came since.
    """
    spark = df.sparkSession
    df.persist()
    try:
        found = df.select(F.to_date(ts).cast("string").alias(_DAY)).distinct().collect()
        days = sorted(r[_DAY] or _NO_DAY for r in found)
        if not days:
            return False
        sent = read_ledger(spark, ledger, df, keys, days, batch_id)
        new = _one_per_key(not_published(df, sent, keys), keys).persist()
        try:
            sink(new, batch_id)
            (
                new.select(*keys, F.to_date(ts).cast("string").alias(_DAY), F.lit(f"batch-{batch_id}").alias(_PART))
                # One file per day where it is small, several where it is not.
                .hint("rebalance", _DAY)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(_DAY, _PART)
                .parquet(ledger)
            )
        finally:
            new.unpersist()
        compact_ledger(spark, ledger, df, keys, days, batch_id, compact_after)
    finally:
        df.unpersist()
    return True


def publish_once_stream(ledger: str, keys: Sequence[str], sink: BatchSink, ts: str = "timestamp") -> BatchSink:
    """``publish_once`` as the function of a stream's micro-batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        publish_once(batch, ledger, keys, sink, batch_id, ts)

    return write
