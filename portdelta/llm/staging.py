"""Tables a job reads more than once, and sums that stay bounded on their way to the driver."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portdelta.session import fresh_path
from portdelta.ship import by_value


_recorders: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Note the tables staged meanwhile, so that the caller can ``remove`` them when nothing reads them any more."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders.remove(paths)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Let Hadoop's file system remove ``path`` when the driver ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in Arrow batches of about 4 MB, so that long texts need little memory."""
    key, most = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
    now = spark.conf.get(key) or ""
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > most:
        spark.conf.set(key, str(most))


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so no later step computes it again.

    The folder is the one named by ``spark.checkpoint.dir``; what is written goes when the driver ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    drop_at_exit(spark, path)
    for paths in _recorders:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def kept_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``staged``, with the path, for callers that ``remove`` the table themselves."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def summed_blocks(parts: DataFrame, width: int) -> np.ndarray:
    """Sum of equally long float64 vectors, cut in blocks: columns ``block int, sums binary``.

    Every task sends one row per block; the blocks are added on the executors, one group per block and
    salt, so the driver only gets ``blocks`` rows whatever the number of tasks is.
    """
    schema = "block int, sums binary"

    def add(table: pa.Table) -> pa.Table:
        total = None
        for value in table.column("sums"):
            one = np.frombuffer(value.as_py(), dtype="<f8")
            total = one.copy() if total is None else total + one
        return pa.table({"block": [table.column("block")[0].as_py()], "sums": [total.tobytes()]}, _arrow_schema())

    salted = parts.withColumn("salt", F.spark_partition_id() % 16)
    first = salted.groupBy("block", "salt").applyInArrow(lambda t: add(t.drop_columns(["salt"])), schema)
    rows = first.groupBy("block").applyInArrow(add, schema).collect()
    found = sorted(rows, key=lambda r: r["block"])
    return np.concatenate([*(np.frombuffer(r["sums"], dtype="<f8") for r in found), np.zeros(width)])[:width]


def key_bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bit of the leading ``bits`` bits of every long ``key``, gathered in pieces of 4 KB.

    The result has ``2 ** bits / 8`` bytes whatever the number of keys; no more than that arrives.
    """
    # Spark counts the bits of its bitmaps from 1.
    place = F.shiftrightunsigned("key", 64 - bits) + 1
    pieces = keys.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in pieces.collect():
        at = (r["piece"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _arrow_schema() -> pa.Schema:
    return pa.schema([("block", pa.int32()), ("sums", pa.binary())])


def blocks_of(total: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """Rows for ``summed_blocks``; the last block is filled up with zeros."""
    total = np.asarray(total, dtype="<f8")
    for n, at in enumerate(range(0, len(total), size)):
        part = np.zeros(size)
        part[: len(total[at : at + size])] = total[at : at + size]
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([part.tobytes()], pa.binary())], schema=_arrow_schema())


def column(values: Iterable, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)


by_value(__name__)
