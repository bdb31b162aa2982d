"""Incremental join of new counter files with the inventory.

What has been processed is a manifest of source files, not a time: rows that are committed late are new however
old their times are. A run first notes the files it will take, then writes its own folder, then notes that it
is done. A run that was cut off is repeated with the same files and replaces its folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portdelta.operators.joins import join_inventory

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_FILE = "path string, modified timestamp, length long"
_DONE = T.StructType([T.StructField("newest", T.TimestampType()), T.StructField("run_time", T.StringType()), T.StructField("files", T.LongType())])


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The table, empty if there is none yet."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def source_files(spark: SparkSession, source: str) -> DataFrame:
    """``path, modified, length`` of the data files below ``source``; none of them is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    named = files.select("path", F.col("modificationTime").alias("modified"), "length")
    return named.where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))


def last_mark(spark: SparkSession, state: str) -> dt.datetime:
    """Newest insert time that any finished run has seen, with its time zone; the epoch if there is none."""
    micros = _read(spark, f"{state}/done", _DONE).agg(F.max(F.unix_micros("newest"))).first()[0]
    return EPOCH if micros is None else EPOCH + dt.timedelta(microseconds=micros)


def run_time_text(run_time: dt.datetime, pattern: str = "%Y-%m-%d %H:%M:%S") -> str:
    """A run's time as text, in UTC: the caller passes the time, so a repeated run can pass the same."""
    return run_time.astimezone(dt.timezone.utc).strftime(pattern)


def _next_files(spark: SparkSession, source: str, state: str) -> tuple[int, list[str]]:
    """Number and files of the run to do: the one that was cut off, else what the manifest does not have."""
    taken = _read(spark, f"{state}/files", f"{_FILE}, run long")
    done = _read(spark, f"{state}/done", T.StructType([*_DONE.fields, T.StructField("run", T.LongType())]))
    open_runs = taken.join(done.select("run"), "run", "left_anti")
    run = open_runs.agg(F.min("run")).first()[0]
    if run is not None:
        return run, [r["path"] for r in open_runs.where(F.col("run") == run).select("path").collect()]
    run = (taken.agg(F.max("run")).first()[0] or 0) + 1
    new = source_files(spark, source).join(taken.drop("run", "length"), ["path", "modified"], "left_anti")
    new.write.mode("overwrite").parquet(f"{state}/files/run={run}")
    # File names only, as a scan's planning holds them as well.
    return run, [r["path"] for r in spark.read.schema(_FILE).parquet(f"{state}/files/run={run}").select("path").collect()]


def run_incremental(
    spark: SparkSession,
    source: str,
    inventory: DataFrame,
    dest: str,
    state: str,
    ts: str = "inserted_datetime",
    shape: Callable[[DataFrame], DataFrame] | None = None,
    run_time: dt.datetime | None = None,
) -> bool:
    """Join the rows of files that no run has taken yet and write them below ``dest``; tells whether there were any.

    ``source`` is a folder of Parquet files; ``shape`` makes the counter rows of what they hold. A file that was
    replaced is new. Files are read once; the newest ``ts`` is observed on the way and kept, with the text of
    ``run_time``, as the mark of the run.
    """
    run, files = _next_files(spark, source, state)
    if not files:
        return False
    rows = spark.read.option("basePath", source).parquet(*files)
    rows = shape(rows) if shape else rows
    seen = Observation(f"run-{run}")
    batch = rows.observe(seen, F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("newest"))
    join_inventory(batch, inventory).write.mode("overwrite").parquet(f"{dest}/run={run}")
    newest = seen.get["newest"]
    mark = spark.range(1).select(
        F.timestamp_micros(F.lit(newest).cast("long")).alias("newest"),
        F.lit(run_time_text(run_time) if run_time else None).cast("string").alias("run_time"),
        F.lit(len(files)).cast("long").alias("files"),
    )
    mark.write.mode("overwrite").parquet(f"{state}/done/run={run}")
    return True
