"""Starting and watching streams, and micro-batch sinks."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from portdelta.sinks.tables import append_table
from portdelta.sinks.topics import to_message, write_topic

log = logging.getLogger(__name__)

BatchSink = Callable[[DataFrame, int], None]

_PARTITIONS = "spark.sql.shuffle.partitions"
_STORE = "spark.sql.streaming.stateStore.providerClass"
# Spark's own state stores by name.
_STORES = {
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def start_stream(
    df: DataFrame,
    fmt: str | None,
    options: dict[str, str],
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    mode: str = "append",
    name: str | None = None,
    batch_sink: BatchSink | None = None,
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start writing a stream to a format, or to ``batch_sink`` once per micro-batch.

    ``trigger`` is passed on, for example ``{"processingTime": "2 minutes"}`` or
    ``{"availableNow": True}``. Offsets and state live in ``checkpoint`` (shared storage).
    ``state_partitions`` applies to a new checkpoint and stays with it; it defaults to the session's
    shuffle partitions. ``state_store`` is ``hdfs`` or ``rocksdb``; state larger than memory, and operators with
    timers and several states, need the latter.
    """
    conf = df.sparkSession.conf
    new = {_PARTITIONS: state_partitions and str(state_partitions), _STORE: state_store and _STORES[state_store]}
    before = {key: conf.get(key) for key, value in new.items() if value}
    for key in before:
        conf.set(key, new[key])
    try:
        return _start(df, fmt, options, checkpoint, trigger, mode, name, batch_sink)
    finally:
        # The query has its own copy of the settings by now.
        for key, value in before.items():
            conf.set(key, value)


def _start(
    df: DataFrame,
    fmt: str | None,
    options: dict[str, str],
    checkpoint: str,
    trigger: dict[str, object] | None,
    mode: str,
    name: str | None,
    batch_sink: BatchSink | None,
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    if batch_sink is not None:
        return writer.foreachBatch(batch_sink).start()
    return writer.format(fmt).start()


def run_for(query: StreamingQuery, seconds: float, poll: float = 300.0) -> None:
    """Log progress every ``poll`` seconds and stop the query after ``seconds``; its errors are raised."""
    end = time.monotonic() + seconds
    while query.isActive:
        left = end - time.monotonic()
        if left <= 0:
            query.stop()
            return
        query.awaitTermination(min(poll, left))
        log.info("status %s, progress %s", query.status, query.lastProgress)
    if query.exception() is not None:
        raise query.exception()


def file_sink(path: str, fmt: str = "parquet") -> BatchSink:
    """Files in one folder per micro-batch; a repeated batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return write


def table_sink(name: str, fmt: str | None = None, options: dict[str, str] | None = None) -> BatchSink:
    """Append to a table or through a warehouse connector: at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_table(batch, name, fmt, options)

    return write


def topic_sink(fmt: str, options: dict[str, str], key: str | None = None) -> BatchSink:
    """Rows as binary JSON messages to a topic: at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_topic(to_message(batch, key), fmt, options)

    return write


def unless_done(sink: BatchSink, done: str) -> BatchSink:
    """``sink``, left out for batches it has already finished, which are noted in the folder ``done``.

    Lets sinks that only append share a fan-out: when a later sink fails and the batch is repeated,
    those before it do not write it again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = f"{done}/batch_id={batch_id}"
        try:
            spark.read.schema("batch_id long").parquet(note)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            return
        sink(batch, batch_id)
        spark.range(batch_id, batch_id + 1, 1, 1).toDF("batch").write.mode("overwrite").parquet(note)

    return write


def fan_out(sinks: Sequence[BatchSink]) -> BatchSink:
    """One micro-batch function for several sinks; the batch is computed once for all of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write
