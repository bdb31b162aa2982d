"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from portdelta.functions.columns import bulk_cast, has_counter
from portdelta.functions.time import ts_from_ms_minute
from portdelta.model import DELTA_COUNTERS, ENVELOPE, GAUGES, POLL_ENVELOPE, SYSTEM_ENVELOPE
from portdelta.operators.deltas import POLL_RECORD, delta_lag, delta_output, delta_window, poll_delta
from portdelta.operators.flatten import explode_elements, explode_system, flatten_all
from portdelta.operators.joins import join_status_minute, request_enrich
from portdelta.operators.parse import parse_value, split_record_kinds
from portdelta.operators.route import checked_messages
from portdelta.operators.slices import SLICE_SECONDS
from portdelta.session import fresh_path
from portdelta.sinks.files import write_files, write_json_lines
from portdelta.sinks.topics import to_message, to_psv
from portdelta.sources.files import read_envelopes
from portdelta.streaming.run import BatchSink, start_stream

# The counters whose deltas the job reports.
_LAG_COUNTERS = ["in_octets", "in_pkts", "out_octets", "out_pkts"]
# All compared counters, so that samples of one time have one order.
_ORDER = ["timestamp", *_LAG_COUNTERS]


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and not again after a loss."""
    spark = df.sparkSession
    path = fresh_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


def batch_delta_job(
    spark: SparkSession,
    source: str,
    interface_csv: str,
    subinterface_csv: str,
    interface_out: str,
    subinterface_out: str,
    slice_seconds: int = SLICE_SECONDS,
) -> None:
    """JSON messages to flat CSV rows and to previous-sample deltas with status, as JSON.

    The messages are parsed once into a columnar copy, of which every branch reads only its columns;
    the joined rows are stored as well, as the delta reads them twice. ``slice_seconds`` is the length of
    time of a key that one task orders at once.
    """
    kinds = split_record_kinds(_stored(read_envelopes(spark, source)))
    counters, subs = kinds["interface_counters"], kinds["subinterface_counters"]
    write_files(counters, interface_csv, "csv")
    write_files(subs, subinterface_csv, "csv")

    keys = ["devicename", "interface"]
    joined = _stored(join_status_minute(counters, kinds["interface_status"], keys))
    out = delta_lag(joined, keys, _LAG_COUNTERS, _ORDER, seconds=slice_seconds)
    write_files(out, interface_out, "json")

    keys = ["devicename", "interface", "subinterface"]
    joined = _stored(join_status_minute(subs, kinds["subinterface_status"], keys))
    out = delta_lag(
        joined, keys, _LAG_COUNTERS, _ORDER, time_name="delta_time", seconds=slice_seconds
    )
    write_files(out, subinterface_out, "json")


def window_delta_rows(
    messages: DataFrame,
    size: str = "301 seconds",
    slide: str = "5 minutes",
    watermark: str | None = "6 minutes",
) -> DataFrame:
    """``system`` messages (column ``value``) to published delta records; batch or stream."""
    flat = explode_system(parse_value(messages, SYSTEM_ENVELOPE))
    typed = bulk_cast(flat, "bigint", ["devicename", "interface"])
    timed = has_counter(typed, "in_octets").withColumn("formatted_timestamp", ts_from_ms_minute("timestamp"))
    cols = [*DELTA_COUNTERS, *GAUGES, "timestamp"]
    deltas = delta_window(
        timed, ["devicename", "interface"], cols, "formatted_timestamp", size, slide, watermark, cut_minutes=False
    )
    return delta_output(deltas)


def window_delta_stream(
    messages: DataFrame, sink: BatchSink, checkpoint: str, trigger: dict[str, object] | None = None
) -> StreamingQuery:
    """Topic to published deltas, every two minutes unless told otherwise."""
    return start_stream(
        window_delta_rows(messages),
        None,
        {},
        checkpoint,
        trigger or {"processingTime": "2 minutes"},
        name="interface_deltas",
        batch_sink=sink,
    )


def flatten_lines_job(lines: DataFrame, out: str, rejected: str | None = None) -> None:
    """Messages to flat JSON lines; unusable messages go to ``rejected`` with a reason. They are parsed once."""
    checked = _stored(checked_messages(lines))
    write_json_lines(flatten_all(checked.where("reject_reason IS NULL").drop("value", "reject_reason")), out)
    if rejected:
        write_files(checked.where("reject_reason IS NOT NULL").select("value", "reject_reason"), rejected, "json")


def poll_rows(messages: DataFrame, dataset: str | None = None) -> DataFrame:
    """Poll messages (``value`` plus columns such as ``src``) to separated records in ``value``."""
    keep = tuple(c for c in messages.columns if c != "value")
    rows = explode_elements(parse_value(messages, POLL_ENVELOPE, keep=keep))
    return to_psv(poll_delta(rows, dataset), POLL_RECORD)


def poll_stream(
    messages: DataFrame,
    fmt: str,
    options: dict[str, str],
    checkpoint: str,
    dataset: str | None = None,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Poll topic to a topic of separated records."""
    out = poll_rows(messages, dataset).select("value")
    return start_stream(out, fmt, options, checkpoint, trigger)


def request_stream(
    requests: DataFrame,
    lookup: DataFrame,
    thresholds: DataFrame,
    key: str,
    threshold_key: str,
    rule: Column,
    sink: BatchSink,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Request topic to response messages, every ten seconds unless told otherwise."""
    answers = request_enrich(requests, lookup, thresholds, key, threshold_key, rule)
    return start_stream(
        to_message(answers),
        None,
        {},
        checkpoint,
        trigger or {"processingTime": "10 seconds"},
        name="requests",
        batch_sink=sink,
    )

