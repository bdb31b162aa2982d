from portdelta.streaming.counts import BatchCounts, counted, publish_counted
from portdelta.streaming.publish import publish_once, publish_once_stream
from portdelta.streaming.run import fan_out, file_sink, run_for, start_stream, table_sink, topic_sink, unless_done

__all__ = [
    "BatchCounts",
    "counted",
    "fan_out",
    "file_sink",
    "publish_counted",
    "publish_once",
    "publish_once_stream",
    "run_for",
    "start_stream",
    "table_sink",
    "topic_sink",
    "unless_done",
]
