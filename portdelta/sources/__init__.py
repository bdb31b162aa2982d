from portdelta.sources.files import (
    parse_csv_message,
    read_envelopes,
    read_json_inferred,
    read_lines,
    read_properties,
    read_table,
)
from portdelta.sources.topics import kafka_options, pulsar_options, read_topic

__all__ = [
    "kafka_options",
    "parse_csv_message",
    "pulsar_options",
    "read_envelopes",
    "read_json_inferred",
    "read_lines",
    "read_properties",
    "read_table",
    "read_topic",
]
