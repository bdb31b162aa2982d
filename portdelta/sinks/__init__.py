from portdelta.sinks.files import write_files, write_json_lines
from portdelta.sinks.tables import append_table, ensure_table, insert_select, stage_and_append, write_new_table
from portdelta.sinks.topics import rows_to_json_value, to_message, to_psv, write_topic

__all__ = [
    "append_table",
    "ensure_table",
    "insert_select",
    "rows_to_json_value",
    "stage_and_append",
    "to_message",
    "to_psv",
    "write_files",
    "write_json_lines",
    "write_new_table",
    "write_topic",
]
