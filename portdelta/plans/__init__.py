from portdelta.plans.incremental import run_incremental
from portdelta.plans.jobs import (
    batch_delta_job,
    flatten_lines_job,
    poll_stream,
    poll_rows,
    request_stream,
    window_delta_rows,
    window_delta_stream,
)

__all__ = [
    "batch_delta_job",
    "flatten_lines_job",
    "poll_rows",
    "poll_stream",
    "request_stream",
    "run_incremental",
    "window_delta_rows",
    "window_delta_stream",
]
