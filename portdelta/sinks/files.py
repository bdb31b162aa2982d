"""File sinks. The number of files follows the partitions; nothing is forced into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame

from portdelta.sinks.topics import rows_to_json_value


def write_files(
    df: DataFrame,
    path: str,
    fmt: str,
    mode: str = "append",
    header: bool = True,
    partition_by: list[str] | None = None,
) -> None:
    """Write ``df`` as files; ``header`` applies to CSV."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Each row as one JSON text line."""
    rows_to_json_value(df).write.mode(mode).text(path)
