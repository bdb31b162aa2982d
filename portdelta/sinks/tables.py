"""Table sinks. Tables may live at an explicit path in shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def append_table(df: DataFrame, name: str, fmt: str | None = None, options: dict[str, str] | None = None) -> None:
    """Append to a table, created if missing.

    With an external ``fmt`` (a warehouse connector) the table name travels in ``options``.
    """
    options = options or {}
    if fmt and not name:
        df.write.format(fmt).options(**options).mode("append").save()
        return
    df.write.format(fmt or "parquet").options(**options).mode("append").saveAsTable(name)


def write_new_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Write a query result to a table that must not exist yet."""
    writer = df.write.mode("errorifexists").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> bool:
    """Create an empty table with ``schema`` if there is none; tells whether it was created."""
    if spark.catalog.tableExists(name):
        return False
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return True


def insert_select(df: DataFrame, name: str) -> None:
    """``INSERT INTO name SELECT ...``; columns are matched by name, not by position."""
    target = df.sparkSession.table(name).columns
    df.select(*target).write.mode("append").insertInto(name)


def stage_and_append(df: DataFrame, stage: str, dest: str, stage_path: str | None = None) -> None:
    """Compute once into ``stage``, copy to ``dest`` and drop ``stage``.

    The expensive query is done before ``dest`` is touched, so a failing query leaves it as it was.
    """
    spark = df.sparkSession
    write_new_table(df, stage, stage_path)
    try:
        spark.table(stage).write.mode("append").insertInto(dest)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
