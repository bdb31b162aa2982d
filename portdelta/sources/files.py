"""File and table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portdelta.model import ENVELOPE


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType = ENVELOPE) -> DataFrame:
    """JSON lines below ``path``, read once; the merged schema covers every record kind."""
    return spark.read.schema(schema).json(path)


def read_json_inferred(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """JSON with an inferred schema. Multi-line files are not splittable: one file is one task."""
    return spark.read.option("multiLine", multiline).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one message per line, as column ``value``."""
    return spark.read.text(path)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or files of ``fmt`` when the argument is a path."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_properties(spark: SparkSession, path: str) -> DataFrame:
    """``key=value`` lines as a two-column table; later ``=`` belong to the value."""
    parts = F.split("value", "=", 2)
    return (
        spark.read.text(path)
        .where(F.col("value").contains("="))
        .select(F.trim(parts[0]).alias("key"), F.trim(parts[1]).alias("value"))
    )


def parse_csv_message(df: DataFrame, names: list[str], sep: str = ",", column: str = "value") -> DataFrame:
    """Bytes or text with separated fields to one text column per name; absent fields are NULL."""
    parts = F.split(F.col(column).cast("string"), f"\\Q{sep}\\E")
    return df.select(*[F.get(parts, i).alias(name) for i, name in enumerate(names)])
