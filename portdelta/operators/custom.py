"""Escape hatches for logic that built-in expressions cannot state; data moves in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from portdelta.ship import by_value

by_value(__name__)


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """Each row to any number of rows, a batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def combine_per_key(
    df: DataFrame,
    keys: Sequence[str],
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    merge: dict[str, Column],
) -> DataFrame:
    """A custom combiner: ``partial`` reduces each batch to one row per key, ``merge`` joins those rows.

    No task ever holds all rows of a key, however large the key is.
    """
    return flat_map(df, partial, schema).groupBy(*keys).agg(*[c.alias(name) for name, c in merge.items()])
