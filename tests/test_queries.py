"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import pytest
from oracle import connect, difference

import __spark_entry__ as entry
from portdelta.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"
# Windows of five samples do not occur in the smallest tables.
MAY_BE_EMPTY = {"nth_in_window", "delta_complete_window", "stream_complete_window"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = difference(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name])
    assert found is None or (found == "no rows" and name in MAY_BE_EMPTY), found


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_has_the_published_columns(spark):
    from portdelta.model import OUTPUT_COLUMNS

    df = entry.entry(spark)
    assert df.columns == OUTPUT_COLUMNS
    assert df.count() > 0
