"""Every operator as a query over the given tables, with its SQL twin."""

from portdelta.catalog import columns, deltas, files, joins, parsing, windows  # noqa: F401
from portdelta.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
