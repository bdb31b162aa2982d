"""Counts of a job taken while it writes: no query of their own, no polling."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent

from portdelta.operators.joins import not_published

_ROWS = "rows"


def counted(df: DataFrame, name: str | Observation) -> DataFrame:
    """``df``, whose rows are counted under ``name`` while they pass; on a stream, per micro-batch."""
    return df.observe(name, F.count(F.lit(1)).alias(_ROWS))


def publish_counted(
    inputs: DataFrame,
    join: Callable[[DataFrame], DataFrame],
    sent: DataFrame,
    keys: Sequence[str],
    write: Callable[[DataFrame], None],
) -> dict[str, int]:
    """Join ``inputs``, hand the rows whose key is not in ``sent`` to ``write``, and tell how many there were.

    ``write`` runs exactly one action. The counts come with it: rows read, joined, published, and published
    before; each table is read once.
    """
    seen = {name: Observation(name) for name in ("input", "joined", "published")}
    joined = counted(join(counted(inputs, seen["input"])), seen["joined"])
    write(counted(not_published(joined, sent, keys), seen["published"]))
    rows = {f"{name}_rows": seen[name].get[_ROWS] for name in seen}
    return rows | {"already_published_rows": rows["joined_rows"] - rows["published_rows"]}


class BatchCounts(StreamingQueryListener):
    """Collects what ``counted`` streams observed: ``rows[query name][batch id][name]``.

    ``on_batch`` is called with each batch's counts as Spark reports them, in place of a polling loop.
    """

    def __init__(self, on_batch: Callable[[str, int, dict[str, int]], None] | None = None) -> None:
        self.rows: dict[str, dict[int, dict[str, int]]] = {}
        self.ended: dict[str, str | None] = {}
        self._on_batch = on_batch

    def __enter__(self) -> BatchCounts:
        SparkSession.active().streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        SparkSession.active().streams.removeListener(self)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self.rows.setdefault(event.name or str(event.id), {})

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        # A batch without data that only moves the watermark observes nothing.
        counts = {name: int(row[_ROWS]) for name, row in progress.observedMetrics.items()}
        if counts:
            name = progress.name or str(progress.id)
            self.rows.setdefault(name, {})[progress.batchId] = counts
            if self._on_batch:
                self._on_batch(name, progress.batchId, counts)

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self.ended[str(event.id)] = event.exception
