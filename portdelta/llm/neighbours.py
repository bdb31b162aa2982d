"""Approximate nearest neighbours by a permutation index (operator 6).

A vector is represented by the pivots nearest to it, in order. The index is cut in shards of bounded size.
In a shard, every vector is posted, with its rank, in the inverted file of each pivot of its order. A query
visits the files of its own nearest pivots, which adds up the footrule distance between its order and those
of all vectors it meets; the nearest by footrule are reranked by the inner product of the original vectors.

The largest inner product is a nearest neighbour once every vector gets one more component that makes all
lengths equal (that of queries is 0), so pivots are compared with in that space.

Shards are dealt by a hash of id and vector, so neither a pivot near which most vectors lie nor an id that
repeats is a large group. A shard gives the best score of each id, before it cuts to the best ``k``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portdelta.llm.staging import staged
from portdelta.ship import by_value

_INDEX = "id long, v array<double>, q boolean, pivots binary, asked binary"
_FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Vectors that take part: no null or non-finite component, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_pivots(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the ``length`` nearest pivots of each row, nearest first."""
    product = x @ pivots[:, :-1].T + np.outer(lift, pivots[:, -1])
    return np.argsort(-product, axis=1, kind="stable")[:, :length].astype("<u2")


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _indexed(sent, radius: float, length: int, visited: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), pivots.shape[1] - 1)
            lift = np.sqrt(np.maximum(radius**2 - (x * x).sum(axis=1), 0))
            near = nearest_pivots(x, lift, pivots, length)
            asked = nearest_pivots(x, np.zeros(len(x)), pivots, visited)
            orders = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (near, asked)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), batch.column("q"), *orders], names=["id", "v", "q", "pivots", "asked"])

    return run


class Files:
    """Inverted files of one shard: by pivot, the rows posted there and their ranks."""

    def __init__(self, near: np.ndarray, n_pivots: int) -> None:
        self.length = near.shape[1]
        rows, ranks = np.divmod(np.arange(near.size), self.length)
        order = np.argsort(near.reshape(-1), kind="stable")
        self.rows, self.ranks = rows[order], ranks[order]
        self.first = np.searchsorted(near.reshape(-1)[order], np.arange(n_pivots + 1))
        self.n = len(near)

    def footrule(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that share a pivot with the query's order, and their footrule distances.

        A pivot that only one of two orders has counts with the rank just beyond the other's end.
        """
        size = self.length
        apart = sum(size - j for j in range(len(query))) + size * (size + 1) // 2
        total = np.full(self.n, apart)
        for j, p in enumerate(query):
            at = slice(self.first[p], self.first[p + 1])
            r = self.ranks[at]
            total[self.rows[at]] += np.abs(r - j) - (size - j) - (size - r)
        met = np.flatnonzero(total < apart)
        return met, total[met]


def _nearest_ids(ids: np.ndarray, far: np.ndarray, k: int, share: float) -> np.ndarray:
    """All rows of the ``share`` of the ids (more than ``k``) that come nearest with one of their rows."""
    order = np.argsort(far, kind="stable")
    known, first = np.unique(ids[order], return_index=True)
    most = max(k + 1, int(np.ceil(share * len(known))))
    return np.flatnonzero(np.isin(ids, known[np.argsort(first)[:most]]))


def _searched(n_pivots: int, dim: int, k: int, share: float | None):
    """Answers of a group's queries among its shard; all of it is compared if ``share`` is None."""

    def search(queries: pa.Table, shard: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if queries.num_rows and shard.num_rows:
            x, ids = _matrix(shard.column("v"), dim), shard.column("id").to_numpy()
            repeated = len(np.unique(ids)) < len(ids)
            asked, qids = _matrix(queries.column("v"), dim), queries.column("id").to_pylist()
            if share is not None:
                files = Files(np.stack([np.frombuffer(v, "<u2") for v in shard.column("pivots").to_pylist()]), n_pivots)
                orders = [np.frombuffer(v, "<u2") for v in queries.column("asked").to_pylist()]
            for i, qid in enumerate(qids):
                if share is None:
                    some = np.arange(len(x))
                else:
                    some, far = files.footrule(orders[i])
                    if repeated:
                        some = some[_nearest_ids(ids[some], far, k, share)]
                    else:
                        most = max(k + 1, int(np.ceil(share * len(some))))
                        if len(some) > most:
                            some = some[np.argpartition(far, most - 1)[:most]]
                some = some[ids[some] != qid]
                score = (x[some] * asked[i]).sum(axis=1)
                best = np.lexsort((ids[some], -score))
                if repeated:
                    best = best[np.sort(np.unique(ids[some][best], return_index=True)[1])]
                best = best[:k]
                out[0].extend([qid] * len(best))
                out[1].extend(ids[some][best].tolist())
                out[2].extend(score[best].tolist())
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return search


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query with their rank; ties go to the smaller id."""
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    n_pivots: int = 256,
    length: int = 32,
    visited: int = 32,
    share: float = 0.5,
    shard_rows: int = 8192,
    query_rows: int = 2048,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest inner products, found by the index.

    ``vectors (vec_id, embedding, ...)``; queries are the rows where ``is_query`` holds, candidates all
    rows but the query's own. Every usable row is indexed; only the ``n_pivots`` pivots are a sample, the
    first rows by a hash of the id. Orders hold ``length`` pivots and a query visits the files of
    ``visited``; ``share`` of the rows that it meets in a shard of about ``shard_rows`` rows, the nearest
    by footrule, are compared exactly, in double precision. A query that found fewer than ``k`` is compared
    with all rows, shard by shard, so it gets all candidates if there are fewer.

    Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows
    without id or of another length than most pivots have. An id that repeats counts once, with its best
    score. Ties go to the smaller id. Other columns are ignored. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    sample = rows.orderBy(F.xxhash64("id", F.lit(6)), "id").limit(n_pivots).select("v").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = [len(r["v"]) for r in sample]
    dim = max(set(sizes), key=lambda s: (sizes.count(s), s))
    rows = rows.where(F.size("v") == dim)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    about = rows.agg(F.max(norm).alias("norm"), F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("q"), 1)).alias("asked")).first()
    radius = float(about["norm"] ** 0.5)
    base = np.array([r["v"] for r in sample if len(r["v"]) == dim])
    lift = np.sqrt(np.maximum(radius**2 - (base * base).sum(axis=1), 0))
    sent = spark.sparkContext.broadcast(np.column_stack([base, lift]))
    length, visited = min(length, len(base)), min(visited, len(base))
    # Copies of a row are one row.
    rows = rows.groupBy("id", "v").agg(F.max("q").alias("q")).select("id", "v", "q")
    index = staged(rows.mapInArrow(_indexed(sent, radius, length, visited), _INDEX), "index")
    shards, groups = -(-about["n"] // shard_rows), max(1, -(-about["asked"] // query_rows))
    found = staged(_meet(index, index.where("q"), shards, groups, _searched(len(base), dim, k, share)), "found")
    own = index.where("q").select(F.col("id").alias("query_id")).distinct()
    few = own.join(found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")), "query_id", "left").where(f"n IS NULL OR n < {k}")
    lacking = staged(index.where("q").join(few.select(F.col("query_id").alias("id")), "id", "left_semi"), "lacking")
    if lacking.take(1):
        found = found.union(_meet(index, lacking, shards, groups, _searched(len(base), dim, k, None)))
    return _top(found, k)


def _meet(index: DataFrame, asked: DataFrame, shards: int, groups: int, search) -> DataFrame:
    """Each group of queries meets each shard in a group of its own."""
    shard = F.pmod(F.xxhash64("id", "v", F.lit(7)), F.lit(shards)).cast("int")
    group = F.pmod(F.xxhash64("id", F.lit(8)), F.lit(groups)).cast("int")
    every = index.select("id", "v", "pivots", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    queries = asked.select("id", "v", "asked", group.alias("group"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    return queries.groupBy("group", "shard").cogroup(every.groupBy("group", "shard")).applyInArrow(search, _FOUND)


by_value(__name__)
