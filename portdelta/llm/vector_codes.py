"""Vector codes by Lloyd's rounds that only look at what moved (operator 13).

Components become integers, so all distances are exact. A vector is cut into parts, and each part position
has its own codebook. Every row keeps, next to its integers, the entry and the exact distance of each part.
When the codebooks change, a part whose entry stayed where it was has a valid distance: no unmoved entry can
beat it, so it is compared with the moved entries only. A part whose entry moved is compared with all. Of equal
distances the lower index wins in both ways.

The rows are written once a round and the round before is deleted, so the shared folder holds two copies at
most. What reaches the driver are the first rows that seed the codebooks and the sums of a round: entries times
dimension numbers, added on the executors first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portdelta.llm.staging import drop_at_exit, kept_at, remove
from portdelta.operators.joins import attach
from portdelta.ship import by_value

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
_ROWS = 1024  # rows of one distance table
_EXACT = 2**53  # whole numbers below this are exact as doubles

Books = list[np.ndarray]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as 64-bit values, or as decimal text where these are Python integers."""
    if values.dtype == object:
        return ",".join(map(str, values.reshape(-1))).encode()
    return values.astype("<i8").tobytes()


def unpacked(data: bytes, wide: bool) -> np.ndarray:
    if wide:
        return np.array([int(v) for v in data.decode().split(",")] if data else [], dtype=object)
    return np.frombuffer(data, "<i8")


def _integers(scale: int):
    """Rows whose vectors are whole and finite, as integers: 32 bits each, or text if one is larger."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dims, wide, most, out = [], [], [], [], []
            for i, v in enumerate(batch.column("v")):
                if not v.is_valid or v.values.null_count:
                    continue
                x = np.asarray(v.values, dtype=np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(x * scale)
                if not np.isfinite(x).all():  # finite times scale may pass the largest double
                    x = np.array([int(a) * scale for a in v.values.to_pylist()], dtype=object)
                top = max(abs(int(x.max())), abs(int(x.min()))) if len(x) else 0
                large = top >= 2**31
                keep.append(i)
                dims.append(len(x))
                wide.append(large)
                most.append(float(min(top, 2**40)))
                out.append(packed(np.array([int(a) for a in x], dtype=object)) if large else x.astype("<i4").tobytes())
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), pa.array(dims, pa.int32()), pa.array(wide, pa.bool_()), pa.array(most, pa.float64()), pa.array(out, pa.binary())],
                names=["vec_id", "label", "dim", "wide", "most", "v"],
            )

    return run


def _matrix(values: list[bytes], wide: list[bool], dim: int, exact: bool) -> np.ndarray:
    """Integer rows: doubles that hold them exactly, else Python integers."""
    if exact:
        return np.frombuffer(b"".join(values), "<i4").reshape(len(values), dim).astype(np.float64)
    rows = [unpacked(v, True) if w else np.frombuffer(v, "<i4").astype(object) for v, w in zip(values, wide)]
    return np.array([[int(a) for a in r] for r in rows], dtype=object).reshape(len(values), dim)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries; exact, as all values are whole."""
    if x.dtype == object:
        return np.array([[((a - e) ** 2).sum() for e in entries] for a in x], dtype=object).reshape(len(x), len(entries))
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None, :]


def _lowest(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.argmin(d, axis=1)  # the first of equal ones
    return at, d[np.arange(len(d)), at]


def reassigned(x: np.ndarray, book: np.ndarray, entry: np.ndarray, dist: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries after those in ``moved`` have changed, from the entries and distances before."""
    entry, dist = entry.copy(), dist.copy()
    active = np.flatnonzero(moved)
    lost = moved[entry]
    again = np.flatnonzero(lost)
    if len(again):
        entry[again], dist[again] = _lowest(distances(x[again], book))
    fixed = np.flatnonzero(~lost)
    if len(fixed) and len(active):
        at, d = _lowest(distances(x[fixed], book[active]))
        at = active[at]
        better = (d < dist[fixed]) | ((d == dist[fixed]) & (at < entry[fixed]))
        entry[fixed[better]], dist[fixed[better]] = at[better], d[better]
    return entry, dist


def _cuts(dim: int, parts: int) -> list[slice]:
    edges = np.cumsum([0, *(len(p) for p in np.array_split(np.arange(dim), parts))])
    return [slice(int(a), int(b)) for a, b in zip(edges, edges[1:])]


_STATE = "dim int, wide boolean, v binary, entry binary, dist binary"


def _assigned(books: Books, moved: list[np.ndarray] | None, dim: int, exact: bool):
    """Rows with the nearest entries; ``moved`` tells which entries changed since the stored ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = _cuts(dim, len(books))
        used = [b.astype(np.float64) if exact else b for b in books]
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                x = _matrix(batch.column("v").to_pylist(), batch.column("wide").to_pylist(), dim, exact)
                n = len(x)
                if moved is not None:
                    old = np.frombuffer(b"".join(batch.column("entry").to_pylist()), "<u2").reshape(n, len(books))
                    known = np.array([unpacked(d, not exact) for d in batch.column("dist").to_pylist()]).reshape(n, len(books))
                entries, dists = [], []
                for p, cut in enumerate(cuts):
                    if moved is None:
                        e, d = _lowest(distances(x[:, cut], used[p]))
                    else:
                        before = known[:, p].astype(np.float64) if exact else known[:, p]
                        e, d = reassigned(x[:, cut], used[p], old[:, p].astype(np.int64), before, moved[p])
                    entries.append(e)
                    dists.append(d)
                entry, dist = np.stack(entries, axis=1).astype("<u2"), np.stack(dists, axis=1)
                dist = dist.astype("<i8") if exact else dist
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("vec_id", "label", "dim", "wide", "v")),
                        pa.array([e.tobytes() for e in entry], pa.binary()),
                        pa.array([packed(d) for d in dist], pa.binary()),
                    ],
                    names=["vec_id", "label", "dim", "wide", "v", "entry", "dist"],
                )

    return run


def _sums_of(parts: int, size: int, dim: int, exact: bool):
    """One row per part and task: sums of each entry's parts, with their count behind."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = _cuts(dim, parts)
        kind = np.int64 if exact else object
        total = [np.zeros((size, c.stop - c.start + 1), dtype=kind) for c in cuts]
        for batch in batches:
            x = _matrix(batch.column("v").to_pylist(), batch.column("wide").to_pylist(), dim, exact).astype(kind)
            entry = np.frombuffer(b"".join(batch.column("entry").to_pylist()), "<u2").reshape(len(x), parts)
            for p, cut in enumerate(cuts):
                np.add.at(total[p], entry[:, p], np.concatenate([x[:, cut], np.ones((len(x), 1), kind)], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([packed(t) for t in total], pa.binary())], names=["part", "sums"])

    return run


def _added(exact: bool):
    def add(rows: pa.Table) -> pa.Table:
        total = None
        for value in rows.column("sums"):
            one = unpacked(value.as_py(), not exact)
            total = one.copy() if total is None else total + one
        return pa.table({"part": rows.column("part")[:1].cast(pa.int32()), "sums": pa.array([packed(total)], pa.binary())})

    return add


def _next_books(state: DataFrame, books: Books, dim: int, exact: bool) -> Books:
    """Each entry replaced by the mean of its parts, rounded down; unused entries stay."""
    schema, add = "part int, sums binary", _added(exact)
    size = len(books[0])
    per_task = state.select("v", "wide", "entry").mapInArrow(_sums_of(len(books), size, dim, exact), schema)
    salted = per_task.withColumn("salt", F.spark_partition_id() % 16)
    first = salted.groupBy("part", "salt").applyInArrow(lambda t: add(t.drop_columns(["salt"])), schema)
    sums = {r["part"]: r["sums"] for r in first.groupBy("part").applyInArrow(add, schema).collect()}
    out = []
    for p, book in enumerate(books):
        total = unpacked(sums[p], not exact).reshape(size, book.shape[1] + 1) if p in sums else np.zeros((size, book.shape[1] + 1), book.dtype)
        used = np.flatnonzero(total[:, -1] > 0)
        new = book.copy()
        new[used] = total[used, :-1] // total[used, -1:]
        out.append(new)
    return out


def books_digest(books: Books) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.reshape(-1)).encode()).hexdigest()


def _coded(exact: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors = [int(unpacked(d, not exact).sum()) for d in batch.column("dist").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array(["".join(f"{e:02x}" for e in np.frombuffer(v, "<u2")) for v in batch.column("entry").to_pylist()], pa.string()),
                    pa.array([e if e < 2**63 else None for e in errors], pa.int64()),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Books]:
    """``vec_id, label, code, error`` for every usable row, and the codebooks, one array per part.

    Vectors that are null or hold null, NaN or infinite components take no part, nor do empty ones and those of
    another length than the first (by id, null ids last, then by content); a length that ``parts`` does not
    divide is cut as evenly as can be. The first ``entries`` rows seed the codebooks; with fewer rows there are
    fewer entries. Repeated ids or rows are rows of their own; of equal distances the lower entry wins. Numbers
    of any size are exact; an ``error`` beyond 64 bits is null. Other columns are ignored, so they may have any
    name. An empty table gives no rows and empty codebooks. ``entries`` is 256 at most, as a code has two hex
    digits for each.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    label = rows.schema["label"].dataType.simpleString()
    base, path = kept_at(rows.mapInArrow(_integers(scale), f"vec_id long, label {label}, dim int, wide boolean, most double, v binary"), "vectors")
    order = [F.asc_nulls_last("vec_id"), F.col("v")]
    first = base.where("dim > 0").orderBy(*order).limit(1).collect()
    if not first:
        drop_at_exit(spark, path)
        return base.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).where("false"), [np.zeros((0, 0), np.int64)] * parts
    dim = first[0]["dim"]
    base = base.where(F.col("dim") == dim)
    top = base.agg(F.max("most")).first()[0]
    exact = -(-dim // parts) * (2 * top + 2) ** 2 < _EXACT and top < 2**31
    seeds = base.orderBy(*order).limit(entries).collect()
    x = _matrix([bytes(s["v"]) for s in seeds], [s["wide"] for s in seeds], dim, exact)
    x = x.astype(np.int64) if exact else x
    books = [x[:, cut].copy() for cut in _cuts(dim, parts)]
    schema = f"vec_id long, label {label}, {_STATE}"
    state, moved = base, None
    for turn in range(rounds + 1):
        state, new_path = kept_at(state.mapInArrow(_assigned(books, moved, dim, exact), schema), "codes")
        remove(spark, path)
        path = new_path
        if turn < rounds:
            new = _next_books(state, books, dim, exact)
            moved = [(a != b).any(axis=1) for a, b in zip(books, new)]
            books = new
    drop_at_exit(spark, path)
    return state.select("vec_id", "label", "entry", "dist").mapInArrow(_coded(exact), f"vec_id long, label {label}, code string, error long"), books


def code_report(vectors: DataFrame, **names) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: see ``compress_vectors``.

    ``label_error`` adds the errors of all rows with the same label, null being one; beyond 64 bits it is null.
    """
    coded, books = compress_vectors(vectors, **names)
    per_label = coded.groupBy("label").agg(F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error")).alias("label_error"))
    return attach(coded, per_label, ["label"]).select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


by_value(__name__)
