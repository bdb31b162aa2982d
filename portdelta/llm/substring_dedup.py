"""Repeated passages by content-defined chunking (operator 1).

A gear hash rolls over a text's bytes; a chunk ends where five of its bits are zero. That depends on the
last 21 bytes only, so text put in before a passage moves no chunk inside it. A stretch without such an end,
as one that repeats a short string, is cut where the smallest hash for a while stands. Chunks of twelve bytes or more
go by their digest to the first document that has them. Chunks that a document shares with the same other
one at the same distance are one alignment; along it both texts are compared and equal stretches of enough
words are repeats of the earlier document. Beside a chunk stand hashes of the words before and behind it: where
both differ, no equal stretch around it can be long enough, and the texts are not brought together for it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portdelta.llm.staging import key_bitmap, small_batches, staged
from portdelta.llm.text import _power_tables, buffers, mixed, runs, slices
from portdelta.ship import by_value

_GEAR = np.random.Generator(np.random.PCG64(1)).integers(0, 2**32, 256, dtype=np.uint32)
#: Bits 16 to 20 of the hash; bit k has met the last k + 1 bytes.
_MASK = np.uint32(0x1F0000)
_LEAST_CHUNK, _LONG, _INNER = 12, 256, 48
_ID_BITS = 20
_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
_SPANS = "doc_id long, start long, end long, n_words long, first_doc_id long, first_start long"


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the sum of the last 32 bytes' numbers, each shifted by its age.

    Built by doubling: what 2 ** k bytes give, and what the 2 ** k bytes before them give, shifted.
    """
    h = _GEAR[data]
    age = 1
    while age < 32:
        before = h[:-age] << np.uint32(age)
        h[age:] += before
        age *= 2
    return h


def _inner_cuts(h: np.ndarray, start: int, end: int) -> list[int]:
    """Cuts of a stretch without a chunk end, ``_INNER`` bytes apart or more: where the hash is the smallest
    of the last 64.

    Where one short string repeats, that is once a turn, whatever came before.
    """
    low = h[start:end].copy()
    back = 1
    while back < 64:
        low[back:] = np.minimum(low[back:], low[:-back])
        back *= 2
    out, last = [], start
    for at in np.flatnonzero(h[start:end] == low) + start + 1:
        if at - last >= _INNER and at - start >= 96:
            out.append(int(at))
            last = at
    return out


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of the bytes' numbers up to each byte, each times the power of its place."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power_tables(len(data) + 1).up[: len(data)], dtype=np.uint64, out=sums[1:])
    return sums


def chunks(data: np.ndarray, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digest, first byte and end of the chunks of one text; short chunks are left out.

    Of equal chunks inside one long stretch only the first is given. ``sums`` are the text's ``_prefix_sums``.
    """
    sums = _prefix_sums(data) if sums is None else sums
    h = gear(data)
    at = np.flatnonzero(np.concatenate([[True], (h[:-1] & _MASK) == 0, [True]])) if len(data) else np.zeros(1, int)
    start, end = at[:-1], at[1:]
    powers = _power_tables(len(data) + 1)

    def digests(first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((sums[stop] - sums[first]) * powers.down[first] + (stop - first).astype(np.uint64))

    fits = (end - start >= _LEAST_CHUNK) & (end - start <= _LONG)
    found = [(digests(start[fits], end[fits]), start[fits], end[fits])]
    for s, e in zip(start[end - start > _LONG], end[end - start > _LONG]):
        edges = np.array([s, *_inner_cuts(h, int(s), int(e)), e])
        d = digests(edges[:-1], edges[1:])
        once = np.unique(d, return_index=True)[1]
        found.append((d[once], edges[:-1][once], edges[1:][once]))
    return tuple(np.concatenate(x) for x in zip(*found))


_BYTES = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, 256, dtype=np.uint64)


def with_runs(digest: np.ndarray, start: np.ndarray, end: np.ndarray, marked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunks, and every two and four in a row, which may have another first document than their parts.

    With ``marked``, a bool a chunk, only what is made of such chunks.
    """
    marked = np.ones(len(digest), bool) if marked is None else marked
    order = np.argsort(start, kind="stable")
    digest, start, end, marked = digest[order], start[order], end[order], marked[order]
    found = [(digest[marked], start[marked], end[marked])]
    for k in (2, 4):
        if len(digest) >= k:
            marked = marked[: -k // 2] & marked[k // 2 :]
            every = runs(digest, k) + np.uint64(k)
            found.append((every[marked], start[: len(start) - k + 1][marked], end[k - 1 :][marked]))
    return tuple(np.concatenate(x) for x in zip(*found))


_Sides = tuple[np.ndarray, np.ndarray]


def surroundings(data: np.ndarray, pieces: _Sides, single: _Sides, min_words: int) -> tuple[np.ma.MaskedArray, np.ma.MaskedArray]:
    """Hashes of the bytes that the nearest words before and behind each piece of a text reach over.

    Pieces are chunks, of which ``single`` has all, and runs of them. The hashes take half as many words on either
    side as the piece, parts of words included, lacks of ``min_words``. If two texts share a piece and its size,
    an equal stretch of ``min_words`` whole words that touches it goes that far on one side at least, so they have
    one of the hashes in common. Between the chunks of a run there may be bytes that differ: they count as the most
    words so many bytes can touch, which is the same in both texts. Masked where the text has fewer words there;
    both 0, as no hash is, if the piece alone may do, or if it touches an empty chunk, as a long stretch may leave.
    """
    left, right = _beside(data, pieces, single, min_words, _prefix_sums(data))
    return np.ma.array(left[0], mask=left[1]), np.ma.array(right[0], mask=right[1])


def _beside(data: np.ndarray, pieces: _Sides, single: _Sides, min_words: int, sums: np.ndarray) -> tuple[_Sides, _Sides]:
    """``surroundings`` as hashes and masks apart; ``sums`` are the text's ``_prefix_sums``."""
    start, end = pieces
    empty = np.sort(single[0][single[0] == single[1]])
    single = tuple(x[single[0] < single[1]] for x in single)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, stop = edges[::2], edges[1::2]
    before, behind = np.searchsorted(stop, start, side="right"), np.searchsorted(first, end, side="left")
    order = np.argsort(single[0], kind="stable")
    c_start, c_end = single[0][order], single[1][order]
    own = np.searchsorted(first, c_end, side="left") - np.searchsorted(stop, c_start, side="right")
    n_words, n_bytes = (np.concatenate([[0], np.cumsum(x)]) for x in (own, c_end - c_start))
    i, j = np.searchsorted(c_start, start, side="left"), np.searchsorted(c_end, end, side="right")
    between = end - start - (n_bytes[j] - n_bytes[i])
    most = np.where(between == 0, behind - before, n_words[j] - n_words[i] + (between + j - i - 1) // 2)
    need = -(-(min_words - most) // 2)
    if len(empty):
        need[np.searchsorted(empty, start, side="left") != np.searchsorted(empty, end, side="right")] = 0
    powers = _power_tables(len(data) + 1)

    def hashed(a: np.ndarray, b: np.ndarray, short: np.ndarray) -> _Sides:
        h = (mixed((sums[b] - sums[a]) * powers.down[a] + (b - a).astype(np.uint64)) >> np.uint64(33)).astype(np.int32)
        return np.where(lacks, np.maximum(h, 1), np.int32(0)), short & lacks

    lacks = need > 0
    far, near = before - need, behind + need - 1
    left = hashed(np.append(first, 0)[np.clip(far, 0, len(first))], start, far < 0)
    right = hashed(end, np.maximum(np.append(stop, 0)[np.clip(near, 0, len(stop))], end), near >= len(stop))
    return left, right


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's different chunks."""
    for batch in batches:
        for part in slices(batch):
            data, offsets = buffers(part.column("text"))
            found = [np.unique(chunks(data[a:b])[0]) for a, b in zip(offsets[:-1], offsets[1:])]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            every = np.concatenate([np.zeros(0, np.uint64), *found])
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(owner), pa.array(every.view(np.int64))], names=["doc_id", "digest"])


def _set(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bit of each key is set in a bitmap of ``2 ** bits`` bits."""
    at = keys >> np.uint64(64 - bits)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _chunked(sent: Broadcast, bits: int, again: Broadcast, min_words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        for batch in batches:
            for part in slices(batch):
                data, offsets = buffers(part.column("text"))
                found, left, right = [], [], []
                # A row of an id that repeats may not be the one that stays, so its words say nothing.
                unsure = _set(again.value, _id_keys(part.column("doc_id")), _ID_BITS)
                # Hashes must not see the text before: each text is rolled over alone.
                for a, b, free in zip(offsets[:-1], offsets[1:], unsure):
                    sums = _prefix_sums(data[a:b])
                    digest, start, end = chunks(data[a:b], sums)
                    found.append(with_runs(digest, start, end, _set(bitmap, digest, bits)))
                    n = len(found[-1][0])
                    sides = [(np.zeros(n, np.int32), np.zeros(n, bool))] * 2 if free or not n else _beside(data[a:b], found[-1][1:], (start, end), min_words, sums)
                    left.append(sides[0])
                    right.append(sides[1])
                owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                digest, start, end = (np.concatenate([np.zeros(0, t), *(f[i] for f in found)]) for i, t in enumerate((np.uint64, np.int64, np.int64)))
                none = (np.zeros(0, np.int32), np.zeros(0, bool))
                sides = [pa.array(values, mask=mask) for values, mask in ((np.concatenate(x) for x in zip(none, *side)) for side in (left, right))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(owner), pa.array(digest.view(np.int64)), pa.array(start.astype(np.int32)), pa.array((end - start).astype(np.int32)), *sides],
                    names=["doc_id", "digest", "start", "size", "left", "right"],
                )

    return run


def _id_keys(ids: pa.Array) -> np.ndarray:
    return mixed(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) + np.uint64(0x5BD1))


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_id_keys(batch.column("doc_id")).view(np.int64))], names=["key"])


def equal_stretches(a: bytes, b: bytes, shift: int, lo: int, hi: int, min_words: int) -> list[tuple[int, int, int]]:
    """Stretches of ``a`` that equal ``b`` ``shift`` bytes before, near ``lo`` to ``hi``, cut to whole words.

    Each is ``(first byte, end, words)`` with ``min_words`` or more.
    """
    begin, stop = max(0, shift), min(len(a), len(b) + shift)
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    same = x[begin:stop] == y[begin - shift : stop - shift]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8))) + begin
    out = []
    for s, e in zip(edges[::2], edges[1::2]):
        if e <= lo or s >= hi:
            continue
        space = _SPACE[x[s:e]]
        # A word cut at an edge in either text does not count.
        left = s == 0 or _SPACE[x[s - 1]]
        left &= s - shift == 0 or bool(_SPACE[y[s - shift - 1]])
        right = e == len(a) or _SPACE[x[e]]
        right &= e - shift == len(b) or bool(_SPACE[y[e - shift]])
        inside = ~space
        gaps = np.flatnonzero(space)
        if not left:
            inside[: gaps[0] if len(gaps) else len(inside)] = False
        if not right:
            inside[gaps[-1] if len(gaps) else 0 :] = False
        at = np.flatnonzero(inside)
        n = int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum()) if len(inside) else 0
        if n >= min_words:
            out.append((int(s + at[0]), int(s + at[-1] + 1), n))
    return out


def _compared(min_words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            names = ["doc_id", "first_doc_id", "places", "text", "first_text"]
            for d, f, places, text, first in zip(*[batch.column(c).to_pylist() for c in names]):
                a, b = text.encode(), first.encode()
                for at in places:
                    shift = at["shift"]
                    for s, e, n in equal_stretches(a, b, shift, at["lo"], at["hi"], min_words):
                        start = len(a[:s].decode())
                        out.append((d, start, start + len(a[s:e].decode()), n, f, len(b[: s - shift].decode())))
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "end", "n_words", "first_doc_id", "first_start"])

    return run


def repeated_passages(docs: DataFrame, min_words: int = 50, min_shared: int = _LEAST_CHUNK, bits: int = 26) -> DataFrame:
    """``doc_id, start, end, n_words, first_doc_id, first_start`` of passages that an earlier document has.

    ``docs (doc_id, text, ...)``; places are code points, ends excluded. A passage is ``min_words`` whole
    words or more (runs of bytes but blank and 0x09 to 0x0D) that stand, byte for byte, in the document
    ``first_doc_id`` with a smaller id. Both are held against each other if they share chunks, or runs of two
    or four, of ``min_shared`` bytes in all at one distance, of which ``first_doc_id`` is the first document.
    By default any shared chunk is enough.

    Whole texts are read. Null and empty texts and rows without id have no passages. Rows that repeat a
    doc_id are one document with the text that sorts first. Other columns are ignored. An empty table gives
    an empty result. A chunk that very many documents have is a pre-aggregated minimum and then one side of
    a join that adaptive execution can split. Chunks that two documents have are marked first, in a bitmap of
    ``2 ** bits`` bits (26: 8 MB), so that what only one document has takes no part in the join; with more
    such chunks than the bitmap can keep apart the result is the same and more rows are joined. Two texts are
    only brought together if the words beside a shared chunk (``surroundings``) or the room between two of them
    allow for a passage; that loses none. The distances
    of two documents, at most as many as one has chunks and runs, are one row beside their texts.
    """
    small_batches(docs.sparkSession)
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spread = texts.mapInArrow(_digests, "doc_id long, digest long").groupBy("digest").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    sent = docs.sparkSession.sparkContext.broadcast(key_bitmap(spread.where("lo < hi").select(F.col("digest").alias("key")), bits))
    repeated = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().where("count > 1").select("doc_id")
    again = docs.sparkSession.sparkContext.broadcast(key_bitmap(repeated.mapInArrow(_keyed, "key long"), _ID_BITS))
    pieces = texts.mapInArrow(_chunked(sent, bits, again, min_words), "doc_id long, digest long, start int, size int, left int, right int")
    place = F.struct("doc_id", "start", "left", "right", "size")
    first = pieces.groupBy("digest").agg(F.min(place).alias("first"), F.max("doc_id").alias("last_doc")).where("last_doc > first.doc_id")
    shared = pieces.join(first.select("digest", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("doc_id", "start", "left", "right", "size")]), "digest")
    shared = shared.where("doc_id > first_doc_id").withColumn("shift", (F.col("start") - F.col("first_start")).cast("long"))
    alike = reduce(Column.__or__, [(F.col(c) == F.col(f"first_{c}")) | (F.col(c) == 0) | (F.col(f"first_{c}") == 0) for c in ("left", "right")], F.col("size") != F.col("first_size"))
    reach = [F.min("start").cast("long").alias("lo"), F.max(F.col("start") + F.col("size")).cast("long").alias("hi"), F.sum("size").alias("n")]
    aligned = shared.groupBy("doc_id", "first_doc_id", "shift").agg(*reach, F.max("size").alias("most"), F.max(F.coalesce(alike, F.lit(False))).alias("alike"))
    # Around no chunk, a stretch may still stand between two of them; its words and the gaps need so many bytes.
    aligned = aligned.where((F.col("n") >= min_shared) & (F.col("alike") | (F.col("hi") - F.col("lo") - F.col("most") >= 2 * min_words - 1)))
    aligned = staged(aligned.select("doc_id", "first_doc_id", "shift", "lo", "hi"), "aligned")
    ids = aligned.select("doc_id").union(aligned.select("first_doc_id")).distinct()
    wanted = staged(texts.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")), "texts")
    places = aligned.groupBy("doc_id", "first_doc_id").agg(F.collect_list(F.struct("shift", "lo", "hi")).alias("places"))
    both = places.join(wanted, "doc_id").join(wanted.select(F.col("doc_id").alias("first_doc_id"), F.col("text").alias("first_text")), "first_doc_id")
    found = both.select("doc_id", "first_doc_id", "places", "text", "first_text").mapInArrow(_compared(min_words), _SPANS)
    return found.distinct()


def without_repeats(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with the passages cut out of their texts; all other columns and rows stay.

    A document without passages keeps its text. What is cut of one document is one row of places.
    """
    cuts = passages.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("cuts"))
    # The caller's columns are one struct, so that no helper column can clash with them.
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("row")).join(cuts, "doc_id", "left")
    text = F.col("row")["text"]
    # Overlapping places count once: each begins where the ones before it have ended.
    zero = F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at"))
    step = F.aggregate(
        "cuts",
        zero,
        lambda s, c: F.struct(
            F.concat(s["kept"], F.when(c["start"] > s["at"], F.substring(text, (s["at"] + 1).cast("int"), (c["start"] - s["at"]).cast("int"))).otherwise("")).alias("kept"),
            F.greatest(s["at"], c["end"]).alias("at"),
        ),
        lambda s: F.concat(s["kept"], F.substring(text, (s["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    cut = F.when(F.col("cuts").isNull(), text).otherwise(step)
    return packed.select(*[(cut if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


by_value(__name__)
