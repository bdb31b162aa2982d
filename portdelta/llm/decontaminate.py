"""Benchmark items inside documents, by size-partitioned MinHash containment search (operator 3).

Containment of a short item in a long document says little about their similarity, so items are partitioned
by size and a document is cut, per size class, in windows little longer than the class's items: three
neighbouring blocks of half an item each, so that every run of an item's length lies inside a window. A
window that holds most of an item is similar to it, and one of 32 minima agrees almost surely. Minima of the
items are looked up through a bitmap of fixed size, which is all that is sent to the tasks; items of few words
are looked up by each of their shingles, as so few agree too rarely in a minimum. What passes is joined with the items and confirmed on exact shingle sets of the whole document.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portdelta.llm.staging import key_bitmap, small_batches, staged
from portdelta.llm.text import Words, buffers, mixed, runs, slices, words
from portdelta.ship import by_value

SHINGLE, MINIMA, RATIO = 5, 32, 1.5
_DRAW = np.random.Generator(np.random.PCG64(33))
_MULTIPLY = _DRAW.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _DRAW.integers(0, 2**64, MINIMA, dtype=np.uint64)


def size_class(n_words: int) -> int:
    """Class of an item; below five words the class is the number of words."""
    if n_words < SHINGLE:
        return n_words
    return 100 + math.ceil(math.log(n_words) / math.log(RATIO) - 1e-9)


def class_limits(number: int) -> tuple[int, int]:
    """Shingle length, and the most words of an item of the class."""
    return (number, number) if number < 100 else (SHINGLE, max(SHINGLE, math.floor(RATIO ** (number - 100) + 1e-6)))


def _key(minimum: np.ndarray, k: int, number: int) -> np.ndarray:
    return mixed(minimum + np.uint64((k * 1000 + number) * 0x9E3779B97F4A7C15 % 2**64))


#: Items of up to this many words are looked up by each of their shingles; the class number of those keys.
_FEW_WORDS, _SHORT = 17, 999


def _by_shingle(number: int) -> bool:
    return number >= 100 and class_limits(number)[1] <= _FEW_WORDS


def _n_minima(number: int) -> int:
    return MINIMA if number >= 100 else 1


def item_set(w: Words, i: int) -> tuple[int, np.ndarray]:
    h = w.of(i)
    return len(h), np.unique(runs(h, min(SHINGLE, len(h)))) if len(h) else np.zeros(0, np.uint64)


def _item_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            w = words(*buffers(part.column("text")))
            out = []
            for i in range(part.num_rows):
                n, s = item_set(w, i)
                number = size_class(n)
                if _by_shingle(number):
                    out.append((number, len(s), _key(s, 0, _SHORT).view(np.int64).tolist()))
                    continue
                keys = [_key((s * _MULTIPLY[k] + _ADD[k]).min(keepdims=True), k, number) for k in range(_n_minima(number))] if n else []
                out.append((number, len(s), [int(x[0]) for x in map(lambda y: y.view(np.int64), keys)]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("item_id"),
                    pa.array([o[0] for o in out], pa.int32()),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[2] for o in out], pa.list_(pa.int64())),
                ],
                names=["item_id", "size_class", "n_item", "keys"],
            )


def window_keys(w: Words, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all windows of several texts, for all size classes, and the text each is from."""
    keys, owners = [], []
    lengths = np.diff(w.first)
    for k in sorted({class_limits(n)[0] for n in numbers}):
        hashes = runs(w.hashes, k)
        full = np.flatnonzero(lengths >= k)
        if not len(full):
            continue
        first, stop = w.first[full], w.first[full + 1] - k + 1
        # Only runs inside a text count: move them together, text by text.
        inside = np.zeros(len(hashes) + 1, np.int8)
        np.add.at(inside, first, 1)
        np.add.at(inside, stop, -1)
        own = hashes[np.cumsum(inside[:-1]) > 0]
        size = stop - first
        base = np.concatenate([[0], np.cumsum(size)[:-1]])
        shapes = {}
        if k == SHINGLE and any(_by_shingle(n) for n in numbers):
            keys.append(_key(own, 0, _SHORT))
            owners.append(np.repeat(full, size))
        for number in (n for n in numbers if class_limits(n)[0] == k and not _by_shingle(n)):
            step = max(1, math.ceil(class_limits(number)[1] / 2)) if number >= 100 else 1
            per = -(-size // step)
            text = np.repeat(np.arange(len(full)), per)
            block = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
            shapes[number] = (base[text] + block * step, text)
        for i in range(MINIMA):
            values = own * _MULTIPLY[i] + _ADD[i]
            for number, (at, text) in shapes.items():
                if i >= _n_minima(number):
                    continue
                low = np.minimum.reduceat(values, at)
                if number >= 100:
                    # A window is a block and the two after it in the same text.
                    for ahead in (1, 1):
                        same = text[:-ahead] == text[ahead:]
                        low[:-ahead] = np.where(same, np.minimum(low[:-ahead], low[ahead:]), low[:-ahead])
                keys.append(_key(low, i, number))
                owners.append(full[text])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _hits(sent, numbers: list[int], bits: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        for batch in batches:
            for part in slices(batch):
                keys, owners = window_keys(words(*buffers(part.column("text"))), numbers)
                at = keys >> np.uint64(64 - bits)
                seen = (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
                keys, owners = keys[seen], owners[seen]
                rows = np.unique(owners)
                found = [np.unique(keys[owners == r]).view(np.int64) for r in rows]
                some = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("text"), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "text", "keys"])

    return find


def _exact(percent: int):
    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, dict[int, np.ndarray], Words | None] = (None, {}, None)
        for batch in batches:
            common = []
            for doc, item in zip(batch.column("text"), batch.column("item_text")):
                text = doc.as_py()
                if last[0] != text:
                    last = (text, {}, words(*buffers(pa.array([text], pa.string()))))
                n, wanted = item_set(words(*buffers(pa.array([item.as_py()], pa.string()))), 0)
                k = min(n, SHINGLE)
                if k not in last[1]:
                    last[1][k] = np.unique(runs(last[2].hashes, k))
                common.append(len(np.intersect1d(last[1][k], wanted, assume_unique=True)))
            n_item = batch.column("n_item").to_numpy()
            keep = pa.array(100 * np.array(common, np.int64) >= percent * n_item)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), pa.array(common, pa.int64()), batch.column("n_item"), pa.array(np.array(common) / n_item)],
                names=["doc_id", "item_id", "n_common", "n_item", "containment"],
            ).filter(keep)

    return check


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 80, bits: int = 26) -> DataFrame:
    """``doc_id, item_id, n_common, n_item, containment`` for items that documents contain.

    ``docs (doc_id, text, ...)``, ``items (item_id, text, ...)``. An item is contained if a document has
    ``percent`` of its distinct shingles of five words or more of them; an item of fewer words is contained
    where its words stand in a row. Items without words, null texts and rows without an id match nothing.
    Ids that repeat count once per pair, with their largest overlap. Other columns are ignored. Empty tables
    give an empty result. ``bits`` sizes the bitmap (26: 8 MB); with more items than it can keep apart more
    windows reach the join, the result is the same.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    sketched = staged(known.mapInArrow(_item_keys, "item_id long, size_class int, n_item long, keys array<long>"), "items").where("n_item > 0")
    # Classes grow with the logarithm of the longest item.
    numbers = sorted(r["size_class"] for r in sketched.select("size_class").distinct().collect())
    index = sketched.select("item_id", F.explode("keys").alias("key"))
    sent = spark.sparkContext.broadcast(key_bitmap(index, bits))
    hits = staged(texts.mapInArrow(_hits(sent, numbers, bits), "doc_id long, text string, keys array<long>"), "hits")
    pairs = hits.select("doc_id", F.explode("keys").alias("key")).join(index, "key").select("doc_id", "item_id").distinct()
    wanted = sketched.select("item_id", "n_item").join(known.withColumnRenamed("text", "item_text"), "item_id")
    both = pairs.join(wanted, "item_id").join(hits.select("doc_id", "text"), "doc_id")
    found = both.select("doc_id", "text", "item_id", "item_text", "n_item").mapInArrow(
        _exact(percent), "doc_id long, item_id long, n_common long, n_item long, containment double"
    )
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_common", "n_item")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_common", "b.n_item", "b.containment")


by_value(__name__)
