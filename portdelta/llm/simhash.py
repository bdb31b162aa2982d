"""Near duplicates by SimHash fingerprints and Golay codes (operator 12).

A fingerprint of 64 bits is cut into three segments, each read as a word of the binary Golay code of length 23.
Every word has a nearest codeword (at most three bits away), and 1,771 of 2,048 error patterns have five more
four bits away. Two facts about these give keys that cannot miss:

* words that differ in two bits or fewer have one of their codewords, near or nearest, in common;
* if words differ in one bit, the nearest codeword of either is among all codewords of the other.

Four differing bits fall on the segments in one of two ways. If a segment is untouched, another one has two
differing bits at most: keys are the untouched segment with each codeword of the other. If none is, two have
one differing bit each and the third two at most, so one of its three pieces is untouched: keys are the nearest
codeword of one, each codeword of the other, and the piece. A key has 31 bits or more.

Equal fingerprints are one class. Members of a key meet sorted in one pass and are compared by counting bits;
only a forest of links leaves a group. A group of more than ``_MOST`` different fingerprints is not compared
in pairs: fingerprints differ in four bits or fewer exactly if a value lies within two bits of both, so its
members emit these values, and all that meet in one are linked. That is exact and linear in the group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portdelta.llm.components import components
from portdelta.llm.staging import kept_at, remove, small_batches, staged
from portdelta.ship import by_value

SHINGLE, SEED, NEAR_BITS = 4, 42, 4
_MOST = 1024
_WORDS_AT_ONCE = 1 << 16

# Fixed value: generator polynomial of the binary Golay code of length 23.
_GENERATOR = 0b101011100011
_SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and length
_PIECES = 3


def _codewords() -> np.ndarray:
    """Codeword of each of the 4,096 indices; the index is its upper twelve bits."""
    rest = np.arange(4096, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (_GENERATOR << (bit - 11)), rest)
    return np.arange(4096, dtype=np.int64) << 11 | rest


def _syndrome(words: np.ndarray) -> np.ndarray:
    return (_CODE[words >> 11] ^ words) & 2047


_CODE = _codewords()


def _index_steps() -> np.ndarray:
    """For each syndrome, what to add to a word's index to get its codewords: the nearest, then those four bits away.

    Where there are none of these, the nearest is repeated.
    """
    errors = [0, *(sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(23), n))]
    leader = np.zeros(2048, np.int64)
    leader[_syndrome(np.array(errors))] = errors
    steps = np.repeat((leader >> 11)[:, None], 6, axis=1)
    blocks = _CODE[np.bitwise_count(_CODE) == 7]
    for syndrome in np.flatnonzero(np.bitwise_count(leader) == 3):
        through = blocks[blocks & leader[syndrome] == leader[syndrome]]
        steps[syndrome, 1:] ^= through >> 11
    return steps


_STEPS = _index_steps()


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """Six indices for each word of 23 bits; the first is that of its nearest codeword."""
    words = words.astype(np.int64)
    return (words >> 11)[:, None] ^ _STEPS[_syndrome(words)]


def _segments(prints: np.ndarray) -> list[np.ndarray]:
    bits = prints.view(np.uint64)
    return [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in _SEGMENTS]


def _pieces(segment: np.ndarray, length: int) -> list[np.ndarray]:
    cut = [length * k // _PIECES for k in range(_PIECES + 1)]
    return [segment >> a & (1 << (b - a)) - 1 for a, b in zip(cut, cut[1:])]


def _tagged(tag: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (np.int64(tag) << 40) | (high << 12) | low


def fuzzy_keys(prints: np.ndarray) -> np.ndarray:
    """Keys of each fingerprint, sorted, some repeated; the tag (upper bits) says which segment is shared whole.

    Tags 0 to 5 are keys of an untouched segment, ``tag // 2``; the others share no segment.
    """
    parts = _segments(prints)
    near = [codeword_indices(p) for p in parts]
    keys, tag = [], 0
    for i in range(3):
        for j in (j for j in range(3) if j != i):
            keys.append(_tagged(tag, parts[i][:, None], near[j]))
            tag += 1
    for i in range(3):
        j, k = (s for s in range(3) if s != i)
        for piece in _pieces(parts[i], _SEGMENTS[i][1]):
            # One side brings all codewords of j and the nearest of k, the other the opposite; each does both.
            left = piece[:, None] << 12
            keys.append(_tagged(tag, left | near[j], near[k][:, :1]))
            keys.append(_tagged(tag, left | near[j][:, :1], near[k]))
            tag += 1
    return np.sort(np.concatenate(keys, axis=1), axis=1)


def shared_segment(key: np.ndarray) -> np.ndarray:
    """Number of the segment that all of a key's fingerprints share, 3 if none."""
    tag = key >> 40
    return np.where(tag < 6, tag // 2, 3)


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles: a bit is set if it is in more than half of their hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    total, n = len(words) - size + 1, np.zeros(64, np.int64)
    for start in range(0, total, _WORDS_AT_ONCE):
        part = words[start : start + _WORDS_AT_ONCE + size - 1]
        line = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(part) - size + 1].tolist(), ends[size - 1 :].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        octets = hashes.view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            n[8 * byte : 8 * byte + 8] += np.bincount(octets[:, byte], minlength=256) @ _BITS_OF
    return sum(1 << bit for bit in range(64) if 2 * int(n[bit]) > total)


_BITS_OF = np.arange(256)[:, None] >> np.arange(8) & 1


def _printed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], names=["doc_id", "print"])


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 2048):
            prints = whole.column("print").slice(at, 2048).to_numpy(zero_copy_only=False)
            keys = fuzzy_keys(prints)
            new = np.ones(keys.shape, bool)
            new[:, 1:] = keys[:, 1:] != keys[:, :-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[new], pa.int64()), pa.array(np.repeat(prints, new.sum(axis=1)), pa.int64())], names=["key", "print"]
            )


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(prints: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """What the links among a group's fingerprints connect: each member with the first one of its tree."""
    close = _differ(prints[:, None], prints[None, :]) <= most
    left, out = np.ones(len(prints), bool), []
    for root in range(len(prints)):
        if not left[root]:
            continue
        left[root] = False
        tree = front = np.array([root])
        while len(front):
            front = np.flatnonzero(close[front].any(axis=0) & left)
            left[front] = False
            tree = np.concatenate([tree, front])
        if len(tree) > 1:
            out.append((np.full(len(tree) - 1, prints[root]), prints[tree[1:]]))
    return out


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("segment", pa.int32())])


def _met(keys: np.ndarray, prints: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Links of whole groups; members of a crowded one come back with the segment they share and no partner."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    found = []
    for n in range(2, 9):
        at = first[size == n]
        for i, j in combinations(range(n), 2):
            a, b = prints[at + i], prints[at + j]
            linked = _differ(a, b) <= most
            found.append((a[linked], b[linked]))
    for k in np.flatnonzero((size > 8) & (size <= _MOST)):
        found += forest(prints[first[k] : first[k] + size[k]], most)
    if found:
        both = np.unique(np.stack([np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.nulls(len(both), pa.int32())], schema=_FOUND)
    crowded = np.repeat(size > _MOST, size)
    if crowded.any():
        yield _unpaired(keys[crowded], prints[crowded])


def _unpaired(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(prints), pa.nulls(len(prints), pa.int64()), pa.array(shared_segment(keys), pa.int32())], schema=_FOUND)


def _linked(most: int):
    """Groups of sorted ``key, print`` rows; what is held is less than a batch and a full group."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = prints = np.zeros(0, np.int64)
        crowded = None
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            prints = np.concatenate([prints, batch.column("print").to_numpy()])
            if crowded is not None:
                more = int(np.searchsorted(keys, crowded, side="right"))
                if more:
                    yield _unpaired(keys[:more], prints[:more])
                keys, prints = keys[more:], prints[more:]
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield from _met(keys[:last], prints[:last], most)
            keys, prints, crowded = keys[last:], prints[last:], None
            if len(keys) > _MOST:
                yield _unpaired(keys, prints)
                crowded, keys, prints = keys[0], keys[:0], prints[:0]
        if len(keys):
            yield from _met(keys, prints, most)

    return run


def _middles(most: int):
    """Each fingerprint with every value that differs in ``most // 2`` bits or fewer outside the shared segment."""
    masks = []
    for segment in range(4):
        at, n = _SEGMENTS[segment] if segment < 3 else (0, 0)
        free = [b for b in range(64) if not at <= b < at + n]
        flips = [sum(1 << b for b in bits) for k in range(most // 2 + 1) for bits in combinations(free, k)]
        masks.append(np.array(flips, dtype=np.uint64).view(np.int64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, value in zip(batch.column("segment").to_pylist(), batch.column("print").to_pylist()):
                near = np.int64(value) ^ masks[segment]
                yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(np.full(len(near), value))], names=["key", "print"])

    return run


def _first_of_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from each run's first fingerprint to the others; rows come sorted by key."""
    key = head = None
    for batch in batches:
        keys, prints = batch.column("key").to_numpy(), batch.column("print").to_numpy()
        if not len(keys):
            continue
        new = np.concatenate([[keys[0] != key], keys[1:] != keys[:-1]])
        starts = np.flatnonzero(new)
        heads = prints[starts[np.maximum(np.cumsum(new) - 1, 0)]] if len(starts) else np.full(len(keys), head)
        if not new[0]:
            heads[: starts[0] if len(starts) else len(keys)] = head
        other = heads != prints
        yield pa.RecordBatch.from_arrays([pa.array(heads[other]), pa.array(prints[other])], names=["a", "b"])
        key, head = keys[-1], heads[-1]


def _by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "print")


def near_prints(prints: DataFrame, most: int = NEAR_BITS) -> DataFrame:
    """``a, b`` for distinct fingerprints ``print``: links whose closure is that of all pairs up to ``most`` bits apart."""
    if most not in range(0, NEAR_BITS + 1, 2):
        raise ValueError(f"keys are made for an even number of bits up to {NEAR_BITS}")
    found = staged(_by_key(prints.mapInArrow(_keyed, "key long, print long")).mapInArrow(_linked(most), "a long, b long, segment int"), "prints-met")
    links = found.where("b IS NOT NULL").select("a", "b")
    crowded = found.where("b IS NULL").select(F.col("a").alias("print"), "segment").distinct()
    middle = _by_key(crowded.mapInArrow(_middles(most), "key long, print long")).mapInArrow(_first_of_runs, "a long, b long")
    return links.union(middle).distinct()


def simhash_groups(docs: DataFrame, most: int = NEAR_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs (doc_id, text, ...)``.

    Texts whose fingerprints differ in ``most`` bits or fewer are linked; a component is what links reach, named
    by its smallest doc_id. A text of fewer than four words is one shingle; a null text or one without words has
    fingerprint zero and is linked like any other. Rows that repeat a doc_id are one document, so they and what
    is near any of them share a component. A row without doc_id takes no part and has no component. Other
    columns are ignored, so they may have any name. The result of an empty table is empty.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    printed = staged(rows.mapInArrow(_printed, "doc_id long, print long"), "prints")
    named = printed.where("doc_id IS NOT NULL")
    classes, path = kept_at(named.groupBy("print").agg(F.min("doc_id").alias("rep")), "classes")
    links = near_prints(classes.select("print"), most)
    # Different texts under one id.
    torn = named.groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("z")).where("a <> z").drop("z")
    links = links.union(named.join(torn, "doc_id").select("a", F.col("print").alias("b")).where("a <> b").distinct())
    reps = links.join(classes.select(F.col("print").alias("a"), F.col("rep").alias("rep_a")), "a")
    reps = reps.join(classes.select(F.col("print").alias("b"), F.col("rep").alias("rep_b")), "b")
    found = components(reps.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    known = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("print", F.coalesce("component", "rep").alias("component_id"))
    known = staged(known, "print-groups")
    remove(docs.sparkSession, path)
    out = printed.join(known, "print", "left").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
    return out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))


by_value(__name__)
