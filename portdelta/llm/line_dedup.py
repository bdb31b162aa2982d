"""Similar lines by an exact set-similarity join (operator 2).

A line is the set of its words. All lines order their words alike, rarest first, by counts over all
documents. Similar lines must then have a word in common among the first few of both (prefix filter), that
word's places bound what they can share (positional filter), and their sizes must not differ too much
(length filter). A word that many lines have is posted together with each word that may be the next common
one, so common words make no long lists. Parities of the words' bits bound from below by how many words two
lines differ.

Pairs are never written, as lines of one template have a square of them. Lines that meet under a word and pass
the filters are edges, as many a key as join them all; the components of these edges hold all similar lines, and
each brings its lines' words together once. There the links are counted by exact Jaccard similarity. A
component of very many lines is cut into blocks, and every two blocks are one group.

Lines with equal sets are one class, joined once. Counts are kept in a table of fixed size by the words'
hashes: words that share a number only change the common order, never the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portdelta.llm.components import components
from portdelta.llm.staging import blocks_of, key_bitmap, small_batches, staged, summed_blocks
from portdelta.llm.text import buffers, mixed, short_words, slices
from portdelta.ship import by_value

_COUNT_BITS, _BLOCK, _FILTER_BITS = 19, 1 << 15, 26
#: Words a line may have for each 128 bits of its signature.
_WORDS_A_SIGNATURE = 150
#: Rows that tasks gather before they compare them, in whole groups; larger groups than the last are not compared row by row.
_POSTINGS, _SETS, _SMALL_GROUP = 200_000, 20_000, 600
#: Rows and words that are compared by one product of matrices.
_TILE, _TILE_WORDS = 512, 8192


@dataclass
class LineSets:
    """Distinct words of the lines of several texts, line by line; lines without words are left out."""

    text: np.ndarray
    number: np.ndarray
    first: np.ndarray
    tokens: np.ndarray
    line: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.first)


def _by_line_and_hash(line: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Order by ascending line, then hash: one sort of both in a number, unless leading bits of hashes clash."""
    if len(line) and line[-1] < 1 << 20:
        both = line.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20)
        order = np.argsort(both)
        both, sorted_hashes = both[order], hashes[order]
        if not ((both[1:] == both[:-1]) & (sorted_hashes[1:] != sorted_hashes[:-1])).any():
            return order
    return np.lexsort((hashes, line))


def line_sets(texts: pa.Array) -> LineSets:
    data, offsets = buffers(texts)
    w = short_words(data, offsets)
    ends = np.flatnonzero(data == 0x0A)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(w.first))
    # Lines are counted over all texts, so that a new text is a new line too.
    line = np.cumsum(np.bincount(np.searchsorted(w.starts, ends), minlength=len(w.starts) + 1)[: len(w.starts)]) + text
    order = _by_line_and_hash(line, w.hashes)
    line, tokens, text = line[order], w.hashes[order], text[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (tokens[1:] != tokens[:-1])
    line, tokens, text = line[new], tokens[new], text[new]
    at = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, int)
    own = text[at]
    number = line[at] - own - np.searchsorted(ends, offsets[:-1])[own]
    size = np.diff(np.concatenate([at, [len(line)]]))
    return LineSets(own, number, np.concatenate([at, [len(line)]]).astype(int), tokens, np.repeat(np.arange(len(at)), size))


def set_keys(s: LineSets) -> np.ndarray:
    if not len(s.number):
        return np.zeros(0, np.int64)
    return mixed(np.add.reduceat(mixed(s.tokens ^ np.uint64(0xA5A5)), s.first[:-1]) + s.size.astype(np.uint64)).view(np.int64)


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - _COUNT_BITS)).astype(np.int64)


def taken(s: LineSets, rows: np.ndarray) -> LineSets:
    """Some of the lines, in the order of ``rows``."""
    size = s.size[rows]
    at = np.repeat(s.first[:-1][rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return LineSets(s.text[rows], s.number[rows], np.concatenate([[0], np.cumsum(size)]).astype(int), s.tokens[at], np.repeat(np.arange(len(rows)), size))


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of lines, then rows of word counts, in one table, as the texts are cut into words once for both."""
    total = np.zeros(1 << _COUNT_BITS)
    for batch in batches:
        met = []
        for part in slices(batch):
            s = line_sets(part.column("text"))
            met.append(_bucket(s.tokens))
            yield _rows(part.column("doc_id").take(pa.array(s.text)), pa.array(s.number.astype(np.int32)), pa.array(set_keys(s)))
        if met:
            total += np.bincount(np.concatenate(met), minlength=1 << _COUNT_BITS)
    for block in blocks_of(total, _BLOCK):
        yield _rows(block=block.column("block"), sums=block.column("sums"))


def _rows(doc_id=None, line=None, set_key=None, block=None, sums=None) -> pa.RecordBatch:
    given = {"doc_id": (doc_id, pa.int64()), "line": (line, pa.int32()), "set_key": (set_key, pa.int64()), "block": (block, pa.int32()), "sums": (sums, pa.binary())}
    n = next(len(x) for x, _ in given.values() if x is not None)
    return pa.RecordBatch.from_arrays([pa.nulls(n, kind) if x is None else x for x, kind in given.values()], names=list(given))


def prefix_keys(s: LineSets, counts: np.ndarray, percent: int, often: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys to find similar lines by, their line, and the place of their (first) word in it."""
    rarity = counts[_bucket(s.tokens)]
    n, first, line = s.size[s.line], s.first[:-1][s.line], s.line
    place = np.arange(len(line)) - first
    if len(s.size) < 1 << 20 and s.size.max(initial=0) < 1 << 12:
        # Words of a line ascend, so their places stand for them.
        both = line.astype(np.uint64) << np.uint64(44) | rarity.astype(np.uint64) << np.uint64(12) | place.astype(np.uint64)
        order = first + (np.sort(both) & np.uint64(0xFFF)).astype(np.int64)
    else:
        order = np.lexsort((s.tokens, rarity, line))
    tokens, rarity = s.tokens[order], rarity[order]
    prefix = n - -(-percent * n // 100) + 1
    # Below four words no other set of words is similar enough to matter at 0.75 or more.
    probes = place < prefix
    single = probes & ((rarity <= often) | (n < 2))
    keys, owners, places = [mixed(tokens[single])], [line[single]], [place[single]]
    crowded = np.flatnonzero(probes & ~single)
    ahead = 1
    while len(crowded):
        crowded = crowded[place[crowded] + ahead < np.minimum(prefix[crowded] + 1, n[crowded])]
        keys.append(mixed(tokens[crowded] * np.uint64(3) + tokens[crowded + ahead]))
        owners.append(line[crowded])
        places.append(place[crowded])
        ahead += 1
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(places)


def signatures(s: LineSets) -> np.ndarray:
    """Two longs per line: for each of 128 bits, whether an odd number of its words have it."""
    out = np.zeros((len(s.number), 2), np.uint64)
    if len(s.number):
        bit = (s.tokens >> np.uint64(20)) & np.uint64(127)
        for half in (0, 1):
            own = np.where(bit >> np.uint64(6) == half, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
            out[:, half] = np.bitwise_xor.reduceat(own, s.first[:-1])
    return out


def long_signatures(s: LineSets) -> list[bytes | None]:
    """The same with more bits for lines of many words, which 128 bits do not keep apart; None for others.

    Folded in halves they are what fewer bits would have given.
    """
    out: list[bytes | None] = [None] * len(s.number)
    for i in np.flatnonzero(s.size > _WORDS_A_SIGNATURE):
        tokens = s.tokens[s.first[i] : s.first[i + 1]]
        width = 128
        while width * _WORDS_A_SIGNATURE < 128 * len(tokens):
            width *= 2
        odd = np.bincount((tokens >> np.uint64(20)) & np.uint64(width - 1), minlength=width) & 1
        out[i] = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return out


def _folded_distance(a: bytes, b: bytes) -> int:
    x, y = (np.frombuffer(v, np.uint64) for v in (a, b))
    width = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, width), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


class _New:
    """Which keys a task has not met before; it forgets them when they are many."""

    def __init__(self, most: int = 1 << 20):
        self.met: set[int] = set()
        self.most = most

    def rows(self, keys: np.ndarray) -> np.ndarray:
        if len(self.met) > self.most:
            self.met = set()
        at = np.sort(np.unique(keys, return_index=True)[1])
        at = at[[k not in self.met for k in keys[at].tolist()]] if len(at) else at
        self.met.update(keys[at].tolist())
        return at


def _index(sent, percent: int, often: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, new = sent.value, _New()
        for batch in batches:
            for part in slices(batch):
                s = line_sets(part.column("text"))
                s = taken(s, new.rows(set_keys(s)))
                keys, line, place = prefix_keys(s, counts, percent, often)
                own, bits, more = set_keys(s), signatures(s).view(np.int64), pa.array(long_signatures(s), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(own[line]),
                        pa.array(s.size[line] << 32 | place),
                        pa.array(bits[line, 0]),
                        pa.array(bits[line, 1]),
                        more.take(pa.array(line)),
                    ],
                    names=["key", "set_key", "size_place", "s0", "s1", "more"],
                )

    return run


def _whole_groups(batches: Iterable[pa.RecordBatch], names: list[str], rows: int) -> Iterator[pa.Table]:
    """Batches sorted by ``names`` put together to tables of some ``rows`` rows or more that cut no group."""
    kept: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        changes = np.zeros(batch.num_rows - 1, bool)
        for name in names:
            v = batch.column(name).to_numpy()
            changes |= v[1:] != v[:-1]
        at = np.flatnonzero(changes)
        if len(at):
            cut = int(at[-1]) + 1
            yield pa.Table.from_batches([*kept[:-1], batch.slice(0, cut)])
            kept = [batch.slice(cut)]
            n = kept[0].num_rows
    if kept:
        yield pa.Table.from_batches(kept)


def _group_ends(group: np.ndarray) -> np.ndarray:
    """Where the group of each row ends; rows of a group stand together."""
    last = np.flatnonzero(np.concatenate([group[1:] != group[:-1], [True]])) + 1
    return np.repeat(last, np.diff(np.concatenate([[0], last])))


def _pairs_apart(end: np.ndarray, n: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group that are 1, 2, ... rows apart, while their sizes fit. Sizes ascend in a group."""
    i, apart = np.arange(len(end)), 1
    while True:
        i = i[i + apart < end[i]]
        i = i[100 * n[i] >= percent * n[i + apart]]
        if not len(i):
            return
        yield i, i + apart
        apart += 1


def _close(bits: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether so few words as the signatures show may be all by which two lines differ."""
    most = (100 - percent) * (n[i] + n[j]) // (100 + percent)
    return np.bitwise_count(bits[i, 0] ^ bits[j, 0]).astype(np.int64) + np.bitwise_count(bits[i, 1] ^ bits[j, 1]) <= most


def joined_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes is connected with by the edges ``i, j``."""
    root = np.arange(n)
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _edges(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["key"], _POSTINGS):
            key, own, both = (table.column(c).to_numpy() for c in ("key", "set_key", "size_place"))
            group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            if len(key) < 1 << 19 and int(both.max()) >> 32 < 1 << 20:
                # A set that still stands twice in a group only meets itself.
                order = np.argsort(group << 44 | both >> 32 << 24 | own >> 40 & 0xFFFFFF)
            else:
                order = np.lexsort((own, both >> 32, group))
            new = np.ones(len(order), bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (own[order][1:] != own[order][:-1])
            order = order[new]
            key, own, n, place = key[order], own[order], both[order] >> 32, both[order] & 0xFFFFFFFF
            bits = np.stack([table.column(c).to_numpy()[order].view(np.uint64) for c in ("s0", "s1")], axis=1)
            more = table.column("more").combine_chunks()
            long = more.is_valid().to_numpy(zero_copy_only=False)[order]

            def fits(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                ok = _close(bits, n, i, j, percent)
                i, j, at = i[ok], j[ok], np.flatnonzero(ok)
                sizes = n[i] + n[j]
                apart = (100 + percent) * np.minimum(n[i] - place[i], n[j] - place[j]) >= percent * sizes
                for k in np.flatnonzero(apart & long[i] & long[j]):
                    apart[k] = (100 + percent) * _folded_distance(more[int(order[i[k]])].as_py(), more[int(order[j[k]])].as_py()) <= (100 - percent) * sizes[k]
                ok[at] = apart
                return ok

            end = _group_ends(key)
            start = np.concatenate([[0], end[:-1]])
            start = np.maximum.accumulate(np.where(np.arange(len(end)) == start, start, 0))
            found = [(np.zeros(0, int), np.zeros(0, int))]
            small = np.flatnonzero(end - start <= _SMALL_GROUP)
            place_of = np.arange(len(end))
            for i, j in _pairs_apart(np.where(end - start <= _SMALL_GROUP, end, place_of), n, percent) if len(small) else ():
                ok = fits(i, j)
                found.append((i[ok], j[ok]))
            for first in np.unique(start[end - start > _SMALL_GROUP]):
                # What one line has met needs no other line: each is compared with those not met yet.
                left = np.arange(first, end[first])
                while len(left):
                    met, left = [int(left[0])], left[1:]
                    while met and len(left):
                        one = met.pop()
                        near = left[(100 * np.minimum(n[left], n[one]) >= percent * np.maximum(n[left], n[one]))]
                        near = near[fits(np.full(len(near), one), near)]
                        found.append((np.full(len(near), one), near))
                        met += near.tolist()
                        left = np.setdiff1d(left, near, assume_unique=True) if len(near) else left
            i, j = (np.concatenate(x) for x in zip(*found))
            nodes, at = np.unique(own, return_inverse=True)
            root = joined_roots(len(nodes), at[i], at[j])
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], names=["a", "b"])

    return run


def _wanted_sets(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, new = sent.value, _New()
        for batch in batches:
            for part in slices(batch):
                s = line_sets(part.column("text"))
                keys = set_keys(s)
                at = keys.view(np.uint64) >> np.uint64(64 - _FILTER_BITS)
                hit = np.flatnonzero((bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)
                s = taken(s, hit[new.rows(keys[hit])])
                tokens = pa.ListArray.from_arrays(pa.array(s.first.astype(np.int32)), pa.array(s.tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_keys(s)), tokens], names=["set_key", "tokens"])

    return run


def _compared(s: LineSets, rank: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Exact comparison of pairs of lines; ``rank`` has the words in the order of ``s``, line after line ascending."""
    ok = np.zeros(len(i), bool)
    for at in range(0, len(i), _SETS):
        a, b = i[at : at + _SETS], j[at : at + _SETS]
        size = s.size[a]
        first = np.cumsum(size) - size
        words = rank[np.repeat(s.first[:-1][a] - first, size) + np.arange(int(size.sum()))]
        wide = int(rank.max()) + 1
        sought = np.repeat(b, size) * wide + words
        every = s.line * wide + rank
        spot = np.searchsorted(every, sought)
        common = np.add.reduceat((every[np.minimum(spot, len(every) - 1)] == sought).astype(np.int64), first)
        ok[at : at + _SETS] = (100 + percent) * common >= percent * (size + s.size[b])
    return ok


def _tiles(s: LineSets, rank: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All similar pairs ``i < j`` of lines sorted by size, from products of tiles of lines and words."""
    n = s.size
    for a in range(0, len(n), _TILE):
        rows_a = np.arange(a, min(a + _TILE, len(n)))
        words_a = rank[s.first[a] : s.first[rows_a[-1] + 1]]
        for b in range(a, len(n), _TILE):
            rows_b = np.arange(b, min(b + _TILE, len(n)))
            if 100 * n[rows_a[-1]] < percent * n[b]:
                break
            words_b = rank[s.first[b] : s.first[rows_b[-1] + 1]]
            both = np.intersect1d(words_a, words_b)
            common = np.zeros((len(rows_a), len(rows_b)), np.int64)
            for at in range(0, len(both), _TILE_WORDS):
                some = both[at : at + _TILE_WORDS]
                parts = []
                for rows, words in ((rows_a, words_a), (rows_b, words_b)):
                    spot = np.minimum(np.searchsorted(some, words), len(some) - 1)
                    hit = some[spot] == words
                    part = np.zeros((len(rows), len(some)), np.float32)
                    part[(s.line[s.first[rows[0]] : s.first[rows[-1] + 1]] - rows[0])[hit], spot[hit]] = 1
                    parts.append(part)
                common += (parts[0] @ parts[1].T).astype(np.int64)
            like = (100 + percent) * common >= percent * (n[rows_a][:, None] + n[rows_b])
            i, j = np.nonzero(like)
            i, j = rows_a[i], rows_b[j]
            yield i[i < j], j[i < j]


def _counted(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["component", "lo", "hi"]
        for table in _whole_groups(batches, names, _SETS):
            columns = [table.column(c).to_numpy() for c in names]
            sets = table.column("tokens").combine_chunks()
            size = sets.value_lengths().to_numpy().astype(np.int64)
            order = np.lexsort((size, *columns[::-1]))
            component, lo, hi = (c[order] for c in columns)
            own, key, doc, line = (table.column(c).to_numpy()[order] for c in ("own", "set_key", "doc_id", "line"))
            number = np.zeros(len(size), np.int64)
            given = LineSets(number, number, np.concatenate([[0], np.cumsum(size)]), sets.flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(size)), size))
            s = taken(given, order)
            rank = np.unique(s.tokens, return_inverse=True)[1]
            group = np.concatenate([[0], np.cumsum(reduce(np.logical_or, (c[1:] != c[:-1] for c in (component, lo, hi))))])
            end, n, bits = _group_ends(group), s.size, signatures(s)
            many = np.bincount(group)[group] > _SMALL_GROUP
            earlier = np.empty(len(doc), np.int64)
            by_first = np.lexsort((line, doc))
            earlier[by_first] = np.arange(len(doc))
            links, near = np.zeros(len(doc), np.int64), np.full(len(doc), len(doc))

            def note(i: np.ndarray, j: np.ndarray) -> None:
                # In a group of two blocks only pairs across count; those of one block have their own group.
                across = (lo[i] == hi[i]) | (own[i] != own[j])
                for x, y in ((i[across], j[across]), (j[across], i[across])):
                    np.add.at(links, x, 1)
                    np.minimum.at(near, x, earlier[y])

            for i, j in _pairs_apart(np.where(many, np.arange(len(n)), end), n, percent):
                ok = _close(bits, n, i, j, percent)
                i, j = i[ok], j[ok]
                ok = _compared(s, rank, i, j, percent)
                note(i[ok], j[ok])
            for g in np.unique(group[many]):
                rows = np.flatnonzero(group == g)
                part = taken(s, rows)
                for i, j in _tiles(part, rank[s.first[rows[0]] : s.first[rows[-1] + 1]], percent):
                    note(rows[i], rows[j])
            at = np.flatnonzero(links)
            spot = by_first[near[at]]
            yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(links[at]), pa.array(doc[spot]), pa.array(line[spot])], names=["set_key", "n_links", "doc_id", "line"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def lines_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, line, set_key`` of every line with words, and ``block, sums`` of their words' counts."""
    both = staged(_texts(docs).mapInArrow(_described, "doc_id long, line int, set_key long, block int, sums binary"), "lines")
    return both.where("set_key IS NOT NULL").select("doc_id", "line", "set_key"), both.where("block IS NOT NULL").select("block", "sums")


def linked_sets(docs: DataFrame, first: DataFrame, word_counts: DataFrame, percent: int = 80, often: int = 512, most: int = 8192) -> DataFrame:
    """``set_key, n_links, near`` of the line sets that have others of Jaccard similarity ``percent`` or more.

    ``n_links`` counts them and ``near`` is the least ``first`` of them, given by ``first (set_key, first)``. A component
    of more than ``most`` sets goes to its groups in blocks of about so many, two a group.
    """
    texts = _texts(docs).select("text")
    spark = docs.sparkSession
    counts = summed_blocks(word_counts, 1 << _COUNT_BITS)
    sent = spark.sparkContext.broadcast(np.minimum(counts, 2**32 - 1).astype(np.uint32))
    index = texts.mapInArrow(_index(sent, percent, often), "key long, set_key long, size_place long, s0 long, s1 long, more binary")
    edges = index.repartition("key").sortWithinPartitions("key").mapInArrow(_edges(percent), "a long, b long")
    found = staged(components(edges), "components")
    wanted = key_bitmap(found.select(F.col("node").alias("key")), _FILTER_BITS)
    sets = texts.mapInArrow(_wanted_sets(spark.sparkContext.broadcast(wanted)), "set_key long, tokens array<long>").repartition("set_key").dropDuplicates(["set_key"])
    large = found.groupBy("component").count().where(F.col("count") > most).select("component", F.ceil(F.col("count") / most).cast("int").alias("blocks"))
    known = found.withColumnRenamed("node", "set_key").join(first, "set_key").join(sets, "set_key").join(large, "component", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = known.withColumn("own", F.pmod(F.hash("set_key"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = own.select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "set_key", "first.doc_id", "first.line", "tokens")
    keys = ["component", "lo", "hi"]
    links = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_counted(percent), "set_key long, n_links long, doc_id long, line int")
    return links.groupBy("set_key").agg(F.sum("n_links").alias("n_links"), F.min(F.struct("doc_id", "line")).alias("near"))


def line_decisions(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, line, n_links, removed`` of every line with words.

    ``docs (doc_id, text, ...)``. Lines end at 0x0A and are counted from 0; words are runs of bytes other
    than blank and 0x09 to 0x0D, with A-Z in lower case. A line goes if an earlier one, by doc_id and line,
    has the same set of words or one with a Jaccard similarity of ``percent`` or more, whether that one
    stays or not. ``n_links`` counts the different sets similar to the line's. Lines without words, null and
    empty texts, and rows without id have no rows and lose nothing. Rows that repeat a doc_id are one
    document: equal lines at the same number count once. Other columns are ignored.
    """
    lines, word_counts = lines_of(docs)
    first = lines.groupBy("set_key").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    reached = linked_sets(docs, first, word_counts, percent)
    known = first.join(reached, "set_key", "left").select("set_key", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.least("first", F.coalesce("near", "first")).alias("bound"))
    return lines.join(known, "set_key").select("doc_id", "line", "n_links", (F.struct("doc_id", "line") > F.col("bound")).alias("removed"))


def line_summary(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_lines, n_removed, n_links`` of every row of ``docs``; lines without words are not counted."""
    found = line_decisions(docs, percent).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(F.when(F.col("removed"), 1)).alias("n_removed"), F.sum("n_links").alias("n_links")
    )
    names = ["n_lines", "n_removed", "n_links"]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, "doc_id", "left").select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])


def without_similar_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` without the lines that ``line_decisions`` removes; all rows and other columns stay."""
    gone = line_decisions(docs, percent).where("removed").groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    # The caller's columns are one struct, so that no helper column can clash with them.
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("row")).join(gone, "doc_id", "left")
    text = F.col("row")["text"]
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    cut = F.when(F.col("gone").isNull(), text).otherwise(kept)
    return packed.select(*[(cut if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


by_value(__name__)
