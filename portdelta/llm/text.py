"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a longest run of bytes other than blank and 0x09 to 0x0D, with A-Z in lower case. A set has
every distinct run of five words; a text with fewer words has its whole sequence as the only member, and a
text without words has none. All of it works on the UTF-8 buffers of an Arrow column, so no Python object
is made for a word. Texts are taken in slices of about half a megabyte; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from portdelta.ship import by_value

SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LINE_ENDS = np.zeros(256, dtype=bool)
LINE_ENDS[0x0A] = True
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_PLACES = np.random.Generator(np.random.PCG64(77)).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class _Powers:
    up: np.ndarray
    down: np.ndarray


_powers = _Powers(np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> _Powers:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    global _powers
    if len(_powers.up) < n:
        size = max(n, SLICE_BYTES)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _powers = _Powers(np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the input reaches every bit of the result."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, and where each text begins and ends. A null is an empty text."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``SLICE_BYTES`` of text."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(name))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, at + 1), batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop


@dataclass
class Words:
    """Words of several texts: hashes, byte places, and the first word of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]


def words(data: np.ndarray, offsets: np.ndarray, extra_breaks: np.ndarray | None = None, blanks: np.ndarray = _SPACE) -> Words:
    """Runs of bytes that are neither ``blanks`` (a table of 256) nor at ``extra_breaks``."""
    space = blanks[data]
    if extra_breaks is not None:
        space |= extra_breaks
    n = len(data)
    before = np.ones(n + 1, dtype=bool)
    before[1:] = space
    after = np.ones(n + 1, dtype=bool)
    after[:n] = space
    after = after[1:].copy()
    before = before[:n].copy()
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    powers = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[data] * powers.up[:n], dtype=np.uint64, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers.down[starts]
    hashes = mixed(hashes + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


_LONG_WORD = 256


def short_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words that ``words`` finds, with other hashes: eight bytes at a time, for texts of common words.

    A word's hash depends on its bytes alone. Words of more than 256 bytes have the hash that ``words`` gives.
    """
    n = len(data)
    if not n:
        return words(data, offsets)
    lower = np.zeros((n + 7) // 8 * 8 + 8, np.uint8)
    np.bitwise_or(data, ((data - np.uint8(0x41)) < 26).view(np.uint8) << np.uint8(5), out=lower[:n])
    inside = ~((data == 0x20) | ((data - np.uint8(9)) < 5))
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins[inner], stops[inner - 1] = inside[inner], inside[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    eights, size = lower.view("<u8"), ends - starts

    def eight(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The eight bytes at each place, but no more than are left."""
        place, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        value = eights[place] >> shift | eights[place + 1] << np.uint64(1) << (np.uint64(63) - shift)
        return value & np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - np.minimum(left, 8)) << 3).astype(np.uint64)

    hashes = mixed(eight(starts, size) + size.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    some, done = np.flatnonzero((size > 8) & (size <= _LONG_WORD)), 8
    while len(some):
        hashes[some] = mixed(hashes[some] * np.uint64(_BASE) + eight(starts[some] + done, size[some] - done))
        done += 8
        some = some[size[some] > done]
    long = np.flatnonzero(size > _LONG_WORD)
    if len(long):
        hashes[long] = words(data, offsets).hashes[long]
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def sequence_hash(h: np.ndarray) -> np.uint64:
    """Hash of one short run of words."""
    return mixed((h * _PLACES[: len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))[0]


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, over text borders too; callers pick the valid ones."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    total = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        total += h[j : len(h) - k + 1 + j] * _PLACES[j]
    return mixed(total)


def shingle_sets(w: Words, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    every = runs(w.hashes, k)
    out = []
    for i in range(len(w.first) - 1):
        a, b = int(w.first[i]), int(w.first[i + 1])
        if b - a >= k:
            out.append(np.unique(every[a : b - k + 1]))
        elif b > a:
            out.append(np.array([sequence_hash(w.hashes[a:b])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sets_of(texts: pa.Array, k: int = 5) -> list[np.ndarray]:
    """Shingle sets of a string column; the caller slices long columns."""
    return shingle_sets(words(*buffers(texts)), k)


by_value(__name__)
