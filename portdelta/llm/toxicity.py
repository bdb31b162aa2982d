"""Toxicity by a noisy channel (operator 9).

Written text is taken as the intended text sent through a channel that swaps letters for look-alikes,
puts separators between letters and repeats letters. Tokens that may have gone through it span a lattice
of characters; Viterbi search under a character trigram model, counted over all documents, gives the most
likely readings. A document is scored on its own words and the restored ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portdelta.llm.calibrate import pooled
from portdelta.llm.staging import blocks_of, small_batches, staged, summed_blocks
from portdelta.llm.text import Words, buffers, mixed, slices, words, _power_tables, _CODES
from portdelta.ship import by_value

SYMBOLS = 64
_BLOCK = 16384
_BINS = 400
FOLDS = 4
#: Rows that have a feature, by fold and label.
COUNTS = [f"n_{fold}_{label}" for fold in range(FOLDS) for label in (0, 1)]
#: Limits a feature may have to pass: twice the log likelihood ratio, and log odds where they are positive.
LIMITS = [(gain, odds) for odds in (1.0, 2.0, 3.0) for gain in (8.0, 11.0, 15.0, 20.0, 27.0, 36.0)]

# The letters a look-alike may stand for.
LOOK_ALIKES = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "*": "aeiou",
}

_byte = np.arange(256)
_LETTER = ((_byte | 32) >= 97) & ((_byte | 32) <= 122) | (_byte >= 128)
_DIGIT = (_byte >= 48) & (_byte <= 57)
_SIGN = np.isin(_byte, [ord(c) for c in LOOK_ALIKES if not c.isdigit()])
_PART = _LETTER | _DIGIT | _SIGN
_GAP = np.isin(_byte, [ord(c) for c in " .-_*"])
_BREAK = (_byte < 128) & ~_LETTER & ~_DIGIT

#: Symbol 0 is whatever is no letter; 1 to 26 are a to z; the rest are the Latin letters beyond them.
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[65:91] = _SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:192] = 27 + (np.arange(128, 192) & 31)


def _symbols(data: np.ndarray) -> np.ndarray:
    """Lead bytes of two-byte letters are left out, so a symbol is a character."""
    return _SYMBOL[data[data < 192]]


# --- character model -----------------------------------------------------------------------------------


def _count_trigrams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**3)
    for batch in batches:
        for part in slices(batch):
            s = _symbols(buffers(part.column("text"))[0])
            s = np.concatenate([[0, 0], s, [0]])
            total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    yield from blocks_of(total, _BLOCK)


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of each third character after two others, over all texts of ``docs``.

    Counts are 64 ** 3 numbers whatever the texts are, so model and broadcast are of fixed size.
    """
    counts = summed_blocks(docs.select("text").mapInArrow(_count_trigrams, "block int, sums binary"), SYMBOLS**3)
    c3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    c2 = c3.sum(axis=0)
    p2 = (c2 + 0.1) / (c2.sum(axis=1, keepdims=True) + 0.1 * SYMBOLS)
    p3 = (c3 + 2.0 * p2[None]) / (c3.sum(axis=2, keepdims=True) + 2.0)
    return np.log(p3).astype(np.float32)


# --- decoding ------------------------------------------------------------------------------------------


def _symbol(c: str) -> int:
    code = ord(c)
    return _ASCII[code] if code < 128 else 27 + (code & 31)


_ASCII = _SYMBOL[:128].tolist()


def _choices(token: str, i: int, spaced: bool, doubled: bool = False) -> list[tuple[str, float]]:
    """What the character may stand for, with the log probability of the channel.

    In a token that doubles several letters (``doubled``), one more is likelier.
    """
    c = token[i]
    if spaced and c in " .-_*":
        # A gap stands inside a word or between two; the character model tells which is likelier.
        out = [("", 0.0)] if i and token[i - 1] in " .-_*" else [("", 0.0), (" ", 0.0)]
        return out + [(v, -1.0 - math.log(5)) for v in LOOK_ALIKES.get(c, "")]
    out: list[tuple[str, float]] = []
    if c.isalpha():
        out.append((c, 0.0))
        if i and token[i - 1] == c:
            long = (i > 1 and token[i - 2] == c) or token[i + 1 : i + 2] == c
            out = [(c, -2.0 if long else 0.0), ("", -0.7 if long else -1.0 if doubled else -4.0)]
    for letter in LOOK_ALIKES.get(c, ""):
        out.append((letter, -1.0 - math.log(len(LOOK_ALIKES[c]))))
    if not c.isalpha():
        out.append(("", -3.0))
    return out


def readings(token: str, model: np.ndarray | list[float], spaced: bool = False, best: int = 3) -> list[str]:
    """The most likely readings of a token, best first: Viterbi over states of two characters."""
    token = token.lower()
    flat = model if isinstance(model, list) else model.ravel().tolist()
    doubled = sum(a == b and a.isalpha() for a, b in zip(token, token[1:])) > 1
    # Paths are linked backwards, so a long token costs no copies of what was read.
    states: dict[tuple[int, int, str], list[tuple[float, tuple]]] = {(0, 0, ""): [(0.0, ())]}
    for i in range(len(token)):
        after: dict[tuple[int, int, str], list[tuple[float, tuple]]] = {}
        choices = [(letter, cost, _symbol(letter) if letter else 0) for letter, cost in _choices(token, i, spaced, doubled)]
        for (x, y, last), paths in states.items():
            at = (x * SYMBOLS + y) * SYMBOLS
            for letter, cost, z in choices:
                if letter:
                    key, step = (y, z, letter), cost + flat[at + z]
                else:
                    key, step = (x, y, last), cost
                after.setdefault(key, []).extend((p + step, (s, letter) if letter else s) for p, s in paths)
        states = {k: sorted(v, key=_cost, reverse=True)[:best] if len(v) > 1 else v for k, v in after.items()}
    done = [(p + flat[(x * SYMBOLS + y) * SYMBOLS], s) for (x, y, _), paths in states.items() for p, s in paths]
    return list(dict.fromkeys(_read(s) for _, s in sorted(done, key=_cost, reverse=True)))[:best]


_cost = itemgetter(0)


def _read(path: tuple) -> str:
    out = []
    while path:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def _runs_with(inside: np.ndarray, hit: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of ``inside`` that holds a ``hit``."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    some = np.unique(np.searchsorted(starts, np.flatnonzero(hit & inside), side="right") - 1)
    return list(zip(starts[some].tolist(), ends[some].tolist()))


def suspects(data: np.ndarray, first: int, last: int) -> list[tuple[int, int, bool]]:
    """Byte spans of one text that may have gone through the channel; True: letters set apart."""
    d = data[first:last]
    n = len(d)
    if n < 3:
        return []
    letter, digit, sign = _LETTER[d], _DIGIT[d], _SIGN[d]
    low = d | 32
    hit = np.zeros(n, bool)
    hit[:-1] = (digit | sign)[:-1] & letter[1:] | letter[:-1] & (digit | sign)[1:]
    hit[:-1] |= letter[:-1] & (low[:-1] == low[1:]) & (d[:-1] < 128)
    spans: dict[tuple[int, int, bool], None] = {}
    for a, b in _runs_with(_PART[d], hit):
        spans[a, b, False] = None
    known = letter | digit | (sign & ~_GAP[d])
    # Groups joined by one or two signs without a blank.
    tie = _GAP[d] & (d != 32)
    k, g = np.pad(known, 2), np.pad(tie, 2)
    tie &= k[1:-3] & (k[3:-1] | g[3:-1] & k[4:]) | g[1:-3] & k[:-4] & k[3:-1]
    for a, b in _runs_with(known | tie, tie):
        if letter[a:b].sum() >= 2:
            spans[a, b, True] = None
    alone = known.copy()
    alone[1:] &= ~known[:-1]
    alone[:-1] &= ~known[1:]
    at = np.flatnonzero(alone)
    if len(at) >= 3:
        gaps = np.concatenate([[0], np.cumsum(_GAP[d])])
        near = (np.diff(at) <= 3) & (gaps[at[1:]] - gaps[at[:-1] + 1] == np.diff(at) - 1)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]]).astype(np.int8)))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= 2 and letter[at[a : b + 1]].sum() >= 2:
                spans[int(at[a]), int(at[b]) + 1, True] = None
    return [(first + a, first + b, s) for a, b, s in spans]


@dataclass
class Decoder:
    """Restores the suspect tokens of texts; remembers tokens it has seen."""

    model: np.ndarray
    seen: dict[tuple[str, bool], str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.flat = self.model.ravel().tolist()

    def restored(self, data: np.ndarray, first: int, last: int) -> str:
        return self.restored_texts(data[first:last], np.array([0, last - first]))[0]

    def restored_texts(self, data: np.ndarray, offsets: np.ndarray) -> list[str]:
        """What is restored of each text; all are searched at once, with a line end between them."""
        n = np.diff(offsets)
        lined = np.full(len(data) + len(n), 10, np.uint8)
        lined[np.arange(len(data)) + np.repeat(np.arange(len(n)), n)] = data
        ends = offsets[1:] + np.arange(len(n))
        spans = suspects(lined, 0, len(lined))
        owners = np.searchsorted(ends, [a for a, _, _ in spans], side="right")
        raw, out = lined.tobytes(), [[] for _ in n]
        for (a, b, spaced), text in zip(spans, owners.tolist()):
            key = (raw[a:b].decode("utf-8", "replace"), spaced)
            found = self.seen.get(key)
            if found is None:
                if len(self.seen) > 200_000:
                    self.seen.clear()
                # The token itself is scored as written.
                found = self.seen[key] = " ".join([r for r in readings(key[0], self.flat, spaced, 4) if r != key[0].lower()][:3])
            if found:
                out[text].append(found)
        return [" ".join(o) for o in out]


# --- features and weights ------------------------------------------------------------------------------


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of their first three, four, five and seven bytes, and the text each is from."""
    w: Words = words(data, offsets, _BREAK[data])
    powers = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * powers.up[: len(data)], dtype=np.uint64, out=sums[1:])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(w.first))
    kinds, owners = [w.hashes], [text]
    for size in (3, 4, 5, 7):
        long = w.ends - w.starts >= size
        at = w.starts[long]
        kinds.append(mixed((sums[at + size] - sums[at]) * powers.down[at] + np.uint64(size * 0x51ED27)))
        owners.append(text[long])
    return np.concatenate(kinds), np.concatenate(owners)


def _all_features(part: pa.RecordBatch, decoder: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """Features of the texts as written and as restored."""
    data, offsets = buffers(part.column("text"))
    found, owners = _features(data, offsets)
    restored = decoder.restored_texts(data, offsets)
    if any(restored):
        more, of = _features(*buffers(pa.array(restored, pa.string())))
        found, owners = np.concatenate([found, more]), np.concatenate([owners, of])
    return found, owners


def _decoder(sent) -> Decoder:
    """The decoder that a Python worker keeps with the broadcast model, and with it the tokens it has read."""
    known = sent.value
    if "decoder" not in known:
        known["decoder"] = Decoder(known["characters"])
    return known["decoder"]


def _found(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(sent)
        for batch in batches:
            for part in slices(batch):
                found, owners = _all_features(part, decoder)
                order = np.lexsort((found, owners))
                found, owners = found[order], owners[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (owners[1:] != owners[:-1])
                found, owners = found[new], owners[new]
                cut = np.searchsorted(owners, np.arange(part.num_rows + 1))
                own = [found[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("fold"), pa.array(own, pa.binary())], names=["label", "fold", "found"])

    return run


def _count_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label, fold = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("label", "fold"))
        own = [np.frombuffer(x, np.uint64) for x in batch.column("found").to_pylist()]
        if not any(map(len, own)):
            continue
        kind = np.repeat(fold * 2 + label, [len(x) for x in own])
        keys, inverse = np.unique(np.concatenate(own), return_inverse=True)
        seen = np.bincount(inverse * (2 * FOLDS) + kind, minlength=len(keys) * 2 * FOLDS).reshape(len(keys), 2 * FOLDS)
        counts = [pa.array(seen[:, k].astype(np.int64)) for k in range(2 * FOLDS)]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *counts], names=["feature", *COUNTS])


@dataclass
class Weights:
    """Log odds of telling features, by sorted hash."""

    features: np.ndarray
    weights: np.ndarray

    def evidence(self, found: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
        """Per text, the sum of the log odds of its telling features, each counted once."""
        out = np.zeros(n)
        if not len(self.features) or not len(found):
            return out
        at = np.minimum(np.searchsorted(self.features, found), len(self.features) - 1)
        hit = self.features[at] == found
        if hit.any():
            once = np.unique(np.stack([owners[hit], at[hit]]), axis=1)
            np.add.at(out, once[0], self.weights[once[1]])
        return out


def _odds_and_gain(pos: Column, neg: Column, n_pos: float, n_neg: float) -> tuple[Column, Column]:
    """Shrunken log odds, and twice the log likelihood ratio of the feature's own rate against the overall rate."""
    share = n_pos / max(n_pos + n_neg, 1.0)
    gain = 2 * (
        F.when(pos > 0, pos * F.log(pos / ((pos + neg) * share))).otherwise(0.0)
        + F.when(neg > 0, neg * F.log(neg / ((pos + neg) * (1 - share)))).otherwise(0.0)
    )
    odds = F.log((pos + max(share, 1e-9)) / (n_pos + 1.0)) - F.log((neg + max(1 - share, 1e-9)) / (n_neg + 1.0))
    return odds, gain


def _candidates(counts: DataFrame, n: np.ndarray, max_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features that pass the widest limits on any of the learning sets, strongest on all rows first.

    Learning set ``k`` is all rows but those of fold ``k``, the last one all rows. Sorted hashes of at most
    ``max_features`` features, and their log odds and gains, a column for each learning set.
    """
    summed = counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in COUNTS])
    total = {label: sum((F.col(f"n_{fold}_{label}") for fold in range(FOLDS)), F.lit(0)) for label in (0, 1)}
    columns, passes = [], F.lit(False)
    for k in range(FOLDS + 1):
        pos, neg = (total[label] - (F.col(f"n_{k}_{label}") if k < FOLDS else 0) for label in (1, 0))
        rows = n.sum(axis=0) - (n[k] if k < FOLDS else 0)
        odds, gain = _odds_and_gain(pos, neg, float(rows[1]), float(rows[0]))
        told = (gain >= min(g for g, _ in LIMITS)) & ((odds < 0) | (pos >= 2) & (odds >= min(o for _, o in LIMITS)))
        passes = passes | told
        columns += [odds.alias(f"odds_{k}"), F.when(told, gain).otherwise(0.0).alias(f"gain_{k}")]
    strongest = summed.where(passes).select("feature", *columns).orderBy(F.desc(f"gain_{FOLDS}"), "feature").limit(max_features)
    rows = strongest.collect()
    keys = np.array([r["feature"] for r in rows], np.int64).view(np.uint64)
    odds, gain = (np.array([[r[f"{c}_{k}"] for k in range(FOLDS + 1)] for r in rows]).reshape(len(rows), FOLDS + 1) for c in ("odds", "gain"))
    order = np.argsort(keys)
    return keys[order], odds[order], gain[order]


def _limited(odds: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Log odds of the features that pass each of ``LIMITS``, a column for each; 0 for the others."""
    return np.stack([np.where((gain >= g) & ((odds < 0) | (odds >= o)), odds, 0.0) for g, o in LIMITS], axis=-1)


def _left_out_bins(sent):
    """Rows by limits, bin of evidence and label; a row's weights come from the other folds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, odds, gain = sent.value
        weights = [_limited(odds[:, k], gain[:, k]) for k in range(FOLDS)]
        total = np.zeros((len(LIMITS), _BINS, 2))
        every = np.arange(len(LIMITS))
        for batch in batches:
            rows = zip(batch.column("label").to_pylist(), batch.column("fold").to_pylist(), batch.column("found").to_pylist())
            for label, fold, found in rows:
                hashes = np.frombuffer(found, np.uint64)
                own = np.searchsorted(keys, hashes)
                own = own[keys.take(own, mode="clip") == hashes] if len(keys) else own[:0]
                total[every, _bin(weights[fold][own].sum(axis=0)), label] += 1
        yield from blocks_of(total.ravel(), _BLOCK)

    return run


# --- model ---------------------------------------------------------------------------------------------


@dataclass
class ToxicityModel:
    characters: np.ndarray
    weights: Weights
    curve: np.ndarray

    def score(self, evidence: np.ndarray) -> np.ndarray:
        """Calibrated probability; a small rising part keeps apart what the steps hold equal."""
        step = self.curve[_bin(evidence)]
        if not len(self.weights.features):
            return step
        return np.clip(0.999 * step + 0.0005 * (1 + evidence / (1 + np.abs(evidence))), 0.0, 1.0)


def _bin(evidence: np.ndarray) -> np.ndarray:
    """A quarter of log odds a bin; no evidence is in the middle."""
    return np.clip(np.floor(evidence * 4).astype(np.int64) + _BINS // 2, 0, _BINS - 1)


def _best_limits(bins: np.ndarray) -> int:
    """The limits whose calibrated scores have the least log loss on rows left out; ties to the first."""
    losses = []
    for negative, positive in zip(bins[:, :, 0], bins[:, :, 1]):
        p = np.clip(pooled(positive, positive + negative), 0.001, 0.999)
        losses.append(-(positive * np.log(p) + negative * np.log(1 - p)).sum())
    return int(np.argmin(losses))


def labelled_sample(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled rows ``doc_id, label``, chosen by a hash of the id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = known.count()
    draw = F.xxhash64("doc_id", F.lit(9))
    if n > max_rows:
        known = known.where(F.pmod(draw, F.lit(1_000_000)) < math.ceil(1_200_000 * max_rows / n))
    return known.orderBy(draw, "doc_id").limit(max_rows)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_features: int = 20_000) -> ToxicityModel:
    """Character model over all ``docs``; weights from at most ``max_rows`` labelled rows of ``labels``.

    Weights are shrunken log odds of both signs, learned four times with a quarter of the rows left out. The
    rows left out choose which limits features must pass, and give the calibration, together with one clean row
    without evidence; the weights that are kept come from all rows. ``labels (doc_id, toxic)`` should only hold rows that may be learned from; rows with
    another label than 0 or 1 are left out, and an id labelled twice counts as toxic if one of them says so.
    Without rows of both kinds every text scores the rate of the rows there are (0 without rows).
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    characters = character_model(docs)
    sent = spark.sparkContext.broadcast({"characters": characters})
    # The sample is bounded by max_rows, so it may be broadcast.
    sample = labelled_sample(labels, "toxic", max_rows)
    rows = docs.join(F.broadcast(sample), "doc_id").select("text", "label", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(FOLDS)).cast("int").alias("fold"))
    learned = staged(rows.mapInArrow(_found(sent), "label int, fold int, found binary"), "found")
    n = np.zeros((FOLDS, 2))
    for r in learned.groupBy("fold", "label").count().collect():
        n[r["fold"], r["label"]] = r["count"]
    if not n.sum(axis=0).all():
        return ToxicityModel(characters, Weights(np.zeros(0, np.uint64), np.zeros(0)), np.full(_BINS, n[:, 1].sum() / max(n.sum(), 1.0)))
    counts = learned.select("label", "fold", "found").mapInArrow(_count_features, "feature long, " + ", ".join(f"{c} long" for c in COUNTS))
    keys, odds, gain = _candidates(counts, n, max_features)
    # Plain arrays, so that executors need not have this package to read them.
    told = spark.sparkContext.broadcast((keys, odds, gain))
    bins = summed_blocks(learned.mapInArrow(_left_out_bins(told), "block int, sums binary"), len(LIMITS) * _BINS * 2).reshape(len(LIMITS), _BINS, 2)
    # A text that nothing speaks against is held to be clean, as one more row would be, so that a gap
    # between the evidence of clean and toxic rows does not reach over the texts without evidence.
    bins[:, _BINS // 2, 0] += 1
    best = _best_limits(bins)
    weights = _limited(odds[:, FOLDS], gain[:, FOLDS])[:, best]
    used = weights != 0
    return ToxicityModel(characters, Weights(keys[used], weights[used]), pooled(bins[best, :, 1], bins[best].sum(axis=1)))


def _sent(spark: SparkSession, model: ToxicityModel) -> Broadcast:
    """The model as plain arrays."""
    return spark.sparkContext.broadcast(
        {"characters": model.characters, "features": model.weights.features, "weights": model.weights.weights, "curve": model.curve}
    )


def _received(sent) -> ToxicityModel:
    known = sent.value
    return ToxicityModel(known["characters"], Weights(known["features"], known["weights"]), known["curve"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs (doc_id, text, ...)``.

    Whole texts are read. A null text is an empty one; an empty text has no evidence and gets the score of
    that. Repeated rows give repeated results, a null doc_id stays null, and other columns are ignored.
    """
    small_batches(docs.sparkSession)
    sent = _sent(docs.sparkSession, model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, decoder = _received(sent), _decoder(sent)
        for batch in batches:
            for part in slices(batch):
                value = own.score(own.weights.evidence(*_all_features(part, decoder), part.num_rows))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(value), pa.array((value >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double, predicted int")


def reject_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns, in one pass over them."""
    small_batches(docs.sparkSession)
    sent = _sent(docs.sparkSession, model)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, decoder = _received(sent), _decoder(sent)
        for batch in batches:
            for part in slices(batch):
                value = own.score(own.weights.evidence(*_all_features(part, decoder), part.num_rows))
                yield part.filter(pa.array(value < threshold))

    return docs.mapInArrow(keep, docs.schema)


by_value(__name__)
