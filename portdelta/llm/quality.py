"""Document quality by random Fourier features (operator 4).

Statistics of a document's characters, words and lines are mapped to cosines of random directions, whose
products approximate a Gaussian kernel. Ridge regression on them needs only sums over rows: each task adds
up its own normal equations. Isotonic calibration on rows kept apart turns the scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portdelta.llm.calibrate import binned, pooled
from portdelta.llm.staging import blocks_of, small_batches, staged, summed_blocks
from portdelta.llm.text import LINE_ENDS, Words, buffers, runs, slices, words
from portdelta.ship import by_value

_BINS, _LOW, _HIGH = 400, -0.5, 1.5
_BLOCK = 8192
_SIGNS = "!*%&$#|"

_byte = np.arange(256)
_UPPER = (_byte >= 65) & (_byte <= 90)
_LOWER = (_byte >= 97) & (_byte <= 122)
_DIGIT = (_byte >= 48) & (_byte <= 57)
_BEYOND = _byte >= 128
_SPACE = np.isin(_byte, [0x20, 9, 10, 11, 12, 13])
_PUNCTUATION = (_byte > 32) & (_byte < 127) & ~_UPPER & ~_LOWER & ~_DIGIT
_END = np.isin(_byte, [ord(c) for c in ".!?:;\"')"])
_CLASSES = [_UPPER, _DIGIT, _BEYOND, _SPACE, _PUNCTUATION, *[_byte == ord(c) for c in _SIGNS], _byte == 10]

STATISTICS = (
    ["log_bytes", "log_words", "log_lines"]
    + ["share_upper", "share_digit", "share_beyond_ascii", "share_space", "share_punctuation"]
    + [f"share_sign_{i}" for i in range(len(_SIGNS))]
    + ["share_line_ends", "mean_word", "spread_word", "log_longest_word", "share_short_words", "share_capital_words", "share_odd_word_ends"]
    + ["distinct_words", "distinct_runs", "distinct_lines", "mean_line_words", "share_ended_lines"]
)


def _means(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    n = np.diff(first)
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)


def _distinct(h: np.ndarray, first: np.ndarray, cut: int = 0) -> np.ndarray:
    """Share of distinct values among each text's; 1 where there is none."""
    out = np.ones(len(first) - 1)
    for i in range(len(out)):
        own = h[first[i] : max(first[i], first[i + 1] - cut)]
        if len(own):
            out[i] = len(np.unique(own)) / len(own)
    return out


def statistics(texts: pa.Array) -> np.ndarray:
    """One row per text, one column per name of ``STATISTICS``; an empty text has ordinary finite values."""
    data, offsets = buffers(texts)
    w: Words = words(data, offsets)
    lines: Words = words(data, offsets, blanks=LINE_ENDS)
    sizes = np.diff(offsets)
    shares = [_means(c[data], offsets) for c in _CLASSES]
    length = (w.ends - w.starts).astype(float)
    mean = _means(length, w.first)
    spread = np.sqrt(np.maximum(_means(length * length, w.first) - mean * mean, 0))
    longest = np.array([length[a:b].max() if b > a else 0.0 for a, b in zip(w.first[:-1], w.first[1:])])
    n_words, n_lines = np.diff(w.first), np.diff(lines.first)
    last = data[w.ends - 1] if len(w.ends) else data[:0]
    odd_end = _PUNCTUATION[last] & ~np.isin(last, [ord(c) for c in ".,"])
    columns = [
        np.log1p(sizes),
        np.log1p(n_words),
        np.log1p(n_lines),
        *shares,
        mean,
        spread,
        np.log1p(longest),
        _means(length <= 3, w.first),
        _means(_UPPER[data[w.starts]], w.first),
        _means(odd_end, w.first),
        _distinct(w.hashes, w.first),
        _distinct(runs(w.hashes, 3), np.minimum(w.first, max(0, len(w.hashes) - 2)), 2),
        _distinct(lines.hashes, lines.first),
        n_words / np.maximum(n_lines, 1),
        _means(_END[data[lines.ends - 1]] if len(lines.ends) else lines.ends, lines.first),
    ]
    return np.column_stack(columns).astype(float)


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            rows = pa.array(list(statistics(part.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), rows], names=["doc_id", "x"])


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` with the statistics of every row, kept in the shared folder."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return staged(rows.mapInArrow(_described, "doc_id long, x array<double>"), "statistics")


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    curve: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        z = np.clip((x - self.centre) / self.scale, -8, 8) @ self.directions + self.phases
        return np.column_stack([np.sqrt(2 / len(self.phases)) * np.cos(z), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a small rising part keeps apart what the steps hold equal."""
        raw = self.raw(x)
        return np.clip(0.999 * self.curve[_bin(raw)] + 0.001 * np.clip((raw - _LOW) / (_HIGH - _LOW), 0, 1), 0.0, 1.0)

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.centre, self.scale, self.directions, self.phases, self.weights, self.curve


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip((raw - _LOW) / (_HIGH - _LOW) * _BINS, 0, _BINS - 1).astype(np.int32)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("x").to_pylist(), dtype=float).reshape(batch.num_rows, len(STATISTICS))


def _normal_equations(sent):
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = QualityModel(*sent.value)
        size = len(model.phases) + 1
        total = np.zeros(size * (size + 1))
        for batch in batches:
            if batch.num_rows:
                z, y = model.features(_rows(batch)), batch.column("label").to_numpy().astype(float)
                total += np.concatenate([(z.T @ z).reshape(-1), z.T @ y])
        yield from blocks_of(total, _BLOCK)

    return add


def _binned(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = QualityModel(*sent.value)
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_bin(model.raw(_rows(batch)))), batch.column("label")], names=["bin", "label"])

    return run


def fit_quality(described: DataFrame, labels: DataFrame, n_features: int = 256, ridge: float = 1e-3, seed: int = 4) -> QualityModel:
    """Model of ``labels (doc_id, quality)`` over ``describe(docs)``.

    All labelled rows count: three quarters give the weights, the others the calibration. ``labels`` should
    only hold rows that may be learned from; other labels than 0 and 1 are left out, an id labelled twice
    has quality 1 if one of them says so. Without rows of both kinds every text scores their rate (0
    without rows). What passes through the driver has the size of the model.
    """
    spark = described.sparkSession
    n = len(STATISTICS)
    about = described.select(*[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(n)], *[F.stddev_pop(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(n)]).first()
    centre = np.array([about[f"m{i}"] or 0.0 for i in range(n)])
    scale = np.array([max(about[f"s{i}"] or 0.0, 1e-6) for i in range(n)])
    draw = np.random.Generator(np.random.PCG64(seed))
    directions = draw.normal(0, 1 / np.sqrt(n), (n, n_features))
    phases = draw.uniform(0, 2 * np.pi, n_features)
    model = QualityModel(centre, scale, directions, phases, np.zeros(n_features + 1), np.zeros(_BINS))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = described.join(known, "doc_id").select("x", "label", (F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(4)) == 0).alias("later"))
    size = n_features + 1
    parts = rows.where("NOT later").select("x", "label").mapInArrow(_normal_equations(spark.sparkContext.broadcast(model.parts())), "block int, sums binary")
    sums = summed_blocks(parts, size * (size + 1))
    a, b = sums[: size * size].reshape(size, size), sums[size * size :]
    count, positive = a[-1, -1], b[-1]
    if 0 < positive < count:
        model.weights = np.linalg.solve(a + ridge * np.eye(size), b)
    bins = binned(rows.where("later").select("x", "label").mapInArrow(_binned(spark.sparkContext.broadcast(model.parts())), "bin int, label int"), _BINS)
    if bins[1].sum():
        model.curve = pooled(*bins)
    elif count:
        model.curve = np.full(_BINS, positive / count)
    return model


def score_quality(described: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``describe(docs)``.

    Whole texts count. A null text is an empty one, which has statistics like any other and gets a score.
    Repeated rows give repeated results, a null doc_id stays null. Columns of ``docs`` beyond ``doc_id`` and
    ``text`` are ignored. An empty table gives an empty result.
    """
    sent = described.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(*sent.value)
        for batch in batches:
            score = own.score(_rows(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return described.mapInArrow(run, "doc_id long, score double, predicted int")


by_value(__name__)
