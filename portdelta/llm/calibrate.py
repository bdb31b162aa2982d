"""Isotonic calibration from counted bins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pooled(positive: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the rising step function closest to the rates of the bins.

    An empty bin lies on the line between the bins around it that have rows; without any row all values are 0.
    """
    full = np.flatnonzero(count)
    if not len(full):
        return np.zeros(len(count))
    blocks: list[list[float]] = []
    for p, n in zip(positive[full], count[full]):
        blocks.append([float(p), float(n), 1])
        while len(blocks) > 1 and _rate(blocks[-2]) >= _rate(blocks[-1]):
            p2, n2, k2 = blocks.pop()
            blocks[-1][0] += p2
            blocks[-1][1] += n2
            blocks[-1][2] += k2
    steps = np.concatenate([np.full(int(k), _rate([p, n, k])) for p, n, k in blocks])
    return np.interp(np.arange(len(count)), full, steps)


def _rate(block: list[float]) -> float:
    return block[0] / block[1]


def binned(scored: DataFrame, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``label`` and rows per ``bin``; no more than ``bins`` rows reach the driver."""
    positive, count = np.zeros(bins), np.zeros(bins)
    for r in scored.groupBy("bin").agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n")).collect():
        positive[r["bin"]], count[r["bin"]] = r["p"], r["n"]
    return positive, count
