"""Near duplicates by b-bit MinHash (operator 7).

Texts with equal shingle sets are one class. Of each class representative, 128 minima are taken: bands of
four give candidates, and the two low bits of each minimum, packed in four longs, give the estimated
similarity. Bits agree by chance in a quarter of the places, so the estimate is corrected for that;
candidates far below the threshold go, the rest are confirmed on their full sets.

A band's bucket is not expanded into pairs. Its members are held against a few of them that share most
buckets with others; what is confirmed is joined into components. A pair of one bucket that is still in
two components has a member outside the bucket's largest one. These members are looked up among all members
of such buckets by their rarest shingles: a partner must have one of them, and the place of the first one it
has bounds what both can share. So every candidate pair is confirmed, refused, or inside one component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portdelta.llm.components import components
from portdelta.llm.staging import small_batches, staged
from portdelta.llm.text import buffers, mixed, sets_of, shingle_sets, slices, words
from portdelta.ship import by_value

MINIMA, PER_BAND, LOW_BITS = 128, 4, 2
_CENTRES = 4
_PER_LONG = 64 // LOW_BITS
_DRAW = np.random.Generator(np.random.PCG64(85))
_MULTIPLY = _DRAW.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _DRAW.integers(0, 2**64, MINIMA, dtype=np.uint64)
_SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<long>, bits array<long>"


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of all hash functions, one row per non-empty set."""
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    every = np.concatenate(sets)
    out = np.empty((len(sets), MINIMA), np.uint64)
    for k in range(MINIMA):
        out[:, k] = np.minimum.reduceat(every * _MULTIPLY[k] + _ADD[k], at)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """One key per band of minima; the band's number is part of it."""
    n_bands = MINIMA // PER_BAND
    total = np.tile(np.arange(1, n_bands + 1, dtype=np.uint64), (len(low), 1))
    for j in range(PER_BAND):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + low[:, j::PER_BAND])
    return total.view(np.int64)


def packed_bits(low: np.ndarray) -> np.ndarray:
    bits = (low >> np.uint64(40)) & np.uint64(2**LOW_BITS - 1)
    shift = (np.arange(MINIMA, dtype=np.uint64) % np.uint64(_PER_LONG)) * np.uint64(LOW_BITS)
    return (bits << shift).reshape(len(low), MINIMA // _PER_LONG, _PER_LONG).sum(axis=2, dtype=np.uint64).view(np.int64)


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets = shingle_sets(words(*buffers(part.column("text"))))
            full = [i for i, s in enumerate(sets) if len(s)]
            low = minima([sets[i] for i in full]) if full else np.zeros((0, MINIMA), np.uint64)
            keys, bits, at = band_keys(low), packed_bits(low), {d: n for n, d in enumerate(full)}
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([keys[at[i]] if i in at else None for i in range(len(sets))], pa.list_(pa.int64())),
                    pa.array([bits[at[i]] if i in at else None for i in range(len(sets))], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_key", "bands", "bits"],
            )


def estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from two packed signatures, corrected for bits that agree by chance."""
    low = F.lit(0x5555555555555555)
    unlike = None
    for w in range(MINIMA // _PER_LONG):
        x = F.get(a, F.lit(w)).bitwiseXOR(F.get(b, F.lit(w)))
        n = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(low))
        unlike = n if unlike is None else unlike + n
    chance = 2.0**-LOW_BITS
    return ((1 - unlike / F.lit(float(MINIMA))) - chance) / (1 - chance)


def _confirmed(percent: int):
    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] | None = None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            at = 0
            for part in slices(batch, "text_b"):
                for i, sb in enumerate(sets_of(part.column("text_b"))):
                    text = part.column("text_a")[i].as_py()
                    if last is None or last[0] != text:
                        last = (text, sets_of(pa.array([text], pa.string()))[0])
                    both = len(np.intersect1d(last[1], sb, assume_unique=True))
                    keep[at] = both > 0 and 100 * both >= percent * (len(last[1]) + len(sb) - both)
                    at += 1
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return check


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar on full sets. Texts of ids outside the pairs are left behind first."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = staged(docs.join(ids, "doc_id", "left_semi"), "texts")
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return staged(with_both.select("a", "b", "text_a", "text_b").mapInArrow(_confirmed(percent), "a long, b long"), "links")


def _likely(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs whose estimate is not six deviations below the threshold."""
    t = percent / 100
    agree = t + (1 - t) / 2**LOW_BITS
    slack = 6 * (agree * (1 - agree) / MINIMA) ** 0.5 / (1 - 2.0**-LOW_BITS)
    joined = pairs.join(bits.select(F.col("rep").alias("a"), F.col("bits").alias("bits_a")), "a").join(
        bits.select(F.col("rep").alias("b"), F.col("bits").alias("bits_b")), "b"
    )
    return joined.where(estimate(F.col("bits_a"), F.col("bits_b")) >= t - slack).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs (doc_id, text, ...)``.

    Two texts are linked if ``100 * common shingles >= percent * all shingles``; a component is what links
    reach, named by its smallest doc_id, and that document is kept. A text without words (or null) is
    linked with nothing. A row without doc_id takes no part: no component, kept. Rows that repeat a doc_id
    are one document: they share its component and decision. Columns beyond the two are ignored, so they
    may have any name. The result of an empty table is empty.

    The chance that 32 bands of four minima all miss a pair is 5e-11 at 0.85 and 5e-8 at 0.80.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = staged(docs.mapInArrow(_sketches, _SKETCH), "sketches")
    some = sketch.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = some.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    reps = some.join(classes.select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"], "left_semi").dropDuplicates(["doc_id"])
    bits = reps.select(F.col("doc_id").alias("rep"), "bits")
    rows = reps.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("bucket"))
    crowded = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(rows.join(crowded, "bucket"), "shared")
    degree = shared.groupBy("rep").agg(F.sum("n").alias("degree"))
    ranked = shared.join(degree, "rep")
    # Several members that share most buckets with others, in slightly different orders of preference.
    places = [F.max(F.struct(F.col("degree") * (1 + 0.02 * j * F.pmod(F.xxhash64("rep", F.lit(j)), F.lit(16))), "rep")) for j in range(_CENTRES)]
    centres = ranked.groupBy("bucket").agg(F.array_distinct(F.array(*[p["rep"] for p in places])).alias("centres"))
    buckets = staged(ranked.select("bucket", "rep"), "buckets")
    star = buckets.join(centres, "bucket").select("rep", F.explode("centres").alias("centre")).where("rep <> centre")
    star = star.select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b")).distinct()
    links = _confirm(staged(_likely(star, bits, percent), "pairs"), docs, percent)
    found = staged(components(links), "components")
    links = links.union(_across(buckets, found, docs, bits, percent))
    found = staged(components(links), "components")
    members = sketch.join(classes, "set_key", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return members.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _postings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets = sets_of(part.column("text"))
            size = np.array([len(s) for s in sets], np.int64)
            at = pa.array(np.repeat(np.arange(len(sets)), size))
            every = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("rep").take(at), part.column("component").take(at), part.column("lone").take(at), pa.array(np.repeat(size, size)), pa.array(every)],
                names=["rep", "component", "lone", "n", "shingle"],
            )


def _across(buckets: DataFrame, found: DataFrame, docs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Links between components that have a bucket in common.

    Texts of a bucket's smaller components look for partners by their rarest shingles, among the rarest of all
    others. If a text of ``n`` shingles has none of the first ``i`` in common with one of ``m``, they share
    ``n - i`` at most, and that must be ``percent * (n + m) / (100 + percent)`` or more; likewise for the other.
    """
    labelled = buckets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    mixed_up = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    open_rows = staged(labelled.join(mixed_up.select("bucket"), "bucket", "left_semi"), "open")
    sizes = open_rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    members = open_rows.join(largest, "bucket").groupBy("rep", "component").agg(F.max(F.col("component") != F.col("largest")).alias("lone"))
    texts = members.join(docs.select(F.col("doc_id").alias("rep"), "text"), "rep").select("rep", "component", "lone", "text")
    postings = staged(texts.mapInArrow(_postings, "rep long, component long, lone boolean, n long, shingle long"), "postings")
    often = postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    rarest = Window.partitionBy("rep").orderBy("often", "shingle")
    # In the one order of all shingles, similar texts meet within the first places of both.
    ranked = postings.join(often, "shingle").withColumn("i", F.row_number().over(rarest) - 1)
    prefixes = staged(ranked.where(f"100 * i <= {100 - percent} * n AND often > 1").drop("often"), "prefixes")
    looked_up = prefixes.where("lone").select(F.col("rep").alias("x"), F.col("component").alias("own"), F.col("n").alias("n_x"), F.col("i").alias("i_x"), "shingle")
    # The first shingle in common has i_x and i before it on either side; what both can share is what is left.
    bound = f"{100 + percent} * least(n_x - i_x, n - i) >= {percent} * (n_x + n)"
    near = looked_up.join(prefixes, "shingle").where(f"component <> own AND {bound}")
    pairs = near.select(F.least("x", "rep").alias("a"), F.greatest("x", "rep").alias("b")).distinct()
    return _confirm(staged(_likely(pairs, bits, percent), "pairs"), docs, percent)


by_value(__name__)
