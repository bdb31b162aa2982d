"""Mixing sources to target weights by Pfair scheduling (operator 5).

Time is counted in slots, one block of documents each. Block ``j`` of a source with weight ``w`` may not
run before ``floor((j - 1) / w)`` and must have run by ``ceil(j / w)``; of the blocks that may run, the one
with the earliest deadline does. With weights that sum to one this meets every deadline, so at any slot a
source has had its weight's share of the slots to within less than one block.

Weights are exact: whole numbers ``p`` out of ``P``, their sum. After ``P`` slots the schedule begins anew, so
one task works out the first ``P`` slots, or the blocks there are if these are fewer, and Spark works out
each document's block and slot from them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portdelta.llm.staging import staged
from portdelta.ship import by_value

_TURN = "mix_source string, j long, share long, period long, release long, deadline long, slot long, full_end long"


def whole_weights(counts: Mapping[str, int], weights: Mapping[str, float] | None) -> dict[str, int]:
    """Smallest whole numbers in the ratio of the target weights.

    A number means what is written: 0.1 is one tenth. A source without a weight gets the whole part of the
    square root of its count.
    """
    given = weights or {}
    exact = {s: Fraction(str(given[s])) if s in given else Fraction(math.isqrt(n)) for s, n in counts.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("target weights must be above zero")
    below = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * below) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    return {s: p // common for s, p in whole.items()}


def earliest_deadlines(shares: Mapping[str, int], blocks: Mapping[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """``source, j, release, deadline, slot`` of the first ``blocks`` blocks of each source, in the order of slots.

    ``shares`` are whole weights; their sum is what one is. Ties go by name. Holds two entries a source.
    """
    one = sum(shares.values())
    waiting = [(0, s, 1) for s in sorted(shares) if blocks[s]]
    ready: list[tuple[int, str, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * one // shares[s]), s, j, release))
        deadline, s, j, release = heapq.heappop(ready)
        yield s, j, release, deadline, slot
        if j < blocks[s]:
            heapq.heappush(waiting, (j * one // shares[s], s, j + 1))
        slot += 1


def _turn(weights: Mapping[str, float] | None, block_docs: int):
    names = [c.split()[0] for c in _TURN.split(", ")]
    kinds = [pa.string()] + [pa.int64()] * (len(names) - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {r["mix_source"]: r["n"] for batch in batches for r in batch.to_pylist()}
        if not counts:
            return
        shares, blocks = whole_weights(counts, weights), {s: -(-n // block_docs) for s, n in counts.items()}
        one = sum(shares.values())
        end = min(blocks[s] * one // shares[s] for s in shares)
        # Whole turns, or every block once if a turn is longer than that.
        size = shares if one <= sum(blocks.values()) else blocks
        plan = earliest_deadlines(shares, size)
        while part := list(islice(plan, 1 << 15)):
            rows = [(s, j, size[s], one, release, deadline, slot, end) for s, j, release, deadline, slot in part]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, block_docs: int = 16) -> DataFrame:
    """``docs`` with ``mix_source, mix_block, mix_release, mix_deadline, mix_slot, mix_place, mix_full``.

    ``docs`` needs ``doc_id`` and ``source``; other columns stay, whatever their names (a column named like
    one of the seven is replaced). ``weights`` maps sources to target weights above zero; sources it lacks, or
    all if it is None, get the whole part of the square root of their number of documents, on the scale of the
    others' counts. A null source is the source ``""``.

    Within a source, documents come in the order of a hash of ``doc_id`` (a null id first; repeated ids by a
    hash of the row), ``block_docs`` to a block. Every document has a place and none is repeated: sorted by
    ``mix_slot, mix_place`` they are the mix. Up to the slot at which the first source has run out, none is a
    block or more from its target weight, and ``mix_full`` is true; later the slots of sources that have run
    out stay empty and the others keep their proportions. An empty table gives an empty result.

    Ranks within a source are counted in 1024 buckets of the hash with offsets from their sizes, so a source
    with most of the rows is no single group. The counts, one row a source, go to one task, which holds two
    entries a source and gives the slots of one turn row by row. With weights from square roots a turn of
    ``s`` sources and ``n`` documents has at most ``sqrt(s * n)`` slots.
    """
    own = ["mix_source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_place", "mix_full"]
    docs = docs.drop(*own)
    # The caller's columns are one struct, so that no helper column can clash with them.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    draw = F.when(F.col("doc_id").isNull(), F.lit(-(2**63))).otherwise(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)))
    keyed = docs.select(row.alias("row"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("mix_source"), draw.alias("draw"))
    keyed = keyed.withColumn("bucket", F.shiftrightunsigned(F.col("draw").bitwiseXOR(F.lit(-(2**63))), 54).cast("int"))
    sizes = keyed.groupBy("mix_source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    turn = sizes.groupBy("mix_source").agg(F.sum("n").alias("n")).repartition(1).mapInArrow(_turn(weights, block_docs), _TURN)
    turn = staged(turn, "turn")
    share = turn.where("j = 1").select("mix_source", "share")
    before = Window.partitionBy("mix_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("mix_source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).join(share, "mix_source")
    inside = Window.partitionBy("mix_source", "bucket").orderBy("draw", F.col("row")["doc_id"], F.xxhash64("row"))
    placed = keyed.withColumn("rank", F.row_number().over(inside)).join(offsets, ["mix_source", "bucket"])
    placed = placed.withColumn("at", F.col("before") + F.col("rank") - 1).withColumn("mix_block", F.floor(F.col("at") / block_docs) + 1)
    placed = placed.withColumn("j", F.pmod(F.col("mix_block") - 1, F.col("share")) + 1).join(turn.drop("share"), ["mix_source", "j"])
    start = F.floor((F.col("mix_block") - 1) / F.col("share")) * F.col("period")
    return placed.select(
        *[F.col("row")[c].alias(c) for c in docs.columns],
        "mix_source",
        "mix_block",
        (start + F.col("release")).alias("mix_release"),
        (start + F.col("deadline")).alias("mix_deadline"),
        (start + F.col("slot")).alias("mix_slot"),
        F.pmod(F.col("at"), F.lit(block_docs)).alias("mix_place"),
        (start + F.col("slot") < F.col("full_end")).alias("mix_full"),
    )


by_value(__name__)
