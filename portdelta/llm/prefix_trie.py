"""Prefix trie of conversations with subtree totals by time-forward processing (operator 11).

**Paths.** Turns are sorted once by conversation and place. A prefix is known by the XOR of two 64-bit hashes
of each of its turns and their places, so prefixes of one long conversation are computed in bands of its depth
and put together afterwards; no task needs a whole conversation. A node of the trie is a prefix; it is named
by its smallest member and its depth.

**Fragments.** With ``n`` rows, let ``size`` be the cube root of ``n``, 64 at least. The trie is cut above every
depth that ``size`` divides, around each node with more than ``size`` members, and below these. What stays
together has at most ``size`` members and ``size`` levels; at most ``2 n / size`` fragments have others below them.

**Totals.** The nodes of whole fragments form a shard, sorted externally by reverse level order. Each node
takes what its children sent from a priority queue, adds its own and sends the total to its parent; the queue
goes to disk in sorted runs when it is long. The first pass gives each fragment's own total. The same pass over
the roots of fragments that have others below them gives the totals across shards. In the second pass these
reach the nodes they hang from as messages, and every node comes out with its totals.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portdelta.llm.staging import kept_at, remove, small_batches, staged
from portdelta.ship import by_value

_LEAST_SIZE = 64
_IN_MEMORY = 1 << 18
_SHARES = 32
_IDS_OF_A_CHUNK = 4096
_NO_IDS = hashlib.sha256(b"").hexdigest()

Message = tuple[int, ...]


class SpillingQueue:
    """Priority queue of equally long tuples of integers; beyond ``most`` they go to disk as sorted runs.

    A run is a nameless file in the scratch folders that Spark gives its executors for spills, and ends with
    the task.
    """

    _READ = 4096

    def __init__(self, width: int, most: int = _IN_MEMORY) -> None:
        self.width, self.most = width, most
        self.heap: list[Message] = []
        self.heads: list[tuple[Message, int]] = []
        self.runs: list[Iterator[Message]] = []

    def _read(self, file) -> Iterator[Message]:
        file.seek(0)
        while data := file.read(8 * self.width * self._READ):
            yield from map(tuple, np.frombuffer(data, "<i8").reshape(-1, self.width).tolist())
        file.close()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        self.heap.sort()
        for at in range(0, len(self.heap), self._READ):
            file.write(np.array(self.heap[at : at + self._READ], "<i8").tobytes())
        self.heap = []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    def _advance(self, run: int) -> None:
        head = next(self.runs[run], None)
        if head is not None:
            heapq.heappush(self.heads, (head, run))

    def push(self, message: Message) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.most:
            self._spill()

    def first(self) -> Message | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> Message:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, run = heapq.heappop(self.heads)
            self._advance(run)
            return message
        return heapq.heappop(self.heap)


def time_forward(nodes: Iterable[tuple], queue: SpillingQueue) -> Iterator[tuple[tuple, int, int, int]]:
    """Each node with its children, leaves and saved tokens.

    ``nodes`` come deepest first, larger names first: ``name, depth, parent, leaves, saved, children, sends``.
    A row without ``sends`` (null) is a message from elsewhere for the node of its name and depth, which follows;
    a node that ``sends`` hands its totals to ``parent``, one level up.
    """
    waiting = (0, 0, 0)
    for row in nodes:
        name, depth, parent, leaves, saved, children, sends = row
        if sends is None:
            waiting = (waiting[0] + leaves, waiting[1] + saved, waiting[2] + children)
            continue
        leaves, saved, children = leaves + waiting[0], saved + waiting[1], children + waiting[2]
        waiting = (0, 0, 0)
        while (head := queue.first()) is not None and head[0] == -depth and head[1] == -name:
            _, _, more_leaves, more_saved = queue.pop()
            leaves, saved, children = leaves + more_leaves, saved + more_saved, children + 1
        if sends:
            queue.push((1 - depth, -parent, leaves, saved))
        yield row, children, leaves, saved


_NODE = ["name", "depth", "parent", "leaves", "saved", "children", "sends"]


def _passed(columns: list[str], roots_only: bool):
    """Time-forward pass over sorted rows; ``columns`` are handed on with the totals."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra: list[dict] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                kept = batch.select([c for c in columns if c not in _NODE]).to_pylist()
                for values, more in zip(zip(*(batch.column(c).to_pylist() for c in _NODE)), kept):
                    extra[:] = [more]
                    yield values

        out: list[dict] = []
        for row, children, leaves, saved in time_forward(rows(), SpillingQueue(4)):
            if roots_only and row[6]:
                continue
            whole = dict(zip(_NODE, row)) | extra[0] | {"children": children, "leaves": leaves, "saved": saved}
            out.append({c: whole[c] for c in columns})
            if len(out) == 8192:
                yield pa.RecordBatch.from_pylist(out, schema=_schema(columns))
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=_schema(columns))

    return run


def _schema(columns: list[str]) -> pa.Schema:
    return pa.schema([(c, pa.int64()) for c in columns])


def _forward(nodes: DataFrame, columns: list[str], roots_only: bool = False) -> DataFrame:
    """The pass over each partition of ``nodes``; the sort is Spark's external one."""
    order = [F.desc("depth"), F.desc("name"), F.col("sends").isNotNull()]
    return nodes.sortWithinPartitions(*order).mapInArrow(_passed(columns, roots_only), ", ".join(f"{c} long" for c in columns))


def _slim(conversations: DataFrame) -> DataFrame:
    """What is needed of a turn: its place, what ties are ordered by, 128 bits of its digest, its words."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))

    def half(at: int) -> Column:
        return F.conv(F.substring("digest", at, 16), 16, -10).cast("long")

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        digest.alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("copy"),
    )
    return rows.where("conv IS NOT NULL").select("conv", "turn", "role", "head", half(1).alias("a"), half(17).alias("b"), "words", "copy")


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of each row among those of its conversation in this partition, from 1."""
    part = TaskContext.get().partitionId()
    last, n = None, 0
    for batch in batches:
        conv = batch.column("conv").to_numpy()
        if not len(conv):
            continue
        new = np.concatenate([[last is None or conv[0] != last], conv[1:] != conv[:-1]])
        at = np.arange(len(conv))
        start = np.maximum.accumulate(np.where(new, at, -1))
        number = np.where(start >= 0, at - start + 1, at + 1 + n)
        last, n = conv[-1], int(number[-1])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv", "a", "b", "words")), pa.array(number, pa.int64()), pa.array(np.full(len(conv), part), pa.int64())],
            names=["conv", "a", "b", "words", "number", "part"],
        )


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, str, int]:
    """``conv, pos, a, b, words``: places from 1 by turn (null first); also the staged path and the count of rows.

    Equal turns go by role, then by the first 64 characters of the text, then by digest. The sort spreads a
    long conversation over partitions; one row a partition says how many rows of its first one came before.
    """
    order = ["conv", "turn", "role", "head", "a", "b", "copy"]
    rows = _slim(conversations).repartitionByRange(*order).sortWithinPartitions(*order)
    rows, path = kept_at(rows.mapInArrow(_numbered, "conv long, a long, b long, words long, number long, part long"), "turns")
    edges = rows.groupBy("part").agg(F.min("conv").alias("lo"), F.max(F.struct("conv", "number")).alias("hi"), F.count(F.lit(1)).alias("n"))
    before, carried, total = [], (None, 0), 0
    for e in edges.orderBy("part").collect():  # one row a partition
        total += e["n"]
        ahead = carried[1] if e["lo"] == carried[0] else 0
        if ahead:
            before.append((e["part"], e["lo"], ahead))
        carried = (e["hi"]["conv"], e["hi"]["number"] + (ahead if e["hi"]["conv"] == e["lo"] else 0))
    ahead = rows.sparkSession.createDataFrame(before, "part long, conv long, ahead long")
    out = rows.join(F.broadcast(ahead), ["part", "conv"], "left")
    return out.select("conv", (F.col("number") + F.coalesce("ahead", F.lit(0))).alias("pos"), "a", "b", "words"), path, total


def rebuilt_turns(turns: DataFrame, family: int, most: int) -> DataFrame:
    """``conv, d, a, b, words``: every conversation with the head of its family's first one, from d = 0.

    Depth 0 has one row for each conversation, without a turn. The head has ``crc32(conv) % (most + 1)`` turns.
    """
    head = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most + 1))
    base = F.col("conv") - F.col("conv") % family
    convs = turns.groupBy("conv").agg(F.max("pos").alias("n")).withColumns({"h": head, "base": base})
    given = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(given, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    heads = turns.where((F.col("conv") % family == 0) & (F.col("pos") <= most)).withColumnRenamed("conv", "base")
    begun = convs.select("conv", "base", "m").join(heads, "base").where("pos <= m").select("conv", F.col("pos").alias("d"), "a", "b", "words")
    # Where the base has fewer turns than asked for, the own ones move up.
    shifted = convs.where("m < h AND n > h").select("conv", "m")
    own = turns.withColumn("h", head).where("pos > h").join(shifted, "conv", "left")
    own = own.select("conv", (F.coalesce("m", "h") + F.col("pos") - F.col("h")).alias("d"), "a", "b", "words")
    zero = F.lit(0).cast("long")
    return begun.union(own).union(convs.select("conv", zero, zero, zero, zero))


def prefix_paths(turns: DataFrame, size: int) -> DataFrame:
    """``conv, d, band, p1, p2, words, last`` for every prefix of every conversation; ``last`` marks the whole one."""
    place = Window.partitionBy("conv", "band").orderBy("d")
    sofar = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    none = F.lit(0).cast("long")
    terms = turns.select(
        "conv",
        "d",
        F.floor(F.col("d") / size).alias("band"),
        "words",
        F.when(F.col("d") == 0, none).otherwise(F.xxhash64("d", "a", "b")).alias("t1"),
        F.when(F.col("d") == 0, none).otherwise(F.xxhash64("b", "d", "a")).alias("t2"),
    )
    inner = terms.select(
        "conv", "d", "band", "words", F.bit_xor("t1").over(sofar).alias("x1"), F.bit_xor("t2").over(sofar).alias("x2"), F.lead("d").over(place).isNull().alias("edge")
    )
    full = inner.where(F.col("d") % size == size - 1)
    earlier = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = full.select("conv", (F.col("band") + 1).alias("band"), F.bit_xor("x1").over(earlier).alias("o1"), F.bit_xor("x2").over(earlier).alias("o2"))
    more = inner.where((F.col("d") % size == 0) & (F.col("d") > 0)).select("conv", (F.col("band") - 1).alias("band"), F.lit(True).alias("more"))
    out = inner.join(offsets, ["conv", "band"], "left").join(more, ["conv", "band"], "left")
    return out.select(
        "conv",
        "d",
        "band",
        F.col("x1").bitwiseXOR(F.coalesce("o1", none)).alias("p1"),
        F.col("x2").bitwiseXOR(F.coalesce("o2", none)).alias("p2"),
        "words",
        (F.col("edge") & F.col("more").isNull()).alias("last"),
    )


def with_nodes(paths: DataFrame) -> DataFrame:
    """Each row of ``paths`` with its node: smallest member, members, words, members that end there.

    Members of a node are dealt out by their ids; the node goes to the shares that have some, so the rows of a
    node that a third of all conversations pass, such as the root, do not meet in one task.
    """
    key = ["d", "p1", "p2"]
    dealt = paths.withColumn("share", F.pmod(F.xxhash64("conv"), F.lit(_SHARES)))
    known = dealt.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv").alias("rep"),
        F.max("words").alias("node_words"),
        F.count_if("last").alias("n_ends"),
        F.collect_set("share").alias("shares"),  # _SHARES values at most
    )
    known = known.select(*key, F.explode("shares").alias("share"), "n_convs", "rep", "node_words", "n_ends")
    return dealt.join(known, [*key, "share"]).select("conv", "d", "band", "rep", "n_convs", F.col("node_words").alias("words"), "n_ends", "last")


def _fragments(paths: DataFrame, size: int) -> DataFrame:
    """One row a node, with its parent, its fragment's root and the fragment of its parent."""
    place = Window.partitionBy("conv", "band").orderBy("d")
    crowded = F.col("n_convs") > size
    cut = (F.col("d") % size == 0) | crowded | (F.lag("n_convs").over(place) > size)
    root = F.max(F.when(F.coalesce(cut, F.lit(False)), F.struct("d", "rep")))
    rows = paths.withColumn("root", root.over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    up = F.struct("rep", F.col("root.rep").alias("frag_rep"), F.col("root.d").alias("frag_d"))
    rows = rows.withColumn("up", F.lag(up).over(place))
    ends = rows.where(F.col("d") % size == size - 1).select("conv", (F.col("band") + 1).alias("band"), F.lit(0).alias("at"), up.alias("beyond"))
    rows = rows.where("conv = rep").withColumn("at", (F.col("d") % size).cast("int")).join(ends, ["conv", "band", "at"], "left")
    up = F.coalesce("up", "beyond")
    return rows.select(
        F.col("rep").alias("name"),
        F.col("d").alias("depth"),
        up["rep"].alias("parent"),
        F.col("root.rep").alias("frag"),
        F.col("root.d").alias("frag_depth"),
        up["frag_rep"].alias("up_frag"),
        up["frag_d"].alias("up_frag_depth"),
        "n_convs",
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        F.lit(0).cast("long").alias("children"),
        ((F.col("rep") != F.col("root.rep")) | (F.col("d") != F.col("root.d"))).cast("long").alias("sends"),
    )


_FRAGMENT = ["name", "depth", "parent", "up_frag", "up_frag_depth", "leaves", "saved"]


def _across(nodes: DataFrame) -> DataFrame:
    """What fragments send to the nodes they hang from: messages for the second pass."""
    own = staged(_forward(nodes.repartition("frag", "frag_depth"), _FRAGMENT, roots_only=True), "fragments")
    hung = own.where("parent IS NOT NULL")
    above = hung.select(F.col("up_frag").alias("name"), F.col("up_frag_depth").alias("depth")).distinct()
    inner = own.join(above, ["name", "depth"], "left_semi")
    outer = hung.join(above, ["name", "depth"], "left_anti")
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count(F.lit(1)).alias("children")]
    # Fragments with nothing below are added up; those between are a tree of 2 n / size nodes at most.
    added = outer.groupBy(F.col("up_frag").alias("name"), F.col("up_frag_depth").alias("depth")).agg(*sums)
    roots = inner.select("name", "depth", "parent", "up_frag", "up_frag_depth", "leaves", "saved").unionByName(
        added.drop("children").withColumns({c: F.lit(None).cast("long") for c in ("parent", "up_frag", "up_frag_depth")}).withColumn("added", F.lit(True)),
        allowMissingColumns=True,
    )
    totals = _between(roots)
    sent = outer.unionByName(totals.where("parent IS NOT NULL"))
    by = [F.col("up_frag").alias("frag"), F.col("up_frag_depth").alias("frag_depth"), F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth")]
    return sent.groupBy(*by).agg(*sums)


def _between(roots: DataFrame) -> DataFrame:
    """Totals of the fragments that have others below: the same pass over their tree, whose edges skip levels."""
    order = [F.desc("depth"), F.desc("name"), F.col("added").isNull()]
    return roots.repartition(1).sortWithinPartitions(*order).mapInArrow(_between_pass, ", ".join(f"{c} long" for c in _FRAGMENT))


def _between_pass(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    queue, waiting = SpillingQueue(4), (0, 0)
    for batch in batches:
        out: list[tuple] = []
        for name, depth, parent, up, up_depth, leaves, saved, added in zip(*(batch.column(c).to_pylist() for c in [*_FRAGMENT, "added"])):
            if added:
                waiting = (leaves, saved)
                continue
            leaves, saved = leaves + waiting[0], saved + waiting[1]
            waiting = (0, 0)
            while (head := queue.first()) is not None and head[0] == -depth and head[1] == -name:
                _, _, more_leaves, more_saved = queue.pop()
                leaves, saved = leaves + more_leaves, saved + more_saved
            if up is not None:
                queue.push((-up_depth, -up, leaves, saved))
            out.append((name, depth, parent, up, up_depth, leaves, saved))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * len(_FRAGMENT))], schema=_schema(_FRAGMENT))


def _id_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's sorted ids as text of up to ``_IDS_OF_A_CHUNK`` ids."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rep, d, conv = (batch.column(c).to_numpy() for c in ("rep", "d", "conv"))
        starts = np.flatnonzero(np.concatenate([[True], (rep[1:] != rep[:-1]) | (d[1:] != d[:-1])]))
        cuts = [a for s, e in zip(starts, np.append(starts[1:], len(rep))) for a in range(s, e, _IDS_OF_A_CHUNK)]
        ids = conv.tolist()
        texts = [",".join(map(str, ids[a:b])) for a, b in zip(cuts, [*cuts[1:], len(ids)])]
        at = pa.array(cuts, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(at) for c in ("rep", "d", "conv")), pa.array(texts, pa.string())], names=["rep", "d", "first", "ids"]
        )


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, chunk after chunk; rows come sorted by node and first id."""
    schema = pa.schema([("rep", pa.int64()), ("d", pa.int64()), ("ends_sha256", pa.string())])
    node, state = None, None
    for batch in batches:
        out: list[tuple] = []
        for rep, d, ids in zip(*(batch.column(c).to_pylist() for c in ("rep", "d", "ids"))):
            if (rep, d) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (rep, d), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, state.hexdigest())], schema=schema)


def prefix_trie(conversations: DataFrame, family: int = 20, most: int = 3, size: int | None = None) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``, one row a node.

    ``conversations (conv_id, turn, role, text, ...)`` are ordered by turn, null first; equal turns go by role,
    then by the first 64 characters of the text, then by its digest, and repeated rows are turns of their own. A
    null role or text is an empty one. Rows without conv_id take no part. Each conversation starts with the
    first ``crc32(conv_id) % (most + 1)`` turns of that whose id is the next lower multiple of ``family`` (for
    negative ids, the next one towards zero), and goes on with its own beyond that many. Other columns are
    ignored, so they may have any name. An empty table has no node, not even a root. ``size`` bounds the members
    and levels of a fragment; by default it is the cube root of the number of turns, 64 at least.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    turns, turns_path, n = numbered_turns(conversations.select("conv_id", "turn", "role", "text"))
    size = size or max(_LEAST_SIZE, int(np.ceil(n ** (1 / 3))))
    paths, paths_path = kept_at(prefix_paths(rebuilt_turns(turns, family, most), size), "paths")
    remove(spark, turns_path)
    named, named_path = kept_at(with_nodes(paths), "named-paths")
    remove(spark, paths_path)
    nodes = staged(_fragments(named, size), "nodes")
    ends = named.where("last").select("rep", "d", "conv").repartitionByRange("rep", "d", "conv").sortWithinPartitions("rep", "d", "conv")
    chunks = ends.mapInArrow(_id_chunks, "rep long, d long, first long, ids string")
    chunks = chunks.repartition("rep", "d").sortWithinPartitions("rep", "d", "first")
    digests = staged(chunks.mapInArrow(_digests, "rep long, d long, ends_sha256 string"), "ends")
    remove(spark, named_path)
    messages = _across(nodes)
    second = nodes.drop("up_frag", "up_frag_depth").unionByName(messages, allowMissingColumns=True).repartition("frag", "frag_depth")
    totals = _forward(second, ["name", "depth", "parent", "n_convs", "children", "leaves", "saved"])
    out = totals.join(digests.withColumnsRenamed({"rep": "name", "d": "depth"}), ["name", "depth"], "left")
    return out.select(
        F.col("name").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256"),
    )


by_value(__name__)
