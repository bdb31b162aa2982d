"""Token ids in byte-aligned files (operator 10).

Ids are replaced by their rank in the corpus, most frequent first, so common ids are small numbers. Ranks
take one to four bytes each; two bits per rank say how many, and these control bytes stand apart from the
data bytes. Decoding looks up the four lengths of a control byte in a table of 256 rows.

A token folder holds two Parquet tables, as every store that Spark can reach takes them:

* ``tokens``: one row per document, ``doc_id, start, n_tokens, control binary, data binary``, in one folder
  ``part=n`` per range of documents; parts, files and rows ascend.
* ``vocabulary``: ``rank, id`` of the ids that occur.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portdelta.llm.staging import drop_at_exit, small_batches, staged
from portdelta.llm.text import buffers, slices
from portdelta.session import fresh_path
from portdelta.ship import by_value

_LENGTHS = np.stack([(np.arange(256) >> (2 * i) & 3) + 1 for i in range(4)], axis=1)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
# Runs of ids that are put together at once.
_SPREAD = 1 << 15
# Signs that make no piece with the letters before them, as an apostrophe may.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Of UTF-8 bytes: 1 letters (U+00C0 to U+023F but two), 2 signs, 3 the line end, 0 others.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = 1
_KINDS[[ord(c) for c in _SIGNS]] = 2
_KINDS[0x0A] = 3
_TOKENS = "doc_id long, start long, n_tokens long, control binary, data binary"


# --- coding --------------------------------------------------------------------------------------------


def encode(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes, four lengths each, and data bytes, low byte first."""
    control, data = encode_all(np.asarray(ranks, "<u4"), np.array([len(ranks)]))
    return control[0].as_py(), data[0].as_py()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    return decode_all(pa.array([control], pa.binary()), pa.array([data], pa.binary()), np.array([n]))


def _places(n: np.ndarray) -> tuple[np.ndarray, int]:
    """Where each rank's length stands if every document begins a new control byte, and how many places there are."""
    padded = -(-n // 4) * 4
    shift = (np.cumsum(padded) - padded) - (np.cumsum(n) - n)
    return np.arange(int(n.sum())) + np.repeat(shift, n), int(padded.sum())


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """One binary value of each size, out of the bytes of all."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    narrow = ends[-1] < 2**31
    offsets = pa.py_buffer(ends.astype(np.int32 if narrow else np.int64))
    out = pa.Array.from_buffers(pa.binary() if narrow else pa.large_binary(), len(sizes), [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])
    return out if narrow else out.cast(pa.binary())


def _joined(values: pa.Array) -> np.ndarray:
    """The bytes of all values of a binary column."""
    wide = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    offsets = np.frombuffer(values.buffers()[1], wide)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(values) else np.zeros(0, np.uint8)


def encode_all(ranks: np.ndarray, n: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Control and data of several documents of ``n`` ranks each, as ``encode`` gives them one by one."""
    ranks = np.asarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8)
    most = int(ranks.max(initial=0))
    for top in (0xFFFF, 0xFFFFFF):
        if most > top:
            extra += ranks > top
    at, places = _places(n)
    lengths = np.zeros(places, np.uint8)
    lengths[at] = extra
    four = lengths.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << np.uint8(2) | four[:, 2] << np.uint8(4) | four[:, 3] << np.uint8(6)
    ends = np.concatenate([[0], np.cumsum(extra, dtype=np.int64) + np.arange(1, len(extra) + 1)])
    data = np.empty(int(ends[-1]), np.uint8)
    data[ends[:-1]] = ranks.astype(np.uint8)
    for k in range(1, int(extra.max(initial=0)) + 1):
        longer = np.flatnonzero(extra >= k)
        data[ends[longer] + k] = (ranks[longer] >> np.uint32(8 * k)).astype(np.uint8)
    stop = np.cumsum(n)
    return _binaries(control, -(-n // 4)), _binaries(data, ends[stop] - ends[stop - n])


def decode_all(control: pa.Array, data: pa.Array, n: np.ndarray) -> np.ndarray:
    """The ranks of several documents, one after the other."""
    at, _ = _places(n)
    lengths = _LENGTHS[_joined(control)].reshape(-1)[at]
    first = np.cumsum(lengths) - lengths
    raw = np.concatenate([_joined(data), np.zeros(3, np.uint8)])
    value = raw[first].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        value |= raw[first + k].astype(np.uint32) << np.uint32(8 * k)
    return value & _MASKS[lengths]


# --- tokenizing ----------------------------------------------------------------------------------------


def _byte_names() -> dict[int, str]:
    """How byte-level vocabularies write a byte: itself where it prints, else the next code above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)}


@dataclass
class PieceEncoder:
    """Encodes texts piece by piece and remembers the pieces.

    In a byte-level vocabulary that splits before a blank, the ids of a text are the ids of its pieces, cut
    before every blank that a visible character follows: no token reaches over such a cut. Texts in which a
    blank is followed by anything else, or that spell a special token, are encoded as a whole, and so is
    every text of a tokenizer of another kind.
    """

    source: str
    kind: str
    most: int = 300_000
    ids: dict[str, dict[str, bytes]] = field(default_factory=lambda: {"Ġ": {}, "": {}})
    older: dict[str, dict[str, bytes]] = field(default_factory=lambda: {"Ġ": {}, "": {}})
    known: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(self.source)
        told = json.loads(self.source)
        pre = told.get("pre_tokenizer") or {}
        self.pieces = (
            told["model"].get("type") == "BPE"
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and not told.get("normalizer")
            and not told.get("truncation")
            and not told.get("padding")
            and not told["model"].get("dropout")
        )
        self.special = [t["content"] for t in told.get("added_tokens", [])]
        self.names = str.maketrans({chr(b): n for b, n in _byte_names().items()})
        self.tokenize = self.tokenizer.model.tokenize
        self.code = "H" if self.kind == "<u2" else "I"

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _stems(self, stems: list[str], before: str) -> list[bytes]:
        """Ids of letters with a blank before them, if ``before`` says so; what was known long ago is in the older half."""
        # Few stems stand behind a line end.
        if len(self.ids[before]) > (self.most if before else self.most // 4):
            self.ids[before], self.older[before] = {}, self.ids[before]
        ids, older, code, tokenize = self.ids[before], self.older[before], self.code, self.tokenize
        found = list(map(ids.get, stems))
        for i, known in enumerate(found):
            if known is None:
                p = stems[i]
                known = older.get(p)
                if known is None:
                    named = p if p.isascii() else p.encode().decode("latin-1").translate(self.names)
                    known = array(code, [t.id for t in tokenize(before + named)]).tobytes()
                ids[p] = found[i] = known
        return found

    def _others(self, pieces: list[str]) -> list[bytes]:
        """Ids of any pieces behind a blank, or of signs and line ends."""
        if len(self.known) > self.most // 4:
            self.known = {}
        new = [p for p in pieces if p not in self.known]
        for at in range(0, len(new), 5000):
            part = new[at : at + 5000]
            self.known.update(zip(part, self._whole(part)))
        return [self.known[p] for p in pieces]

    def _plain(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which pieces are lines of letters with signs behind them, the bytes' places where their parts begin, and the kinds.

        To the vocabulary letters are one piece, with the blank before them if there is one, and so are signs; a
        line end that letters follow stands alone. Kinds: 1 letters, 2 signs, 3 a line end.
        """
        data, offsets = buffers(pieces)
        kind = _KINDS[data]
        begins, ends = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        filled = offsets[1:] > offsets[:-1]
        begins[offsets[:-1][filled]] = ends[offsets[1:][filled] - 1] = True
        begins, ends = begins[:-1], ends[:-1]
        last = np.concatenate([np.array([3], np.uint8), kind])[:-1]
        last[begins] = 3
        wrong = (kind == 0) | ((last == 3) & (kind != 1)) | ((kind == 1) & (last == 2)) | (ends & (kind == 3))
        # These two signs stand among the letters.
        wrong[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        plain = filled.copy()
        plain[np.searchsorted(offsets, np.flatnonzero(wrong), side="right") - 1] = False
        cuts = begins | (kind != last)
        return plain, np.flatnonzero(cuts), kind

    def _pieces(self, pieces: pa.Array, wanted: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Ids of parts, which parts the pieces are made of one after the other, how many each has, and which have none.

        Pieces that are not ``wanted``, and those behind whose blank a line end or the like comes, have none.
        """
        plain, starts, kind = self._plain(pieces)
        plain &= wanted
        data, offsets = buffers(pieces)
        number = np.searchsorted(offsets, starts, side="right") - 1
        stops = np.append(starts[1:], len(data))
        parts = _texts_between(data, np.append(starts, len(data)))
        kind = kind[starts]
        head = starts == offsets[:-1][number]
        values: list[bytes] = []
        value = np.zeros(len(starts), np.int64)
        letters = plain[number] & (kind == 1)
        for some, ids_of in (
            (letters & head, lambda x: self._stems(x, "Ġ")),
            (letters & ~head, lambda x: self._stems(x, "")),
            (plain[number] & (kind != 1), self._others),
        ):
            coded = parts.filter(pa.array(some)).dictionary_encode()
            value[some] = coded.indices.to_numpy() + len(values)
            values += ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        rest = np.flatnonzero(wanted & ~plain)
        texts = pieces.take(pa.array(rest)).to_numpy(zero_copy_only=False).tolist()
        behind = np.array([bool(p) and ("!" <= p[0] <= "~" or "À" <= p[0] < "ࠀ") for p in texts], bool)
        rest = rest[behind]
        # A piece that is not plain is one part.
        made = plain.copy()
        made[rest] = True
        own = np.full(len(pieces), -1)
        own[rest] = len(values) + np.arange(len(rest))
        values += self._others([" " + p for p, ok in zip(texts, behind.tolist()) if ok])
        single = head & (own[number] >= 0)
        value[single] = own[number[single]]
        taken = (plain[number] & (stops > starts)) | single
        return values, value[taken], np.bincount(number[taken], minlength=len(pieces)), ~made

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, n = self.encode_column(pa.array(texts, pa.string()))
        stop = np.cumsum(n)
        return [ids[a:b].tobytes() for a, b in zip(stop - n, stop)]

    def encode_column(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, with ``end`` behind each, and how many each text has."""
        texts = pc.fill_null(texts, "")
        docs = len(texts)
        if not self.pieces or not docs:
            return self._expanded([*self._whole(texts.to_pylist()), end], np.stack([np.arange(docs), np.full(docs, docs)], axis=1).ravel(), np.full(docs, 2))
        cut = pc.split_pattern(texts, " ")
        size = cut.value_lengths().to_numpy()
        first = np.cumsum(size) - size
        coded = cut.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        behind = np.ones(len(at), bool)
        behind[first] = False
        values, parts, count, none = self._pieces(coded.dictionary, np.bincount(at[behind], minlength=len(coded.dictionary)) > 0)
        ids, n = self._expanded(values, parts, count)
        doc = np.repeat(np.arange(docs), size)
        whole = np.bincount(doc[none[at] & behind], minlength=docs) > 0
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        heads = self._whole(coded.dictionary.take(pa.array(at[first])).to_pylist())
        for i, x in zip(np.flatnonzero(whole).tolist(), self._whole(texts.filter(pa.array(whole)).to_pylist())):
            heads[i] = x
        # Behind the pieces come nothing, the heads, and the end.
        more = [b"", *heads, end]
        ids, n = np.concatenate([ids, np.frombuffer(b"".join(more), self.kind)]), np.concatenate([n, np.array([len(x) for x in more]) // ids.itemsize])
        value = np.where(whole[doc], len(none), at)
        value[first] = len(none) + 1 + np.arange(docs)
        every = np.full(len(at) + docs, len(n) - 1)
        every[np.arange(len(at)) + doc] = value
        return _spread(ids, n, every, size + 1)

    def _expanded(self, values: list[bytes], every: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the values that ``every`` names, and how many there are of each ``count`` of them."""
        ids = np.frombuffer(b"".join(values), self.kind)
        return _spread(ids, np.fromiter(map(len, values), np.int64, len(values)) // ids.itemsize, every, count)


def _spread(ids: np.ndarray, n: np.ndarray, every: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``n`` ids each, those that ``every`` names, and how many ids there are of each ``count`` of them."""
    starts, sizes = (np.cumsum(n) - n)[every], n[every]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(ends[-1]), ids.dtype)
    # A part at a time, so that the places of the ids stay in the processor's cache.
    for at in range(0, len(every), _SPREAD):
        some = slice(at, min(at + _SPREAD, len(every)))
        spot = np.repeat(starts[some] - ends[some] + ends[at], sizes[some])
        spot += np.arange(len(spot))
        out[ends[at] : ends[some.stop]] = ids[spot]
    stop = np.cumsum(count)
    return out, ends[stop] - ends[stop - count]


def _texts_between(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The text from each place to the next."""
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _tokenized(source, kind: str, end_id: int):
    end = np.array([end_id], kind).tobytes()
    width = np.dtype(kind).itemsize

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The broadcast dictionary stays with the Python worker, and with it what earlier tasks have learned.
        sent = source.value
        encoder = sent.get(kind) or sent.setdefault(kind, PieceEncoder(sent["vocabulary"], kind))
        part_no, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, n = encoder.encode_column(batch.column("text"), end)
            start = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part_no, np.int32)), batch.column("doc_id"), pa.array(start), pa.array(n), _binaries(ids.view(np.uint8), n * width)],
                names=["part", "doc_id", "start", "n_tokens", "ids"],
            )

    return run


def _counted(kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            seen = np.bincount(_joined(batch.column("ids")).view(kind))
            if len(seen) > len(total):
                total, seen = seen, total
            total[: len(seen)] += seen
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at].astype(np.int64))], names=["id", "n"])

    return run


def _packed(kind: str, rank_of, starts: dict[int, int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank_of.value
        for batch in chain.from_iterable(slices(b, "ids") for b in batches):
            control, data = encode_all(ranks[_joined(batch.column("ids")).view(kind)], batch.column("n_tokens").to_numpy())
            first = np.array([starts[p] for p in batch.column("part").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(first + batch.column("start").to_numpy()),
                    batch.column("n_tokens"),
                    control,
                    data,
                    batch.column("part"),
                ],
                names=["doc_id", "start", "n_tokens", "control", "data", "part"],
            )

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int, order: list[Column] | None = None) -> None:
    """Write the token folder ``path`` for ``docs (doc_id, text, ...)``.

    ``vocabulary`` is a file of the tokenizers library; ``end_id`` ends each document. Documents come in
    ascending ``doc_id`` (null first, repeated ids by a hash of the text), or in ``order``. A null text is
    empty, so its only token is the end. Whole texts are encoded once; the ids are kept in the shared
    folder while their ranks are counted. To the driver go one count per id of the vocabulary and one per
    range of documents.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        source = f.read()
    from tokenizers import Tokenizer

    top = max(Tokenizer.from_str(source).get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = "<u2" if top <= 1 << 16 else "<u4"
    keys = order or [F.col("doc_id"), F.xxhash64("text")]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[k.alias(f"key_{i}") for i, k in enumerate(keys)])
    names = [f"key_{i}" for i in range(len(keys))]
    ordered = keyed.repartitionByRange(*names).sortWithinPartitions(*names).select("doc_id", "text")
    # The vocabulary file is a fixed few megabytes.
    sent = spark.sparkContext.broadcast({"vocabulary": source})
    ids = staged(ordered.mapInArrow(_tokenized(sent, kind, end_id), "part int, doc_id long, start long, n_tokens long, ids binary"), "ids")
    counts = ids.select("ids").mapInArrow(_counted(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    by_count = sorted(((-r["n"], r["id"]) for r in counts.collect()))
    rank_of = np.zeros(top, np.uint32)
    rank_of[[i for _, i in by_count]] = np.arange(len(by_count))
    spark.createDataFrame([(k, i) for k, (_, i) in enumerate(by_count)], "rank long, id long").coalesce(1).write.parquet(f"{path}/vocabulary")
    starts, total = {}, 0
    for r in sorted(ids.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect(), key=lambda r: r["part"]):
        starts[r["part"]], total = total, total + r["n"]
    packed = ids.mapInArrow(_packed(kind, spark.sparkContext.broadcast(rank_of), starts), _TOKENS + ", part int")
    packed.sortWithinPartitions("part", "start").write.partitionBy("part").option("compression", "zstd").parquet(f"{path}/tokens")


def _unpacked(id_of):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = id_of.value
        for batch in chain.from_iterable(slices(b, "data") for b in batches):
            n = batch.column("n_tokens").to_numpy()
            tokens = ids[decode_all(batch.column("control"), batch.column("data"), n)]
            crc = [zlib.crc32(tokens[stop - size : stop]) for stop, size in zip(np.cumsum(n).tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return run


def vocabulary_ids(spark: SparkSession, path: str) -> np.ndarray:
    """Id of each rank; as many rows as the vocabulary has ids at most."""
    rows = spark.read.schema("rank long, id long").parquet(f"{path}/vocabulary").collect()
    out = np.zeros(len(rows), "<u4")
    out[[r["rank"] for r in rows]] = [r["id"] for r in rows]
    return out


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, decoded from the files of ``path``."""
    small_batches(spark)
    ids = spark.sparkContext.broadcast(vocabulary_ids(spark, path))
    files = spark.read.schema(_TOKENS).parquet(f"{path}/tokens").select("doc_id", "start", "n_tokens", "control", "data")
    return files.mapInArrow(_unpacked(ids), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, tokens array<long>`` of each document, decoded from the files of ``path``."""
    small_batches(spark)
    ids = spark.sparkContext.broadcast(vocabulary_ids(spark, path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_tokens").to_numpy()
            tokens = ids.value[decode_all(batch.column("control"), batch.column("data"), n)].astype(np.int64)
            tokens = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), tokens)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), tokens], names=["doc_id", "start", "tokens"])

    files = spark.read.schema(_TOKENS).parquet(f"{path}/tokens").select("doc_id", "start", "n_tokens", "control", "data")
    return files.mapInArrow(run, "doc_id long, start long, tokens array<long>")


def token_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared root, removed when the driver ends."""
    path = fresh_path(spark, "tokens")
    drop_at_exit(spark, path)
    return path


by_value(__name__)
