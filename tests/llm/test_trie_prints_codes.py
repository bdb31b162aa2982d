"""Conversation trie, SimHash groups and vector codes against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from oracle import connect

from portdelta.llm import prefix_trie as trie
from portdelta.llm import simhash
from portdelta.llm import vector_codes as codes
from portdelta.llm.queries import QUERIES
from portdelta.llm.simhash import codeword_indices, forest, fuzzy_keys, near_prints, simhash_groups

MID = "/root/testdata/sf0.01"
CONVERSATIONS = "conv_id long, turn long, role string, text string, name long, depth string, band int, copy string"


def plain_trie(rows):
    """Every node from all rebuilt conversations, subtrees by looking at all nodes."""
    own: dict[int, list] = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = turns.get(base, [])[:h] + ts[h:]
    nodes: dict[tuple, list] = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = set()
    words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in nodes}
    children: dict[tuple, int] = {}
    for p in nodes:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(nodes[p]) - 1) * words[p]
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(p))
        up = min(nodes[p[:-1]]) if p else None
        out.add((min(members), len(p), up, len(members), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _trie_of(spark, rows, **names):
    df = spark.createDataFrame([(*r, 5, "x", 3, "c") for r in rows], CONVERSATIONS)
    got = [tuple(r) for r in trie.prefix_trie(df, **names).collect()]
    assert len(got) == len(set(got))
    return set(got)


def _random_conversations(seed, n, deep):
    rng = random.Random(seed)
    rows = []
    for c in range(-3, n):
        if c % 40 == 0 and c:
            continue  # a base that is absent
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9]) if c % 17 else deep):
            same = rng.random() < 0.8
            rows.append((c, None if rng.random() < 0.03 else turn, rng.choice(["user", None]) if not same else "user", "a b" if same else rng.choice([None, "", "x  y", "z\tz"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [2, 3, 64])
def test_trie_equals_plain_python_for_any_size_of_fragments(spark, size):
    rows = _random_conversations(size, 60, 25)
    assert _trie_of(spark, rows, size=size) == plain_trie(rows)


def test_trie_of_one_hot_conversation_and_of_copies(spark):
    rows = [(7, i, "user", f"turn {i % 11}") for i in range(700)]
    rows += [(7, i, "user", f"turn {i % 11}") for i in range(0, 700, 7)]  # repeated rows
    rows += [(100 + c, t, "user", "the same words") for c in range(90) for t in range(3)]
    rows += [(None, 1, "user", "nobody's"), (200, None, None, None), (200, None, None, "")]
    assert _trie_of(spark, rows) == plain_trie(rows)
    assert _trie_of(spark, []) == set()


def test_trie_fragments_stay_small_around_a_hot_node(spark):
    rows = [(c, t, "user", "hello" if t == 0 else f"own {c}") for c in range(1, 800) for t in range(5)]
    df = spark.createDataFrame([(*r, 5, "x", 3, "c") for r in rows], CONVERSATIONS)
    turns, _, n = trie.numbered_turns(df.select("conv_id", "turn", "role", "text"))
    paths = trie.prefix_paths(trie.rebuilt_turns(turns, 20, 0), 64)
    nodes = trie._fragments(trie.with_nodes(paths), 64)
    assert n == len(rows) and nodes.count() == 2 + 799 * 4
    assert max(r["count"] for r in nodes.groupBy("frag", "frag_depth").count().collect()) <= 64


def test_queue_spills_and_stays_in_order():
    rng = random.Random(5)
    queue, held = trie.SpillingQueue(2, most=50), []
    for _ in range(3000):
        if held and rng.random() < 0.4:
            assert queue.first() == min(held)
            held.remove(queue.pop())
        else:
            m = (rng.randrange(-400, 400), rng.randrange(10**12))
            queue.push(m)
            held.append(m)
    assert queue.runs and [queue.pop() for _ in range(len(held))] == sorted(held) and queue.first() is None


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, most=4):
    """Smallest id reachable, by comparing all pairs."""
    ids, x = list(prints), np.array(list(prints.values()), dtype=np.uint64)
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= most):
            a, b = group[i], group[j]
            if a != b:
                group = [min(a, b) if g in (a, b) else g for g in group]
    least: dict[int, int] = {}
    for i, g in zip(ids, group):
        least[g] = min(i, least.get(g, i))
    return {i: least[g] for i, g in zip(ids, group)}


def test_simhash_query_equals_all_pairs(spark):
    docs = dict(connect(MID).execute("SELECT doc_id, text FROM documents").fetchall())
    prints = {d: plain_print(t) for d, t in docs.items()}
    want = {(d, f"{prints[d]:016x}", c) for d, c in plain_groups(prints).items()}
    assert {tuple(r) for r in QUERIES["op12_simhash_near_dedup"](spark, MID).collect()} == want and len(set(c for *_, c in want)) < len(docs)


def test_golay_words_near_each_other_share_a_codeword():
    assert sorted(np.bitwise_count(simhash._CODE).tolist()).count(7) == 253
    words = np.random.default_rng(2).integers(0, 2**23, 400)
    every = codeword_indices(words)
    assert (np.bitwise_count(simhash._CODE[every] ^ words[:, None]) <= 4).all() and (np.bitwise_count(simhash._CODE[every[:, 0]] ^ words) <= 3).all()
    for bits in [(b,) for b in range(23)] + list(combinations(range(23), 2)):
        other = codeword_indices(words ^ sum(1 << b for b in bits))
        assert (every[:, :, None] == other[:, None, :]).any(axis=(1, 2)).all()
        if len(bits) == 1:
            assert (every == other[:, :1]).any(axis=1).all()


def test_prints_four_bits_apart_always_share_a_key():
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**63), 2**63, 3000, dtype=np.int64)
    for n in range(5):
        flips = np.array([sum(1 << int(b) for b in rng.choice(64, n, replace=False)) for _ in x], dtype=np.uint64).view(np.int64)
        assert all(len(np.intersect1d(a, b)) for a, b in zip(fuzzy_keys(x), fuzzy_keys(x ^ flips)))


@pytest.mark.parametrize("most", [2, 4])
def test_crowded_keys_lose_no_link(spark, monkeypatch, most):
    rng = np.random.default_rng(most)
    centre = rng.integers(-(2**63), 2**63, 3, dtype=np.int64)
    flips = [sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 7)), replace=False)) for _ in range(500)]
    prints = np.unique(centre[rng.integers(0, 3, 500)] ^ np.array(flips, dtype=np.uint64).view(np.int64))
    df = spark.createDataFrame([(int(p),) for p in prints], "print long")
    want = plain_groups({int(p): int(np.int64(p).view(np.uint64)) for p in prints}, most)
    for crowd in (4, 1024):
        monkeypatch.setattr(simhash, "_MOST", crowd)
        links = [(r.a, r.b) for r in near_prints(df, most).collect()]
        group = {int(p): int(p) for p in prints}
        for a, b in links:
            lo, hi = sorted((group[a], group[b]))
            group = {k: lo if v == hi else v for k, v in group.items()}
        assert group == want
        assert len(links) <= 130 * len(prints)


def test_forest_links_only_what_is_near():
    prints = np.array([0, 0b1111, 0b11111111, 0xFFFF << 40, -1], dtype=np.int64)
    assert [(a.tolist(), b.tolist()) for a, b in forest(prints, 4)] == [([0, 0], [15, 255])]


def test_simhash_of_odd_rows(spark, odd_docs, odd_rows):
    got = [tuple(r) for r in simhash_groups(odd_docs(odd_rows)).collect()]
    texts = {d: t for d, t, _ in odd_rows if d is not None}
    prints = {d: plain_print(t) for d, t in texts.items()}
    group = plain_groups(prints)
    want = [(d, f"{plain_print(t):016x}", group.get(d)) for d, t, _ in odd_rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash_groups(odd_docs([])).collect() == []


def test_texts_under_one_id_are_one_document(spark, odd_docs):
    rows = [(5, "alpha beta gamma delta epsilon zeta", "a"), (5, "one two three four five six", "a"), (3, "one two three four five six", "b"), (9, "alpha beta gamma delta epsilon zeta", "b")]
    assert {r.component_id for r in simhash_groups(odd_docs(rows)).collect()} == {3}


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """All distances of all rounds with Python's integers."""
    kept = [(i, lab, [int(np.floor(float(x) * 1024)) if abs(x) < 1e300 else int(x) * 1024 for x in v]) for i, lab, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = len(kept[0][2])
    kept = [r for r in kept if len(r[2]) == dim]
    cuts = codes._cuts(dim, parts)
    books = [[tuple(r[2][c]) for r in kept[:entries]] for c in cuts]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, cut in enumerate(cuts):
            had: dict[int, list] = {}
            for r in kept:
                had.setdefault(near(r[2][cut], books[p])[1], []).append(r[2][cut])
            books[p] = [tuple(sum(c) // len(had[k]) for c in zip(*had[k])) if k in had else e for k, e in enumerate(books[p])]
    out = []
    for i, lab, v in kept:
        best = [near(v[c], books[p]) for p, c in enumerate(cuts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


VECTORS = "vec_id long, embedding array<double>, label int, dist string, part int, code string"


@pytest.mark.parametrize("seed,entries,scale", [(1, 4, 1.0), (2, 7, 0.002), (3, 256, 1.0), (4, 3, 1e12)])
def test_codes_equal_full_rescans(spark, seed, entries, scale):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=8) * scale], int(i % 3) if i % 5 else None) for i in range(120)]
    rows += [(7, rows[7][1], 1), (None, rows[3][1], 2), (500, None, 1), (501, [1.0] * 7 + [None], 1), (502, [float("nan")] * 8, 1), (503, [float("inf")] * 8, 1), (504, [1.0], 1), (505, [], 1)]
    df = spark.createDataFrame([(i, v, lab, "d", 1, "c") for i, v, lab in rows], VECTORS)
    coded, books = codes.compress_vectors(df, entries=entries)
    want, digest = plain_codes([(i, lab, v) for i, v, lab in rows], entries=entries)
    small = [(i, lab, c, e if e < 2**63 else None) for i, lab, c, e in want]
    assert sorted(map(tuple, coded.collect()), key=str) == sorted(small, key=str) and codes.books_digest(books) == digest


def test_code_report_adds_errors_by_label_and_takes_huge_numbers(spark):
    rows = [(1, [1.0] * 4, None), (2, [2.0, 2.0, 2.0, 2.5], None), (3, [1e308] * 4, 7), (4, [-1e308] * 4, 7), (5, [0.1] * 4, 8)]
    df = spark.createDataFrame([(i, v, lab, "d", 1, "c") for i, v, lab in rows], VECTORS)
    got = {r.vec_id: r for r in codes.code_report(df, entries=2).collect()}
    want, digest = plain_codes([(i, lab, v) for i, v, lab in rows], entries=2)
    assert {i: (c, e if e < 2**63 else None) for i, _, c, e in want} == {i: (r.code, r.error) for i, r in got.items()}
    for r in got.values():
        label = next(lab for i, _, lab in rows if i == r.vec_id)
        total = sum(e for _, lab, _, e in want if lab == label)
        assert r.codebooks_sha256 == digest and r.label_error == (total if all(e < 2**63 for _, lab, _, e in want if lab == label) else None)


def test_no_usable_vector_gives_no_rows(spark):
    for rows in ([], [(1, None, 2, "d", 1, "c"), (2, [], 2, "d", 1, "c")]):
        assert codes.code_report(spark.createDataFrame(rows, VECTORS)).collect() == []


def test_only_moved_entries_are_compared_where_the_own_one_stayed(monkeypatch):
    rng = np.random.default_rng(9)
    x, book = rng.integers(-50, 50, (300, 3)).astype(float), rng.integers(-50, 50, (16, 3)).astype(float)
    entry, dist = codes._lowest(codes.distances(x, book))
    new = book.copy()
    new[[3, 8]] += 4
    seen = []
    real = codes.distances
    monkeypatch.setattr(codes, "distances", lambda a, e: seen.append((len(a), len(e))) or real(a, e))
    got = codes.reassigned(x, new, entry, dist, (new != book).any(axis=1))
    lost = int(np.isin(entry, [3, 8]).sum())
    assert seen == [(lost, 16), (300 - lost, 2)]
    want = codes._lowest(real(x, new))
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
