"""Queries of the subpackage: against SQL where there is some, else against plain Python or held-out labels."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from oracle import connect, difference

from portdelta.llm.queries import END_ID, QUERIES, SQL, vocabulary
from portdelta.llm.substring_dedup import without_repeats

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


@pytest.mark.parametrize("n", range(1, 11))
def test_each_operator_has_one_query(n):
    assert len([q for q in QUERIES if q.startswith(f"op{n}_")]) == 1


def _texts(sf):
    return dict(connect(sf).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def test_substring_dedup_finds_what_fifty_word_runs_show(spark):
    rows, texts = QUERIES["op1_substring_dedup"](spark, MID).collect(), _texts(MID)
    seen: dict[str, set[int]] = {}
    for d, t in texts.items():
        at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0d]+", t)]
        for i in range(len(at) - 49):
            seen.setdefault(t[at[i][0] : at[i + 49][1]], set()).add(d)
    want = {d for s in seen.values() for d in s if d != min(s)}
    assert {r.doc_id for r in rows} == want
    for r in rows:
        assert texts[r.doc_id][r.start : r.end] == texts[r.first_doc_id][r.first_start : r.first_start + r.end - r.start]
        assert r.first_doc_id < r.doc_id and len(texts[r.doc_id][r.start : r.end].split()) == r.n_words >= 50


def test_quality_and_toxicity_on_held_out_rows(spark):
    for name, label, fold, rest, least in (("op4_quality", "quality", 5, 0, 0.97), ("op9_toxicity", "toxic", 4, 2, 0.9)):
        rows = {r.doc_id: r for r in QUERIES[name](spark, MID).collect()}
        assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
        assert all(r.held_out == (zlib.crc32(str(d).encode()) % fold == rest) for d, r in rows.items())
        known = connect(MID).execute(f"SELECT doc_id, {label} FROM labels").fetchall()
        held = [(rows[d].predicted, y) for d, y in known if rows[d].held_out]
        assert sum(p == y for p, y in held) / len(held) >= least


def test_toxic_documents_are_found_and_clean_ones_left_alone(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, LARGE).collect()}
    known = connect(LARGE).execute("SELECT doc_id, toxic FROM labels").fetchall()
    held = [(rows[d].predicted, y) for d, y in known if rows[d].held_out]
    assert sum(p for p, y in held if y) >= 0.9 * sum(y for _, y in held)
    assert sum(p for p, y in held if not y) <= 10


def test_mix_keeps_every_source_within_a_block(spark):
    rows = QUERIES["op5_pfair_mix"](spark, MID).collect()
    assert sorted(r.doc_id for r in rows) == list(range(1000))
    full = [r for r in rows if r.mix_full]
    assert full and all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    n = max(r.mix_slot for r in full) + 1
    slots = {(r.source, r.mix_slot) for r in full}
    assert sorted(t for _, t in slots) == list(range(n))
    sources = {r.source for r in rows}
    for s in sources:
        # All sources of this table are as large, so weights are equal.
        had = np.cumsum([(s, t) in slots for t in range(n)])
        assert np.abs(had - np.arange(1, n + 1) / len(sources)).max() < 1


def test_neighbours_recall_and_scores(spark):
    rows = QUERIES["op6_permutation_neighbours"](spark, SF).collect()
    found = connect(SF).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, x = np.array([f[0] for f in found]), np.array([f[1] for f in found], float)
    by_query: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append(r)
    assert sorted(by_query) == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = 0
    for q, own in by_query.items():
        score = x @ x[ids == q][0]
        assert [r.rank for r in own] == list(range(1, 21))
        assert all(abs(r.score - score[ids == r.vec_id][0]) < 1e-12 for r in own)
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        order = [i for i in ids[np.lexsort((ids, -score))].tolist() if i != q][:20]
        hits += len(set(order) & {r.vec_id for r in own})
    assert hits / (20 * len(by_query)) >= 0.9


def test_token_files_hold_what_the_tokenizer_says(spark):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(vocabulary())
    got = {r.doc_id: tuple(r) for r in QUERIES["op10_token_files"](spark, SF).collect()}
    start = 0
    for d, t in _texts(SF).items():
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, END_ID], "<u4")
        assert got[d] == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_secret_scan_base_findings(spark):
    import hashlib

    want = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    got = {r.doc_id: r for r in QUERIES["op8_secret_scan"](spark, MID).collect()}
    some = 0
    for d, t in _texts(MID).items():
        spans = [(m.start(), 0, m.end(), "assign") for m in want.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        r = got[d]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for *_, k in spans) for x in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        some += bool(spans)
    assert some


def test_passages_are_cut_out(spark):
    passage = " ".join(f"shared{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"start {passage} end"), (2, f"other begin {passage} and end"), (3, "short"), (4, None)], "doc_id long, text string")
    from portdelta.llm.substring_dedup import repeated_passages

    found = repeated_passages(docs)
    assert [(r.doc_id, r.first_doc_id, r.n_words) for r in found.collect()] == [(2, 1, 60)]
    kept = {r.doc_id: r.text for r in without_repeats(docs, found).collect()}
    assert kept == {1: f"start {passage} end", 2: "other begin  and end", 3: "short", 4: None}
