"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portdelta.llm.calibrate import pooled
from portdelta.llm.components import components
from portdelta.llm.decontaminate import _item_keys, contained_items, size_class, window_keys
from portdelta.llm.line_dedup import line_summary, lines_of, linked_sets, without_similar_lines
from portdelta.llm.mixing import earliest_deadlines, mix_sources, whole_weights
from portdelta.llm.near_dedup import near_duplicates
from portdelta.llm.neighbours import nearest
from portdelta.llm.quality import describe, fit_quality, score_quality
from portdelta.llm.secrets import find_secrets, scan_secrets
from portdelta.llm.staging import recorded
from portdelta.llm.substring_dedup import chunks, repeated_passages, with_runs, without_repeats
from portdelta.llm.text import buffers, short_words, words
from portdelta.llm.token_files import PieceEncoder, decode, decode_all, encode, encode_all, read_tokens, token_folder, write_tokens
from portdelta.llm.toxicity import COUNTS, _best_limits, _candidates, Decoder, character_model, fit_toxicity, readings, reject_toxic, score_toxicity, suspects


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_near_duplicates_odd_rows(odd_docs, odd_rows):
    got = by_id(near_duplicates(odd_docs(odd_rows)), "doc_id", "component_id", "kept")
    want = [(1, 1, True), (2, 2, True), (None, None, True), (3, 3, True), (4, 4, True), (5, 4, False), (5, 4, False), (6, 6, True), (7, 6, False)]
    assert got == sorted(want, key=str)
    assert near_duplicates(odd_docs([])).collect() == []


def test_near_duplicates_of_a_large_family_match_brute_force(odd_docs):
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for d in range(120):
        words = [w if rng.random() > 0.03 * (d % 5) else f"x{d}y{i}" for i, w in enumerate(base)]
        rows.append((d, " ".join(words), "s"))
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(56)} for d, t, _ in rows}
    root = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = {r.doc_id: r.component_id for r in near_duplicates(odd_docs(rows)).collect()}
    assert got == root and 1 < len(set(root.values())) < 120


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_contained_items_odd_rows(spark, odd_docs, odd_rows):
    items = spark.createDataFrame(
        [(1, " ".join(f"w{i % 977}x{i % 31}" for i in range(500, 540)), "c"), (2, "", "c"), (3, None, "c"), (None, "one", "c"), (4, "one", "c"), (5, "some text without an id at all", "c")],
        "item_id long, text string, doc_id string",
    )
    got = by_id(contained_items(odd_docs(odd_rows), items), "doc_id", "item_id", "n_common", "n_item")
    assert got == [(4, 1, 36, 36), (5, 1, 36, 36), (6, 4, 1, 1), (7, 4, 1, 1)]
    assert contained_items(odd_docs([]), items).collect() == []
    assert contained_items(odd_docs(odd_rows), items.limit(0)).collect() == []


def test_line_dedup_odd_rows(odd_docs, odd_rows):
    rows = [*odd_rows, (8, "a b c d e f g h i j\nnew line here", "s"), (9, "A B c d e f g h i\n\na b c d e f g h i j", "s")]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_links) for r in line_summary(odd_docs(rows)).collect()}
    assert got == {1: (0, 0, 0), 2: (0, 0, 0), None: (0, 0, 0), 3: (0, 0, 0), 4: (1, 0, 1), 5: (2, 2, 2), 6: (1, 0, 0), 7: (1, 1, 0), 8: (2, 0, 1), 9: (2, 2, 2)}
    kept = {r.doc_id: r.text for r in without_similar_lines(odd_docs(rows)).collect()}
    assert kept[9] == "" and kept[8].startswith("a b c") and kept[1] is None and kept[2] == ""
    assert line_summary(odd_docs([])).collect() == []


def test_lines_of_a_template_write_no_pairs(spark):
    # Every two of the lines share 11 of 13 words.
    docs = spark.createDataFrame([(d, "\n".join(f"page {10 * d + i} of the long report on all that was found" for i in range(10)), "s") for d in range(90)], "doc_id long, text string, source string")
    paths: list[str] = []
    with recorded(paths):
        got = line_summary(docs).collect()
    assert {(r.n_lines, r.n_links) for r in got} == {(10, 8990)} and sorted(r.n_removed for r in got) == [9] + [10] * 89
    assert paths and max(spark.read.parquet(p).count() for p in paths) < 20 * 900


@pytest.mark.parametrize("most", [7])
def test_links_are_those_of_all_pairs(spark, most):
    rng = np.random.default_rng(most)
    lines = []
    for size in (1, 3, 4, 5, 6, 9, 10, 20, 48, 160, 330):
        for _ in range(6):
            base = rng.integers(0, 4000 if size > 9 else 14, size)
            for _ in range(8):
                other = base[rng.random(size) < 0.97]
                lines.append(" ".join(f"w{x}" for x in [*other, *rng.integers(0, 4000, rng.integers(0, 1 + size // 9))]))
    rng.shuffle(lines)
    docs = spark.createDataFrame([(d, "\n".join(lines[d::40])) for d in range(40)], "doc_id long, text string")
    found, counts = lines_of(docs)
    first = found.groupBy("set_key").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    got = {tuple(r.first): (r.n_links, tuple(r.near)) for r in linked_sets(docs, first, counts, often=30, most=most).join(first, "set_key").collect()}
    sets = {}
    for d in range(40):
        for i, x in enumerate(lines[d::40]):
            if x:
                sets.setdefault(frozenset(x.split()), (d, i))
    want = {}
    for a, at in sets.items():
        near = [k for b, k in sets.items() if a != b and 100 * len(a & b) >= 80 * len(a | b)]
        if near:
            want[at] = (len(near), min(near))
    assert got == want and len(want) > 100


def test_repeated_passages_odd_rows(odd_docs, odd_rows):
    got = repeated_passages(odd_docs(odd_rows)).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(5, 4)} and max(r.n_words for r in got) == 60_000
    assert repeated_passages(odd_docs([])).collect() == []


def test_secret_scan_odd_rows(odd_docs, odd_rows):
    rows = [*odd_rows, (8, "é key = 'Zx81kLmq09Pp'\nclient_secret_v = key", "s")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in scan_secrets(odd_docs(rows)).collect()}
    assert got[1] == got[2] == got[4] == [] and got[8] == [("literal", 9, 21)]
    assert scan_secrets(odd_docs([])).collect() == []


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ('A = "abc12345"\nB = "DEF456gh"\nauth_token_value = A + B', ["abc12345", "DEF456gh"]),
        ('{"privateKey": "MIIEvQIBADANBgkq"}', ["MIIEvQIBADANBgkq"]),
        ("x = y\ny = x\npassphrase = x", []),
        ("note: this is prose at 10:30", []),
        ("DB_PASS=$(cat x)", []),
        ("password=abc", []),
    ],
)
def test_literals_follow_names(text, spans):
    assert [text[f.start : f.end] for f in find_secrets(text) if f.kind == "literal"] == spans


def test_toxicity_weights_equal_plain_counts(spark):
    # Rows of each fold and label, and in how many of them each of three features stands.
    n = np.array([[40, 10], [38, 12], [45, 5], [39, 11]], float)
    features = {11: [0, 9, 1, 10, 0, 5, 0, 10], -7: [20, 1, 19, 2, 22, 0, 20, 1], 5: [1, 0, 0, 0, 0, 0, 0, 0]}
    counts = spark.createDataFrame([(k, *v) for k, v in features.items()], "feature long, " + ", ".join(f"{c} long" for c in COUNTS))
    keys, odds, gain = _candidates(counts, n, 10)
    assert keys.view(np.int64).tolist() == [11, -7]
    for row, key in enumerate((11, -7)):
        seen = np.array(features[key], float).reshape(4, 2)
        for k in range(5):
            left = [i for i in range(4) if i != k]
            (neg, pos), (n_neg, n_pos) = seen[left].sum(axis=0), n[left].sum(axis=0)
            share = n_pos / (n_neg + n_pos)
            want = math.log((pos + share) / (n_pos + 1)) - math.log((neg + 1 - share) / (n_neg + 1))
            assert odds[row, k] == pytest.approx(want)
            told = sum(x * math.log(x / ((pos + neg) * s)) for x, s in ((pos, share), (neg, 1 - share)) if x)
            assert gain[row, k] == pytest.approx(2 * told if 2 * told >= 8 and (want < 0 or want >= 1) else 0)


def test_toxicity_takes_the_limits_with_the_least_loss():
    bins = np.zeros((3, 4, 2))
    bins[0, 1], bins[0, 2] = (5, 5), (5, 5)
    bins[1, 1], bins[1, 2] = (10, 0), (0, 10)
    bins[2, 1], bins[2, 2] = (8, 2), (2, 8)
    assert _best_limits(bins) == 1


def test_toxicity_odd_rows(spark, odd_docs, odd_rows):
    clean = [(100 + i, f"the day was calm and number {i} of the nice people came along with others", "s") for i in range(200)]
    toxic = [(400 + i, f"you are an idiot and number {i} of the nice people knows it well", "s") for i in range(100)]
    docs = odd_docs([*odd_rows, *clean, *toxic, (900, "what an 1d10t you are", "s"), (901, "i d i o t that you are", "s"), (902, "such an idiooooot there", "s")])
    labels = spark.createDataFrame([(d, int(d >= 400)) for d, _, _ in clean + toxic] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    assert all(got[d].predicted == 1 for d in (400, 450, 900, 901, 902)) and not any(got[d].predicted for d in (1, 2, 3, 4, None, 100, 250))
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = reject_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows) + 200
    nothing = fit_toxicity(odd_docs([]), labels.limit(0))
    assert score_toxicity(odd_docs([]), nothing).collect() == []
    assert {r.score for r in score_toxicity(odd_docs(odd_rows), nothing).collect()} == {0.0}


def test_readings_follow_the_character_model(spark):
    model = character_model(spark.createDataFrame([("the idiot and the clown were there, a pathetic moron too " * 30,)], "text string"))
    for written, meant, apart in (("1d10t", "idiot", False), ("cl0wn", "clown", False), ("m.o.r.o.n", "moron", True), ("p4th3t1c", "pathetic", False), ("idiooot", "idiot", False)):
        assert meant in readings(written, model, apart)


def test_spaced_out_words_in_a_row_are_told_apart(spark):
    model = character_model(spark.createDataFrame([("you are a stupid idiot and i hate the clown, i hate a pathetic moron too " * 30,)], "text string"))
    for written, meant in (("a s t u p i d", "a stupid"), ("i h a t e", "i hate"), ("s t u p i d i d i o t", "stupid idiot"), ("m.o.r.o.n", "moron")):
        assert meant in readings(written, model, True)


def test_lightly_disguised_words_reach_the_decoder(spark):
    text = "you are a stupid idiot and a loser, the whole bass class will pass it all to a pathetic moron too "
    decoder = Decoder(character_model(spark.createDataFrame([(text * 30,)], "text string")))
    written = ("pa$$", "idio+", "a loser$ here", "stuupid", "iidiioott", "st-up-id", "mo_ron", "lo..ser")
    for one, meant in zip(written, ("pass", "idiot", "loser", "stupid", "idiot", "stupid", "moron", "loser")):
        data = np.frombuffer(one.encode(), np.uint8)
        assert meant in decoder.restored(data, 0, len(data)).split()
    plain = np.frombuffer(b"It is so. One day, two.", np.uint8)
    assert suspects(plain, 0, len(plain)) == []


def test_quality_odd_rows(spark, odd_docs, odd_rows):
    good = [(100 + i, f"A plain sentence about topic {i} stands here. It ends well.", "s") for i in range(120)]
    bad = [(400 + i, f"BUY!!! NOW!!! $$$ {i} CLICK!!! *** " * 3, "s") for i in range(60)]
    docs = odd_docs([*odd_rows, *good, *bad])
    labels = spark.createDataFrame([(d, int(d < 400)) for d, _, _ in good + bad] + [(None, 1), (1, None)], "doc_id long, quality int")
    described = describe(docs)
    got = [(r.doc_id, r.score, r.predicted) for r in score_quality(described, fit_quality(described, labels)).collect()]
    assert len(got) == len(odd_rows) + 180 and all(np.isfinite(s) and 0 <= s <= 1 for _, s, _ in got)
    assert sum(p == (d < 400) for d, _, p in got if d and d >= 100) >= 176
    empty = describe(odd_docs([]))
    assert score_quality(empty, fit_quality(empty, labels.limit(0))).collect() == []


def test_pooled_rises_and_keeps_the_mean():
    p, n = np.array([3.0, 1, 0, 5, 2]), np.array([4.0, 4, 0, 6, 9])
    curve = pooled(p, n)
    assert (np.diff(curve) >= 0).all() and np.isclose((curve * n).sum(), p.sum())


def test_mix_odd_rows(odd_docs, odd_rows):
    got = mix_sources(odd_docs(odd_rows), {"a": 1, "b": 2, "c": 1, "": 4}, block_docs=1)
    assert got.count() == len(odd_rows) and {"rep", "label", "component_id"} <= set(got.columns)
    assert len({(r.mix_slot, r.mix_place) for r in got.collect()}) == len(odd_rows)
    assert mix_sources(odd_docs([])).collect() == []
    with pytest.raises(Exception, match="above zero"):
        mix_sources(odd_docs(odd_rows), {"a": 0})


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.floats(0.001, 1.0), min_size=1), st.integers(1, 400))
def test_schedule_meets_every_deadline(weights, n):
    whole = whole_weights(dict.fromkeys(weights, n), weights)
    total = sum(Fraction(str(w)) for w in weights.values())
    exact = {s: Fraction(str(w)) / total for s, w in weights.items()}
    assert all(Fraction(whole[s], sum(whole.values())) == w for s, w in exact.items())
    plan = list(earliest_deadlines(whole, dict.fromkeys(weights, n)))
    assert sorted((s, j) for s, j, *_ in plan) == sorted((s, j) for s in weights for j in range(1, n + 1))
    assert all(release <= slot < deadline for _, _, release, deadline, slot in plan)
    # Until the first source has run out no slot is empty, and none drifts, however long that takes.
    end = min(int(n / w) for w in exact.values())
    assert [p[4] for p in plan[:end]] == list(range(end))
    had = dict.fromkeys(weights, 0)
    for t, (s, *_) in enumerate(plan[:end], 1):
        had[s] += 1
        assert all(abs(had[x] - exact[x] * t) < 1 for x in exact)


def _lags(rows, weights):
    total = sum(weights.values())
    slots = {(r.mix_source, r.mix_slot) for r in rows if r.mix_full}
    end = max(t for _, t in slots) + 1
    assert sorted(t for _, t in slots) == list(range(end))
    return max(np.abs(np.cumsum([(s, t) in slots for t in range(end)]) - np.arange(1, end + 1) * (w / total)).max() for s, w in weights.items())


def test_unequal_weights_do_not_drift(spark):
    # One source with a third of the rows and 19 as large as each other, several turns of the schedule.
    sources = ["big"] * 3800 + [f"s{i}" for i in range(19) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(sources)), "doc_id long, source string")
    for weights in ({"big": 61, **{f"s{i}": 20 for i in range(19)}}, {"big": 1 / 3, **{f"s{i}": 0.0351 for i in range(19)}}):
        rows = mix_sources(docs, weights, block_docs=1).collect()
        assert len(rows) == len(sources) == len({(r.mix_slot, r.mix_place) for r in rows})
        assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
        assert _lags(rows, weights) < 1
    roots = {"big": 61, **{f"s{i}": 20 for i in range(19)}}
    assert _lags(mix_sources(docs, block_docs=2).collect(), roots) < 1


def test_mix_takes_very_many_sources(spark):
    docs = spark.range(3600).selectExpr("id AS doc_id", "cast(id % 1200 AS string) AS source")
    rows = mix_sources(docs, block_docs=1).collect()
    assert sorted(r.mix_slot for r in rows) == list(range(3600))


def test_helper_columns_clash_with_nothing(spark):
    names = ["row", "cuts", "gone", "draw", "bucket", "before", "rank", "at", "j", "share", "slot", "_share", "_before", "_slot", "_gone", "_cuts"]
    passage = " ".join(f"w{i}" for i in range(80))
    texts = [(1, passage), (2, "new start " + passage), (3, "one line"), (4, None)]
    docs = spark.createDataFrame([(d, t, "s", *names) for d, t in texts], "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in names))
    cut, lines, mix = without_repeats(docs, repeated_passages(docs)), without_similar_lines(docs), mix_sources(docs)
    for out in (cut, lines, mix):
        assert out.columns[: len(docs.columns)] == docs.columns
        assert out.select(names).distinct().collect() == [tuple(names)] and out.count() == 4
    assert by_id(cut, "doc_id", "text") == [(1, passage), (2, "new start "), (3, "one line"), (4, None)]


def test_marked_runs_are_those_of_marked_chunks():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 4, 9, 40):
        digest, start = rng.integers(0, 2**63, n).astype(np.uint64), np.arange(n) * 20
        marked = rng.random(n) < 0.7
        got = set(zip(*(x.tolist() for x in with_runs(digest, start, start + 20, marked))))
        bad = {20 * i for i in np.flatnonzero(~marked)}
        every = zip(*(x.tolist() for x in with_runs(digest, start, start + 20)))
        assert got == {(d, a, b) for d, a, b in every if not bad & set(range(a, b, 20))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_coding_round_trip(values):
    ranks = np.array(values, np.uint32)
    assert decode(*encode(ranks), len(ranks)).tolist() == values


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é.,\n\t '!0漢 ", max_size=30), max_size=6))
def test_pieces_give_the_ids_of_the_whole(texts):
    encoder = _encoder()
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encoder.encode(texts) == want


def test_documents_are_coded_together_as_one_by_one():
    several = [[], [7], [255, 256, 65_535, 65_536, 2**24 - 1], [2**24, 2**32 - 1, 0, 1], [], [300] * 9]
    for docs in (several, [[1, 2, 3], [40_000], []], [[], []], []):
        ranks, n = np.array([x for d in docs for x in d], "<u4"), np.array([len(d) for d in docs], np.int64)
        control, data = encode_all(ranks, n)
        by_hand = []
        for d in docs:
            sizes = [max(1, -(-x.bit_length() // 8)) - 1 for x in d] + [0] * (-len(d) % 4)
            by_hand.append((bytes(sum(s << 2 * i for i, s in enumerate(sizes[at : at + 4])) for at in range(0, len(sizes), 4)), b"".join(x.to_bytes(s + 1, "little") for x, s in zip(d, sizes))))
        assert list(zip(control.to_pylist(), data.to_pylist())) == by_hand
        assert decode_all(control, data, n).tolist() == ranks.tolist()
        # A piece of a longer column is read from where it begins.
        assert decode_all(control[1:], data[1:], n[1:]).tolist() == [x for d in docs[1:] for x in d]


_ENCODERS: list[PieceEncoder] = []


def _encoder() -> PieceEncoder:
    if not _ENCODERS:
        import public_tokenizers

        _ENCODERS.append(PieceEncoder(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read(), "<u2", most=50))
    return _ENCODERS[0]


def test_encoder_agrees_with_the_library_on_mixed_pieces():
    encoder = _encoder()
    # A blank and a line end before a word known behind a line end: the blank and the line end are tokens too.
    odd = ["a.\nThe b", "a \nThe b", " \nThe", "x \n", "", " ", None, "", "tab\there", "w\n", "w,\n\nz", "×a ÷ ñ× é÷é", "it's 'tis don't", "ɐb ȿz Ɂ ɏ", "中 文 word", "a <|endoftext|> b"]
    rng = np.random.default_rng(11)
    bits = [" ", " ", " ", " the", " Thé", "cióñ", "ß", "\n", ".", ",", "!?", "'", "s", "12", "×", "÷", "ɐ", "é", "…", "\t", "я", " \n", "A", "z", "\x00", "Ŀ", "ȿ"]
    texts = odd + ["".join(rng.choice(bits, rng.integers(0, 12))) for _ in range(3000)]
    for part in (texts, texts[:9], [None, ""], [], texts[200:900][::-1]):
        want = [e.ids for e in encoder.tokenizer.encode_batch_fast([t or "" for t in part], add_special_tokens=False)]
        ids, n = encoder.encode_column(pa.array(part, pa.string()), np.array([2], "<u2").tobytes())
        assert ids.tolist() == [x for w in want for x in [*w, 2]] and n.tolist() == [len(w) + 1 for w in want]
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode([t or "" for t in part])] == want


def test_words_hashed_eight_bytes_at_a_time_are_the_same_words():
    rng = np.random.default_rng(5)
    bits = [" ", "\n", "\t", "a", "B", "Z", "é", "ÀÀ", "word", "longerword", "x" * 40, "中", "\x0b", "\x00", "{", "@", "[", "q" * 300, "\x85"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 30))) for _ in range(1500)] + ["", None, "abc", "def", "a\x00", "a", "ab" * 200, "AB" * 200]
    a, b = words(*buffers(pa.array(texts))), short_words(*buffers(pa.array(texts)))
    for name in ("starts", "ends", "first"):
        assert np.array_equal(getattr(a, name), getattr(b, name))
    # Equal words have equal hashes and others do not.
    both = {*zip(a.hashes.tolist(), b.hashes.tolist())}
    assert len(both) == len({x for x, _ in both}) == len({y for _, y in both})
    # A word's hash does not depend on what stands around it.
    at = 0
    for text in texts[:200]:
        own = short_words(*buffers(pa.array([text]))).hashes
        assert own.tolist() == b.hashes[at : at + len(own)].tolist()
        at += len(own)
    assert len(short_words(*buffers(pa.array(["", None]))).hashes) == 0


def test_token_files_odd_rows(spark, odd_docs, odd_rows):
    from portdelta.llm.queries import END_ID, vocabulary

    path = token_folder(spark)
    write_tokens(odd_docs([*odd_rows, (8, "a <|endoftext|> b", "s")]), path, vocabulary(), END_ID)
    got = sorted(read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert got[1].tokens == got[2].tokens == [END_ID] and got[-1].tokens.count(50256) == 1
    assert all(b.start == a.start + len(a.tokens) for a, b in zip(got, got[1:]))
    empty = token_folder(spark)
    write_tokens(odd_docs([]), empty, vocabulary(), END_ID)
    assert read_tokens(spark, empty).collect() == []


def test_neighbours_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 3.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [1.0, None]), (8, []), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (9, [1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, q string, id int")
    got = by_id(nearest(df, F.col("vec_id") % 2 == 0, k=3), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0), (2, 1, 0, 1.0), (2, 2, 1, 1.0), (2, 3, 3, 0.0)]
    assert nearest(df.limit(0), F.lit(True)).collect() == []


def test_a_repeated_id_leaves_room_for_others(spark):
    hot = [(1, [1.0, 0.001 * i]) for i in range(60)] * 2
    df = spark.createDataFrame([(0, [1.0, 0.0]), *hot, (2, [0.9, 0.0]), (3, [0.8, 0.0])], "vec_id long, embedding array<double>")
    for share in (0.05, 0.5):
        got = by_id(nearest(df, F.col("vec_id") == 0, k=3, share=share), "rank", "vec_id", "score")
        assert got == [(1, 1, 1.0), (2, 2, 0.9), (3, 3, 0.8)]


def test_short_items_are_all_found():
    rng = np.random.default_rng(5)
    missed = 0
    for i in range(3000):
        item = [f"i{i}x{j}" for j in range(6)]
        around = [f"r{x}" for x in rng.integers(0, 10**9, 30)]
        batch = pa.RecordBatch.from_pydict({"item_id": [i], "text": [" ".join(item)]})
        keys = next(_item_keys([batch])).column("keys")[0].as_py()
        in_doc = window_keys(words(*buffers(pa.array([" ".join(around[:12] + item + around[12:])], pa.string()))), [size_class(6)])[0].view(np.int64)
        missed += not set(keys) & set(in_doc.tolist())
    assert missed == 0


def test_a_run_of_common_chunks_finds_its_own_first_document(odd_docs):
    rng = np.random.default_rng(8)
    parts = [" ".join(f"{x:x}" for x in rng.integers(0, 2**30, 12)) for _ in range(8)]
    rows = [(i, f"only {i} has this {p} and that {i} ends", "s") for i, p in enumerate(parts)]
    rows += [(50, "before it " + " ".join(parts) + " behind", "s"), (60, "something else " + " ".join(parts) + " too", "s")]
    got = repeated_passages(odd_docs(rows)).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(60, 50)} and max(r.n_words for r in got) == 96


def test_one_short_shared_chunk_is_enough(odd_docs):
    for seed in range(3000):
        rng = np.random.default_rng(seed)
        shared = " ".join("abcdefghijklmnop"[x] for x in rng.integers(0, 16, 52))
        a, b = f"some text stands before {shared} 1st end", f"another beginning here {shared} 2nd close"
        one, two = (chunks(np.frombuffer(x.encode(), np.uint8)) for x in (a, b))
        size = {d: e - s for d, s, e in zip(*one)}
        both = sum(size[d] for d in set(size) & set(two[0].tolist()))
        if 12 <= both < 48:
            break
    got = repeated_passages(odd_docs([(1, a, "s"), (2, b, "s")])).collect()
    assert 12 <= both < 48 and [(r.doc_id, r.first_doc_id, r.n_words >= 50) for r in got] == [(2, 1, True)]


def test_texts_meet_only_where_a_passage_may_stand(odd_docs, monkeypatch):
    from portdelta.llm import substring_dedup

    rng = np.random.default_rng(3)

    def prose(n):
        return " ".join(f"{x:x}" for x in rng.integers(0, 2**40, n))

    met, keep = [], substring_dedup.staged
    monkeypatch.setattr(substring_dedup, "staged", lambda df, label: met.append((label, keep(df, label))) or met[-1][1])
    line, left, right = prose(16), prose(49), prose(49)
    # A line of 16 words is no passage; 49 words on one side of a changed word are none, and 50 are.
    rows = [(1, f"{prose(60)} {line} {prose(60)}", "s"), (2, f"{prose(60)} {line} {prose(60)}", "s"), (3, f"x1 {left} x2 y1 {right} y2", "s"), (4, f"x3 {left} x4 y1 {right} y4", "s")]
    # The text that sorts first stays of an id that repeats, so the other one's words may not hide the passage.
    rows += [(5, f"b {prose(20)} {line} {right} {left} {prose(20)}", "s"), (6, f"z {prose(5)} {line} {prose(5)}", "s"), (6, f"a {prose(5)} {line} {right} {left} {prose(5)}", "s")]
    got = {(r.doc_id, r.first_doc_id, r.n_words) for r in repeated_passages(odd_docs(rows)).collect()}
    aligned = {(r.doc_id, r.first_doc_id) for r in dict(met)["aligned"].collect()}
    assert {(4, 3, 50), (6, 5, 98)} <= {(a, b, n) if a == 4 else (a, b, 98) for a, b, n in got if n >= 50}
    assert (2, 1) not in aligned and (2, 1) not in {g[:2] for g in got}


def test_words_beside_a_run_with_a_changed_gap_hide_no_passage():
    from portdelta.llm.substring_dedup import equal_stretches, surroundings

    rng = np.random.default_rng(21)
    seen = 0
    for _ in range(1500):
        sides, middle = ["".join(rng.choice(list("ab  "), 70)) for _ in range(2)], ["".join(rng.choice(list("ab  "), n)) for n in (16, 9, 16)]
        b = [sides[0], *middle, sides[1]]
        at = int(rng.integers(0, 5))
        b[at] = "".join(rng.choice(list("ab  "), len(b[at]))) if rng.random() < 0.8 else b[at]
        b[2] = "".join(rng.choice(list("ab  "), 9)) if rng.random() < 0.5 else b[2]
        b[1], b[3] = middle[0], middle[2]
        x, y = "".join([sides[0], *middle, sides[1]]).encode(), "".join(b).encode()
        single = np.array([70, 95]), np.array([86, 111])
        found = [surroundings(np.frombuffer(t, np.uint8), (np.array([70]), np.array([111])), single, 25) for t in (x, y)]
        alike = any(bool((one == two).filled(False).any() | (one == 0).filled(False).any()) for one, two in zip(*found))
        hit = bool(equal_stretches(x, y, 0, 70, 111, 25))
        seen += hit
        assert alike or not hit
    assert seen > 100


def test_a_piece_at_an_empty_chunk_is_never_left_out():
    from portdelta.llm.substring_dedup import surroundings

    data = np.frombuffer(("of " * 40 + "thste dou").encode(), np.uint8)
    single = np.array([120, 120, 60]), np.array([129, 120, 120])
    left, right = surroundings(data, (np.array([60, 0]), np.array([120, 30])), single, 50)
    assert left.tolist()[0] == right.tolist()[0] == 0 and right.tolist()[1] > 0


def test_sums_of_a_text_serve_chunks_and_the_words_beside_them():
    from portdelta.llm.substring_dedup import _GEAR, _beside, _prefix_sums, gear, surroundings

    rng = np.random.default_rng(8)
    for text in ("", "a", "".join(rng.choice(list("abcd  "), 6000)), "ab " * 900, "x" * 900 + "".join(rng.choice(list("ab "), 900))):
        data = np.frombuffer(text.encode(), np.uint8)
        plain = [sum(int(_GEAR[data[k]]) << (i - k) for k in range(max(0, i - 31), i + 1)) & 0xFFFFFFFF for i in range(len(data))]
        assert gear(data).tolist() == plain
        sums = _prefix_sums(data)
        found = chunks(data, sums)
        assert all(x.tolist() == y.tolist() for x, y in zip(found, chunks(data)))
        pieces = with_runs(*found)[1:]
        for side, (values, mask) in zip(surroundings(data, pieces, found[1:], 50), _beside(data, pieces, found[1:], 50, sums)):
            assert side.tolist() == [None if m else v for v, m in zip(values.tolist(), mask.tolist())]


def test_names_are_followed_in_the_order_of_the_text():
    import time

    from portdelta.llm.secrets import literal_spans

    old, new = "k7Qw9zXv2LmR4tYp", "Zp3Vb8Nc1Hd6Js0W"

    def found(text):
        return [text[f.start : f.end] for f in sorted(literal_spans(text), key=lambda f: f.start)]

    assert found(f'a = "{old}"\nauth_secret = a\na = "{new}"\n') == [old]
    assert found(f'a = "{old}"\na = "{new}"\nauth_secret = a\n') == [new]
    # Used before it is assigned: the first assignment that follows.
    assert found(f'auth_secret = a\na = "{old}"\na = "{new}"\n') == [old]
    assert found("auth_secret = b\nb = c\nc = b\n") == []
    chain = f'n0 = "{old}"\n' + "".join(f"n{i} = n{i - 1}\n" for i in range(1, 10_000)) + "password = n9999\n"
    doubling = f'n0 = "{new}"\n' + "".join(f"n{i} = n{i - 1} + n{i - 1}\n" for i in range(1, 60)) + "password = n59\n"
    sensitive = f'secret0 = "{old}"\n' + "".join(f"secret{i} = secret{i - 1}\n" for i in range(1, 10_000))
    start = time.perf_counter()
    assert found(chain) == [old] and found(doubling) == [new] and found(sensitive) == [old]
    assert time.perf_counter() - start < 3


def test_bindings_equal_a_plain_walk():
    import random

    from portdelta.llm.secrets import _Bindings, _Term

    rng = random.Random(8)
    for _ in range(300):
        names, at, said = "abcde", 0, []
        for _ in range(rng.randrange(1, 12)):
            terms = []
            for _ in range(rng.randrange(1, 4)):
                terms.append(_Term(rng.choice(names), at, at + 1, True) if rng.random() < 0.6 else _Term(f"lit{at}", at, at + 1, False))
                at += 2
            said.append((rng.choice(names), terms))

        def reach(i, seen):
            out = set()
            for t in said[i][1]:
                if not t.is_name:
                    out.add(t.text)
                    continue
                before = [j for j in range(i) if said[j][0] == t.text]
                after = [j for j in range(i + 1, len(said)) if said[j][0] == t.text]
                j = before[-1] if before else after[0] if after else None
                if j is not None and j not in seen:
                    out |= reach(j, seen | {j})
            return out

        bindings = _Bindings(said)
        for i in range(len(said)):
            assert {t.text for t in bindings.literals(i)} == reach(i, {i})
