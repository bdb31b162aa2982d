"""The stages on a small fixture, against plain Python."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline
from portdelta.llm.queries import END_ID, vocabulary
from portdelta.llm.staging import staged


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("corpus")
    rng = np.random.default_rng(8)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lan", "mor", "tis")]

    def text(n):
        return " ".join(rng.choice(vocab, n))

    clean = [(i, text(60), f"src{i % 3}") for i in range(200)]
    toxic = [(200 + i, text(20) + " idiot " + text(20), "src0") for i in range(80)]
    item = text(30)
    copies = [(300, clean[0][1], "src1"), (301, clean[1][1] + " more", "src1")]
    leaks = [(302, text(200) + " " + item + " " + text(200), "src2")]
    odd = [(303, None, None), (304, "", "src1"), (None, text(30), "src1")]
    rows = [*clean, *toxic, *copies, *leaks, *odd]
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{top}/documents.parquet")
    labels = [(d, 1, int(d >= 200)) for d, _, _ in clean + toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return str(top), rows


def test_stages_against_plain_python(spark, folder):
    top, rows = folder
    docs = spark.read.parquet(f"{top}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, top), name)
        assert docs.columns == columns
        kept.append(sorted((r.doc_id, r.text) for r in docs.where("doc_id IS NOT NULL").collect()))
        assert docs.where("doc_id IS NULL").count() == 1
    after_toxicity = sorted((d, t) for d, t, _ in rows if d is not None and not 200 <= d < 280)
    after_dedup = [(d, t) for d, t in after_toxicity if d not in (300, 301)]
    after_leaks = [(d, t) for d, t in after_dedup if d != 302]
    assert kept == [after_toxicity, after_dedup, after_leaks, after_leaks]

    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(vocabulary())
    order = {r.doc_id: r.text for r in docs.collect()}
    out = sorted(corpus_pipeline.tokens(spark, docs, top).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == list(order)
    start = 0
    for r in out:
        ids = np.array([*encoder.encode(order[r.doc_id] or "", add_special_tokens=False).ids, END_ID], "<u4")
        assert tuple(r) == (r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_stages_take_an_empty_table(spark, folder, tmp_path):
    top, _ = folder
    spark.read.parquet(f"{top}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{top}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "benchmark_decontamination", "mixing", "token_files"]
