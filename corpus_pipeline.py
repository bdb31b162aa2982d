"""From raw documents to token files.

``STAGES`` are functions ``(spark, docs, sf_dir)``; each result is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portdelta.llm.decontaminate import contained_items
from portdelta.llm.mixing import mix_sources
from portdelta.llm.near_dedup import near_duplicates
from portdelta.llm.queries import END_ID, vocabulary
from portdelta.llm.staging import recorded, remove, staged
from portdelta.llm.token_files import read_digests, token_folder, write_tokens
from portdelta.llm.toxicity import fit_toxicity, reject_toxic


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# What the stage before has staged on its way; its result is written when the next one begins.
_left: list[str] = []


def clearing(stage: Stage) -> Stage:
    """``stage`` that first removes what the one before it left in the shared folder, but for its own ``docs``."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        used = docs.inputFiles() if _left else []
        for path in _left:
            if not any(path in file for file in used):
                remove(spark, path)
        _left.clear()
        with recorded(_left):
            return stage(spark, docs, sf_dir)

    return run_stage


@clearing
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 9 rejects go. It learns from all labelled documents that are there."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return reject_toxic(docs, model)


@clearing
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 or more) stays; rows without an id stay."""
    gone = near_duplicates(docs, percent=80).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


@clearing
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    found = contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id"), "doc_id", "left_anti").select(docs.columns)


@clearing
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files and rows that follow the mix; columns of any name keep their values."""
    place = ["mix_slot", "mix_place"]
    packed = docs.select("doc_id", "source", F.struct("*").alias("row"))
    return mix_sources(packed).repartitionByRange(*place).sortWithinPartitions(*place).select("row.*")


@clearing
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix, that is of the files and rows of ``docs``, and their digests."""
    name = F.col("_metadata.file_name")
    order = [F.regexp_extract(name, r"part-(\d+)", 1).cast("long"), name, F.col("_metadata.row_index")]
    path = token_folder(spark)
    write_tokens(docs, path, vocabulary(), END_ID, order)
    return read_digests(spark, path)


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
    ("token_files", tokens),
]

# A fitted classifier is no SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        written: list[str] = []
        result = stage(spark, docs, sf_dir)
        with recorded(written):
            docs = staged(result, name)
        # Once a stage's documents are written, those it read go.
        for path in before:
            remove(spark, path)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
