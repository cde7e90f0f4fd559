"""A corpus pipeline: each stage takes the documents that the one before it kept.

A stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and
read again as the next one's documents. Rows may repeat and any column may be null; extra
columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import bpe, decontam, minhash, suffixes, toxicity
from fleetlake.llm.common import table
from fleetlake.session import scratch_path


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose score reaches the threshold. The model learns from the stage's
    own documents that are labelled, outside the held-out third."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = "__toxic_score"
    return toxicity.score(docs, model, into=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that of the smallest id."""
    return minhash.deduplicated(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage that occurs more than once out of the texts; all rows stay."""
    return suffixes.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``ids`` and ``n_tokens``; ``text`` is what the ids decode to."""
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded="text")
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_filter),
    ("minhash_dedup", near_dedup),
    ("suffix_dedup", passage_dedup),
    ("decontamination", decontaminate),
    ("bpe", encode_texts),
]

#: SQL can't express the learned, sketched and merged stages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            folder = scratch_path(spark, f"stage{k}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
