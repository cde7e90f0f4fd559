"""One query per operator, over its whole table; SQL counterparts where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm import bpe, codes, credentials, decontam, hosts, html_text, lattice, minhash, negatives, neighbours, orc_tokens, suffixes, toxicity
from fleetlake.llm.common import table


def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.self_search(table(spark, folder, "embeddings"))


def op2_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.likelihoods(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_orc_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return orc_tokens.stored_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.removals(table(spark, folder, "documents"))


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op10_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return hosts.judged(table(spark, folder, "pages"))


def op11_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.coded_vectors(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_neighbours,
        op2_lattice,
        op3_html_text,
        op4_bpe,
        op5_orc_tokens,
        op6_decontamination,
        op7_toxicity,
        op8_suffix_dedup,
        op9_minhash,
        op10_hosts,
        op11_secrets,
        op12_vector_codes,
        op13_hard_negatives,
    )
}


def oracle_sql() -> dict[str, str]:
    return {"op10_hosts": hosts.oracle_sql()}
