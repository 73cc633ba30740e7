"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partyard.llm import (
    chat_format,
    embedding_dedup,
    lexical_search,
    licenses,
    mixing,
    near_dedup,
    packing,
    piece_codec,
    pii,
    quality_classifier,
    quality_rules,
    target_resampling,
    token_counts,
)
from partyard.llm.common import column, count_words, table
from partyard.llm.oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def sized(docs: DataFrame) -> DataFrame:
    """Id, single source and number of words of every document."""
    return docs.select(
        column(docs, "doc_id", "long"),
        F.array(column(docs, "source", "string")).alias("sources"),
        count_words(column(docs, "text", "string")).alias("size"),
    )


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after masking and line clean-up."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("expressions", F.array_join("expressions", " | "))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_classifier.classify(docs, labels)


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(sized(table(spark, sf_dir, "documents"))).drop("sources", "passes")


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as canonical turns, its roles recovered from the lines."""
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


@query
def op6_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences, their lengths counted in words."""
    return packing.pack(sized(table(spark, sf_dir, "documents")))


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_links(table(spark, sf_dir, "embeddings"))


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(f"n_{kind}" for kind in pii.KINDS),
        "base_sha256",
        pii.spans_text().alias("spans"),
    )


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


@query
def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the distribution of the benchmark's texts."""
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return target_resampling.resample(docs, target)


@query
def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(piece_codec.encode_documents(table(spark, sf_dir, "documents")))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return lexical_search.search(docs, items)


__all__ = ["ORACLES", "QUERIES"]
