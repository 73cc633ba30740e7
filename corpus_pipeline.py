"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and gives a table; all but the last keep the
columns of ``documents``.  Between stages the table is written and read again, so a
lost executor costs one stage at most and every decision is made once.

Documents are told apart by id and text together, so null or repeated ids do no harm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partyard.llm import mixing, near_dedup, packing, pii, quality_classifier
from partyard.llm.common import column, count_words, table
from partyard.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance-resampling classifier draws."""
    return quality_classifier.Classifier(docs, table(spark, sf_dir, "labels")).keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and disclosing words taken out; lengths follow."""
    clean = pii.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; not at all where it takes none.

    Rows equal in id and text are taken equally often.
    """
    key = F.md5(F.col("text"))
    sized = docs.select(
        "doc_id",
        key.alias("key"),
        F.array(column(docs, "source", "string")).alias("sources"),
        count_words(F.col("text")).alias("size"),
    )
    taken = (
        mixing.mix(sized, keys=("doc_id", "key"))
        .groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
        .agg(F.max("passes").alias("__passes"))
        .filter("__passes > 0")
    )
    same = key.eqNullSafe(F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    repeated = docs.join(taken, same).withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__passes"))))
    return repeated.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of every piece of every document, lengths counted in words."""
    return packing.pack(docs.select(column(docs, "doc_id", "long"), count_words(F.col("text")).alias("size")))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", remove_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the model, the signatures or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
