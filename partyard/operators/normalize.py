"""Cleansed listings to normalized, de-duplicated listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partyard.contracts import (
    NORMALIZE_INPUTS,
    NORMALIZED_LISTINGS,
    RAW_LISTINGS,
    pad_columns,
    require_columns,
)
from partyard.functions import standardize, text
from partyard.operators.cleanse import clean_columns, extract_fields

FALLBACK_KEY = ["title", "price", "search_make_std", "search_model_std", "search_part_std"]

# Where a listing stands in the search: grid cell, result page, place on it.
POSITION = ["grid_position", "search_page", "position_in_page"]
LONG_TEXTS = ["title", "subtitle", "raw_text"]


def standardize_search(df: DataFrame) -> DataFrame:
    """Standard search make, model and part; address without its query."""
    return df.withColumns(
        {
            "search_make_std": standardize.standardize_make(F.col("search_make")),
            "search_model_std": standardize.standardize_model(F.col("search_model")),
            "search_part_std": standardize.standardize_part(F.col("search_part")),
            "listing_url": text.strip_query(F.col("listing_url")),
        }
    )


def add_categories(df: DataFrame) -> DataFrame:
    """Standard part guess and the three category columns."""
    blob = text.combined_text(F.col("title"), F.col("subtitle"), F.col("raw_text"))
    tokens = df.withColumn("_token", text.normalize_token(blob))
    return tokens.withColumns(
        {
            "part_guess_std": standardize.standardize_part(F.col("part_guess")),
            "search_part_category": standardize.category_from_part(F.col("search_part")),
            "part_guess_category": standardize.category_from_part(F.col("part_guess")),
            "part_category_from_text": standardize.classify_token(F.col("_token")),
        }
    ).drop("_token")


def standardize_listings(cleansed: DataFrame) -> DataFrame:
    """All standard and category columns of cleansed listings."""
    padded = pad_columns(cleansed, _only(NORMALIZED_LISTINGS, NORMALIZE_INPUTS))
    return add_categories(standardize_search(padded))


def _only(schema, names):
    return type(schema)([schema[name] for name in names])


def _dedup_key(columns: Sequence[str]) -> list[Column]:
    """The address; for rows without one, the fallback columns that exist."""
    url = text.blank_to_null(F.col("listing_url"))
    parts = [url]
    for name in FALLBACK_KEY:
        if name in columns:
            value = text.blank_to_null(F.col(name)) if name == "title" else F.col(name)
            parts.append(F.when(url.isNull(), value))
    return parts


def deduplicate(listings: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first listing of each address, or of each fallback key.

    ``order`` says what "first" means; by default the search position and then
    every column, so the outcome never depends on partitioning.  Spark turns
    the filter on the row number into a group limit in front of the shuffle:
    each task sends one row per key, however many copies a key has.
    """
    require_columns(listings, ["listing_url"], "deduplication input")
    columns = listings.columns
    if order is None:
        first = [c for c in POSITION if c in columns]
        names = [*first, *(c for c in columns if c not in first)]
        order = [F.col(c).asc_nulls_last() for c in names]
    blanked = {"listing_url": text.blank_to_null(F.col("listing_url"))}
    if "title" in columns:
        blanked["title"] = text.blank_to_null(F.col("title"))
    place = F.row_number().over(Window.partitionBy(*_dedup_key(columns)).orderBy(*order))
    return listings.withColumn("_place", place).filter("_place = 1").drop("_place").withColumns(blanked)


def search_order(columns: Sequence[str]) -> list[Column]:
    """Search position, then the short raw columns, then a hash of the long texts.

    Derived columns are left out: they follow from the raw ones, and naming
    them would have every extractor run, and every text shuffled, for a result
    that needs neither.
    """
    short = [f.name for f in RAW_LISTINGS if f.name not in LONG_TEXTS]
    names = [c for c in [*POSITION, *(c for c in short if c not in POSITION)] if c in columns]
    texts = [c for c in LONG_TEXTS if c in columns]
    return [*(F.col(c).asc_nulls_last() for c in names), F.xxhash64(*texts).asc()]


def dedup_stats(listings: DataFrame) -> DataFrame:
    """One row: rows before and after de-duplication, rows removed, and their share.

    Counts per key are combined inside each map task before the shuffle.
    """
    require_columns(listings, ["listing_url"], "deduplication input")
    keys = [c.alias(f"k{i}") for i, c in enumerate(_dedup_key(listings.columns))]
    counted = listings.groupBy(*keys).agg(F.count("*").alias("n"))
    totals = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before_count"),
        F.count("*").alias("after_count"),
    )
    removed = F.col("before_count") - F.col("after_count")
    share = F.coalesce(F.try_divide(removed.cast("double"), F.col("before_count").cast("double")), F.lit(0.0))
    return totals.withColumns({"removed_count": removed, "removed_rate": share})


def normalize(cleansed: DataFrame) -> DataFrame:
    """Standardize, then de-duplicate in search order.

    Columns outside the contract (the search position, say) stay available to
    the ordering and are dropped at the end.
    """
    padded = pad_columns(standardize_listings(cleansed), NORMALIZED_LISTINGS)
    kept = deduplicate(padded, search_order(padded.columns))
    return kept.select([f.name for f in NORMALIZED_LISTINGS])


def normalize_raw(raw: DataFrame) -> DataFrame:
    """The same listings as ``normalize(cleanse(raw))``, with less work.

    What decides about duplicates is cheap to compute, so copies are dropped
    first.  The extractors then run on the listings that stay, and the shuffle
    does not carry their results.
    """
    keyed = standardize_search(clean_columns(pad_columns(raw, RAW_LISTINGS)))
    kept = deduplicate(keyed, search_order(keyed.columns))
    return add_categories(extract_fields(kept)).select([f.name for f in NORMALIZED_LISTINGS])
