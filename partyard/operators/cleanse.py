"""Raw listings to cleansed listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyard.functions import text

CLEANED = ["title", "subtitle", "listing_url", "raw_text", "price_raw"]


def clean_columns(raw: DataFrame) -> DataFrame:
    """White space squeezed and empty texts made null in the text columns."""
    return raw.withColumns(
        {name: text.clean_text(F.col(name)) for name in CLEANED if name in raw.columns}
    )


def extract_fields(cleaned: DataFrame) -> DataFrame:
    """Add the extracted and guessed fields to listings with clean text columns.

    The combined text, its lower-cased form and the words found in it are
    columns of their own, so no extractor builds them again.
    """
    blob = (
        cleaned.withColumn(
            "_text", text.combined_text(F.col("title"), F.col("subtitle"), F.col("raw_text"))
        )
        .withColumn("_lower", F.lower("_text"))
        .withColumn("_parts", text.part_words(F.col("_lower")))
    )
    raw_text, words = F.col("raw_text"), F.col("_text")
    return blob.withColumns(
        {
            "price_clean": text.clean_price(F.col("price_raw")),
            "condition_guess": text.condition(F.col("_lower")),
            "sold_date_guess": text.sold_date_words(raw_text),
            "shipping_text": text.shipping_text(raw_text),
            "vehicle_guess": text.vehicle_guess(text.vehicle_words(F.col("_lower"))),
            "part_guess": text.part_guess(F.col("_parts")),
            "part_number_guess": text.part_number(words),
            "year_range_guess": text.year_range(words),
            "years_found": text.years_found(words),
        }
    ).drop("_text", "_lower", "_parts")


def cleanse(raw: DataFrame) -> DataFrame:
    """Clean the text columns and add the derived fields, in one narrow pass."""
    return extract_fields(clean_columns(raw))


def real_titles(listings: DataFrame) -> DataFrame:
    """Listings whose title is not page furniture."""
    return listings.filter(~text.is_junk_title(F.col("title")))


def without_heavy_duty(listings: DataFrame) -> DataFrame:
    """Listings that do not name a heavy-duty variant of the searched make."""
    return listings.filter(~text.is_heavy_duty(F.col("title"), F.col("search_make")))
