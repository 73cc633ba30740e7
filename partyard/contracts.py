"""Column contracts of every table, as Spark schemas, and the checks on them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, BOOLEAN = T.DoubleType(), T.BooleanType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()

# ---------------------------------------------------------------------------
# FIXED VALUES: column names and types of the tables
# ---------------------------------------------------------------------------
RAW_LISTINGS = T.StructType(
    [
        T.StructField("run_id", STRING),
        T.StructField("scrape_ts", STRING),
        T.StructField("pass_type", STRING),
        T.StructField("search_year", INT),
        T.StructField("search_make", STRING),
        T.StructField("search_model", STRING),
        T.StructField("search_part", STRING),
        T.StructField("search_url", STRING),
        T.StructField("search_page", INT),
        T.StructField("title", STRING),
        T.StructField("price_raw", STRING),
        T.StructField("subtitle", STRING),
        T.StructField("listing_url", STRING),
        T.StructField("raw_text", STRING),
    ]
)
CLEANSED_LISTINGS = T.StructType(
    RAW_LISTINGS.fields
    + T.StructType(
        [
            T.StructField("price_clean", DOUBLE),
            T.StructField("condition_guess", STRING),
            T.StructField("sold_date_guess", STRING),
            T.StructField("shipping_text", STRING),
            T.StructField("vehicle_guess", STRING),
            T.StructField("part_guess", STRING),
            T.StructField("part_number_guess", STRING),
            T.StructField("year_range_guess", STRING),
            T.StructField("years_found", STRING),
        ]
    ).fields
)
NORMALIZED_LISTINGS = T.StructType(
    CLEANSED_LISTINGS.fields
    + T.StructType(
        [
            T.StructField("search_make_std", STRING),
            T.StructField("search_model_std", STRING),
            T.StructField("search_part_std", STRING),
            T.StructField("part_guess_std", STRING),
            T.StructField("search_part_category", STRING),
            T.StructField("part_guess_category", STRING),
            T.StructField("part_category_from_text", STRING),
        ]
    ).fields
)
NORMALIZE_INPUTS = [
    "search_make",
    "search_model",
    "search_part",
    "part_guess",
    "title",
    "subtitle",
    "raw_text",
    "listing_url",
]
MARKET_SUMMARY = T.StructType(
    [
        T.StructField("run_id", STRING),
        T.StructField("scrape_ts", STRING),
        T.StructField("pass_type", STRING),
        T.StructField("search_key", STRING),
        T.StructField("execution_key", STRING),
        T.StructField("search_scope", STRING),
        T.StructField("search_year", INT),
        T.StructField("search_make", STRING),
        T.StructField("search_model", STRING),
        T.StructField("search_part", STRING),
        T.StructField("search_url", STRING),
        T.StructField("result_count", LONG),
        T.StructField("page_count_observed", INT),
    ]
)
ANALYSIS_SUMMARY = T.StructType(
    [
        T.StructField("year", INT),
        T.StructField("make", STRING),
        T.StructField("model", STRING),
        T.StructField("part", STRING),
        T.StructField("sold_count", LONG),
        T.StructField("active_count", LONG),
        T.StructField("total_count", LONG),
        T.StructField("median_price", DOUBLE),
        T.StructField("avg_price", DOUBLE),
        T.StructField("min_price", DOUBLE),
        T.StructField("max_price", DOUBLE),
        T.StructField("str", DOUBLE),
        T.StructField("confidence_score", DOUBLE),
        T.StructField("opportunity_score", DOUBLE),
        T.StructField("sold_timestamp", TIMESTAMP),
        T.StructField("active_timestamp", TIMESTAMP),
        T.StructField("time_diff_hours", DOUBLE),
        T.StructField("stale_snapshot_flag", BOOLEAN),
        T.StructField("low_sample_flag", BOOLEAN),
        T.StructField("very_low_sold_flag", BOOLEAN),
    ]
)
RANKED_PARTS = T.StructType(
    [
        T.StructField("year", INT),
        T.StructField("make", STRING),
        T.StructField("model", STRING),
        T.StructField("vehicle_key", STRING),
        T.StructField("part", STRING),
        T.StructField("median_sold_price", DOUBLE),
        T.StructField("str", DOUBLE),
        T.StructField("sold_count", LONG),
        T.StructField("active_count", LONG),
        T.StructField("confidence_score", DOUBLE),
        T.StructField("opportunity_score", DOUBLE),
        T.StructField("vehicle_rank", INT),
    ]
)
SOLD_HISTORY = T.StructType(
    [
        T.StructField("vehicle_key", STRING),
        T.StructField("search_year", INT),
        T.StructField("search_make", STRING),
        T.StructField("search_model", STRING),
        T.StructField("search_part", STRING),
        T.StructField("title", STRING),
        T.StructField("price_raw", STRING),
        T.StructField("listing_url", STRING),
        T.StructField("sold_date", DATE),
        T.StructField("scraped_at", TIMESTAMP),
    ]
)
# Stored forms: the history by scrape date, the crawl status and the price counts by day.
STORED_HISTORY = T.StructType([*SOLD_HISTORY.fields, T.StructField("scrape_date", DATE)])
CRAWL_LOG = T.StructType(
    [
        T.StructField("vehicle_key", STRING),
        T.StructField("crawl_id", STRING),
        T.StructField("search_part", STRING),
        T.StructField("last_crawled_at", TIMESTAMP),
        T.StructField("listings", LONG),
        T.StructField("status_date", DATE),
    ]
)
#: The log without its day: one row per vehicle, crawl and part.
CRAWL_TOTALS = T.StructType(CRAWL_LOG.fields[:-1])
SEEN_LISTINGS = T.StructType([T.StructField("digest", STRING), T.StructField("bucket", INT)])
PRICE_DAYS = T.StructType(
    [
        T.StructField("vehicle_key", STRING),
        T.StructField("search_part", STRING),
        T.StructField("price", DOUBLE),
        T.StructField("n", LONG),
        T.StructField("day", DATE),
    ]
)
RESULT_ITEMS = T.StructType(
    [
        T.StructField("result_set_id", LONG),
        T.StructField("part_name", STRING),
        T.StructField("sold_count", LONG),
        T.StructField("active_count", LONG),
        T.StructField("sell_through_rate", DOUBLE),
        T.StructField("median_price", DOUBLE),
        T.StructField("opportunity_score", DOUBLE),
        T.StructField("estimated_net_value", DOUBLE),
        T.StructField("recommendation", STRING),
        T.StructField("confidence_score", DOUBLE),
        T.StructField("vehicle_rank", INT),
        T.StructField("estimated_pull_minutes", INT),
        T.StructField("difficulty_score", INT),
        T.StructField("shipping_class", STRING),
        T.StructField("trend_direction", STRING),
        T.StructField("trend_pct", DOUBLE),
    ]
)
VEHICLES = T.StructType(
    [
        T.StructField("vehicle_key", STRING),
        T.StructField("year", INT),
        T.StructField("make", STRING),
        T.StructField("model", STRING),
        T.StructField("trim", STRING),
        T.StructField("series", STRING),
        T.StructField("engine", STRING),
        T.StructField("body_class", STRING),
        T.StructField("drive_type", STRING),
        T.StructField("fuel_type", STRING),
        T.StructField("created_at", TIMESTAMP),
    ]
)
CRAWL_STATUS = T.StructType(
    [
        T.StructField("vehicle_key", STRING),
        T.StructField("last_crawled_at", TIMESTAMP),
        T.StructField("parts_scraped", LONG),
        T.StructField("total_listings", LONG),
        T.StructField("updated_at", TIMESTAMP),
    ]
)

EXPORT_NAMES = {
    "median_sold_price": "median_price",
    "mean_sold_price": "avg_price",
    "min_sold_price": "min_price",
    "max_sold_price": "max_price",
}

# Which input column plays which role; pass another mapping to re-point a role.
SOLD_ROLES = {
    "year": "search_year",
    "make": "search_make",
    "model": "search_model",
    "part": "search_part_std",
    "price": "price_clean",
    "timestamp": "scrape_ts",
}
ACTIVE_ROLES = {
    "year": "search_year",
    "make": "search_make",
    "model": "search_model",
    "part": "search_part",
    "active_count": "result_count",
    "timestamp": "scrape_ts",
}
CELL = ["year", "make", "model", "part"]


def require_columns(df: DataFrame, needed: Iterable[str], label: str) -> None:
    """Raise ``ValueError`` naming the columns of ``needed`` that ``df`` lacks."""
    missing = [name for name in needed if name not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns in {label}: {missing}")


def pad_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the schema's missing columns as typed nulls; keep everything else."""
    absent = {
        field.name: F.lit(None).cast(field.dataType)
        for field in schema
        if field.name not in df.columns
    }
    return df.withColumns(absent) if absent else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a contract: its order, its types, nulls where absent."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})
