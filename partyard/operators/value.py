"""Net value, verdict and trend attached to ranked parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyard import rules
from partyard.contracts import RESULT_ITEMS, conform
from partyard.functions import scoring
from partyard.functions.keys import lookup_vehicle_key
from partyard.functions.standardize import standardize_part

ITEM_BUCKETS = 64

_TYPES = {str: T.StringType(), int: T.IntegerType(), float: T.DoubleType()}


def pull_profiles(spark: SparkSession) -> DataFrame:
    """The built-in pull profiles, one row per part."""
    schema = T.StructType([T.StructField(n, _TYPES[t]) for n, t in rules.PROFILE_FIELDS])
    return spark.createDataFrame(rules.PULL_PROFILES, schema)


def with_net_value(
    ranked: DataFrame,
    profiles: DataFrame | None = None,
    *,
    fee_percent: float = rules.FEE_PERCENT,
    labor_rate: float = rules.LABOR_RATE,
    tolerance: str | None = None,
) -> DataFrame:
    """Add net value, verdict and the pull profile of each part.

    The built-in profiles are a few dozen literal rows and are broadcast.  A
    table passed by the caller has no known size; Spark picks that join.  A
    median price of 0 counts as missing.
    """
    if profiles is None:
        profiles = F.broadcast(pull_profiles(ranked.sparkSession))
    costs = profiles.select(
        F.col("part_name").alias("_part"),
        "estimated_pull_minutes",
        "difficulty_score",
        "shipping_class",
        "estimated_shipping_cost",
        "estimated_yard_cost",
    )
    joined = ranked.join(costs, F.lower(F.trim(F.col("part"))) == F.col("_part"), "left")
    valued = joined.withColumn(
        "estimated_net_value",
        scoring.net_value(
            F.nullif(F.col("median_sold_price"), F.lit(0.0)),
            F.col("estimated_shipping_cost"),
            F.col("estimated_yard_cost"),
            F.col("estimated_pull_minutes"),
            fee_percent=fee_percent,
            labor_rate=labor_rate,
        ),
    )
    return valued.withColumn(
        "recommendation",
        scoring.verdict(F.col("estimated_net_value"), F.col("str"), tolerance),
    ).select(
        *ranked.columns,
        "estimated_net_value",
        "recommendation",
        "estimated_pull_minutes",
        "difficulty_score",
        "shipping_class",
    )


def with_trend(valued: DataFrame, trend: DataFrame, *, match: str = "normalized") -> DataFrame:
    """Attach the price trend of each part; parts without history read ``new``.

    ``trend`` comes from ``price_trend`` with the same ``match``.  ``exact``
    compares the lower-cased lookup key with the stored key as it is, which
    finds nothing for vehicles stored in mixed case.
    """
    left_part = F.lower(F.trim(F.col("part")))
    if match == "normalized":
        left_part = standardize_part(F.col("part"))
    left_key = lookup_vehicle_key(F.col("year"), F.col("make"), F.col("model"))
    side = trend.select(
        F.col("vehicle_key").alias("_key"),
        F.col("search_part").alias("_part"),
        F.col("direction"),
        F.col("pct_change").alias("trend_pct"),
    )
    joined = valued.join(side, (left_key == F.col("_key")) & (left_part == F.col("_part")), "left")
    return joined.select(
        *valued.columns,
        F.coalesce(F.col("direction"), F.lit("new")).alias("trend_direction"),
        "trend_pct",
    )


def result_items(enriched: DataFrame, result_set_id, *, zero_as_null: bool = False) -> DataFrame:
    """Enriched parts as stored result items.

    ``zero_as_null`` stores a sell-through rate or median of 0 as null.
    """
    share, median = F.col("str"), F.col("median_sold_price")
    if zero_as_null:
        share, median = F.nullif(share, F.lit(0.0)), F.nullif(median, F.lit(0.0))
    key = result_set_id if not isinstance(result_set_id, int) else F.lit(result_set_id)
    named = enriched.withColumns(
        {
            "result_set_id": key,
            "part_name": F.col("part"),
            "sell_through_rate": share,
            "median_price": median,
        }
    )
    return conform(named, RESULT_ITEMS)


def store_items(items: DataFrame, path: str) -> None:
    """Append result items, one folder per bucket of set ids, sorted by set inside files.

    A lookup opens one folder and skips the row groups of other sets.
    """
    (
        items.withColumn("bucket", F.pmod("result_set_id", F.lit(ITEM_BUCKETS)).cast("int"))
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "result_set_id", "vehicle_rank")
        .write.mode("append")
        .partitionBy("bucket")
        .parquet(path)
    )


def stored_items(spark: SparkSession, path: str, result_set_id: int) -> DataFrame:
    """The items of one stored result set, best rank first."""
    rows = spark.read.parquet(path).filter(
        (F.col("bucket") == result_set_id % ITEM_BUCKETS) & (F.col("result_set_id") == result_set_id)
    )
    return rows.drop("bucket").orderBy("vehicle_rank")
