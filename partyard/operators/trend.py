"""Price trend of a part from its stored sold rows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions.keys import lookup_vehicle_key
from partyard.functions.numeric import round_exact
from partyard.functions.scoring import trend_label
from partyard.functions.standardize import standardize_part
from partyard.functions.text import first_price
from partyard.operators.market import PriceRanks
from partyard.sources.history import recent_listings, since

KEYS = ["vehicle_key", "search_part"]


def price_trend(
    history: DataFrame,
    as_of: datetime | str,
    *,
    window_days: int = rules.TREND_WINDOW_DAYS,
    min_prices: int = rules.TREND_MIN_PRICES,
    match: str = "normalized",
) -> DataFrame:
    """Median price of the last window against the window before it.

    A pair with too few prices in either window has direction ``new``.  With
    ``match='normalized'`` rows are grouped under the lookup key and the
    standard part; with ``'exact'`` under the stored ones.  The time filter
    comes first, so only the two windows' partitions and four columns are read.
    """
    windowed = recent_listings(history, as_of, 2 * window_days)
    recent = F.col("scraped_at") >= since(as_of, window_days)
    return trend_of_counts(price_counts(windowed, {"recent": recent}, match), min_prices)


def price_counts(rows: DataFrame, by: Mapping[str, Column], match: str = "normalized") -> DataFrame:
    """Rows per pair, price and the given columns, counted inside the map tasks.

    Rows without a usable price still name a pair that must be reported; their price
    is null.
    """
    if match == "normalized":
        key = lookup_vehicle_key(
            F.col("search_year"), F.col("search_make"), F.col("search_model")
        )
        part = standardize_part(F.col("search_part"))
    else:
        key, part = F.col("vehicle_key"), F.col("search_part")
    read = rows.select(
        key.alias("vehicle_key"),
        part.alias("search_part"),
        *(column.alias(name) for name, column in by.items()),
        first_price(F.col("price_raw")).alias("price"),
    )
    priced = F.when(F.col("price") > 0, F.col("price"))
    return read.withColumn("price", priced).groupBy(*KEYS, *by, "price").agg(F.count("*").alias("n"))


def trend_of_counts(histogram: DataFrame, min_prices: int = rules.TREND_MIN_PRICES) -> DataFrame:
    """The trend from prices counted per pair and window (``recent`` or not)."""
    period = [*KEYS, "recent"]
    ranks = PriceRanks(period)
    middle = (F.col("priced") - 1) / 2
    medians = (
        ranks.counted(histogram)
        .groupBy(*period)
        .agg(
            F.max("priced").alias("prices"),
            (
                (F.max(ranks.at(F.floor(middle))) + F.max(ranks.at(F.ceil(middle)))) / 2.0
            ).alias("median"),
        )
    )
    enough = F.col("prices") >= min_prices
    pairs = medians.groupBy(*KEYS).agg(
        F.max(F.when(F.col("recent") & enough, F.col("median"))).alias("current"),
        F.max(F.when(~F.col("recent") & enough, F.col("median"))).alias("prior"),
    )
    usable = F.col("current").isNotNull() & (F.col("prior") > 0)
    percent = F.when(usable, (F.col("current") - F.col("prior")) / F.col("prior") * 100.0)
    return pairs.withColumn("_percent", percent).select(
        *KEYS,
        F.coalesce(trend_label(F.col("_percent")), F.lit("new")).alias("direction"),
        round_exact(F.col("_percent"), 1).alias("pct_change"),
        round_exact(F.col("current"), 2).alias("current_avg"),
        F.when(usable, round_exact(F.col("prior"), 2)).alias("prior_avg"),
    )
