"""Price counts per day, kept beside the history, and the trend read from them.

A day's counts are merged by addition, so each batch of listings adds its own and no
stored row is read again.  A trend adds up the whole days of its windows; only where a
window starts within a day are that day's listings read.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partyard import rules
from partyard.contracts import PRICE_DAYS
from partyard.operators.trend import KEYS, price_counts, trend_of_counts
from partyard.sources.folders import BatchTable

def daily_prices(rows: DataFrame, match: str = "normalized") -> DataFrame:
    """Listings per pair, price and scrape day; a null price stands for rows without one."""
    return price_counts(rows, {"day": F.to_date("scraped_at")}, match).select(*PRICE_DAYS.names)


def _fold(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS, "day", "price").agg(F.sum("n").alias("n"))


def price_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, PRICE_DAYS, "day", _fold)


def trend_from_days(
    days: DataFrame,
    history: DataFrame,
    as_of: datetime | str,
    *,
    window_days: int = rules.TREND_WINDOW_DAYS,
    min_prices: int = rules.TREND_MIN_PRICES,
    match: str = "normalized",
) -> DataFrame:
    """The trend of ``price_trend``, from stored daily counts.

    ``days`` must cover the same rows as ``history`` under the same ``match``.  The
    history is read for the days in which a window starts at another time than
    midnight: at most two, none for an ``as_of`` at midnight.
    """
    now = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    starts = {"recent": now - timedelta(days=window_days), "prior": now - timedelta(days=2 * window_days)}
    first = {name: t.date() + timedelta(days=t != datetime.combine(t.date(), datetime.min.time())) for name, t in starts.items()}
    split = sorted({t.date() for name, t in starts.items() if t.date() < first[name]})
    day = F.col("day")
    whole = days.filter((day >= first["prior"]) & ~day.isin(split) if split else day >= first["prior"])
    counts = (
        whole.withColumn("recent", day >= first["recent"]).groupBy(*KEYS, "recent", "price").agg(F.sum("n").alias("n"))
    )
    if split:
        seen = F.col("scraped_at")
        rows = history.filter(F.to_date(seen).isin(split) & (seen >= F.lit(starts["prior"])))
        if "scrape_date" in history.columns:
            rows = rows.filter(F.col("scrape_date").isin(split))
        parts = price_counts(rows, {"recent": seen >= F.lit(starts["recent"])}, match)
        counts = counts.unionByName(parts).groupBy(*KEYS, "recent", "price").agg(F.sum("n").alias("n"))
    return trend_of_counts(counts, min_prices)
