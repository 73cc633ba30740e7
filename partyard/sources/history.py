"""Stored sold rows: recency scans, history-first resolution, active snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyard import rules
from partyard.contracts import MARKET_SUMMARY, RAW_LISTINGS, SOLD_HISTORY, conform
from partyard.functions import keys
from partyard.sources.folders import bloom_filters

PAIR = ["vehicle_key", "search_part"]


def since(as_of: datetime | str, days: int) -> Column:
    return F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days))


def recent_listings(
    history: DataFrame, as_of: datetime | str, days: int = rules.RECENT_DAYS
) -> DataFrame:
    """History rows not older than ``days``; filter by key for one lookup.

    The cut is a constant, so it prunes date partitions and row groups.
    """
    cut = since(as_of, days)
    rows = history.filter(F.col("scraped_at") >= cut)
    if "scrape_date" in history.columns:
        rows = rows.filter(F.col("scrape_date") >= F.to_date(cut))
    return rows


def listing_history(
    history: DataFrame, as_of: datetime | str, days: int = rules.HISTORY_DAYS
) -> DataFrame:
    """The narrow scan behind the price trend."""
    return recent_listings(history, as_of, days).select(
        *PAIR, "price_raw", "scraped_at", "sold_date"
    )


def newest_first(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc("scraped_at"))


def _as_raw(rows: DataFrame, run_id: str, as_of: datetime | str, url: Column) -> DataFrame:
    return conform(
        rows.withColumns(
            {
                "run_id": F.lit(run_id),
                "scrape_ts": F.date_format(F.lit(as_of).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"),
                "pass_type": F.lit("sold"),
                "search_url": url,
                "search_page": F.lit(1),
                "subtitle": F.lit(None).cast("string"),
                "listing_url": F.coalesce(F.col("listing_url"), F.lit("")),
                "raw_text": F.col("title"),
            }
        ),
        RAW_LISTINGS,
    )


def history_first(
    history: DataFrame,
    parsed: DataFrame,
    *,
    run_id: str,
    as_of: datetime | str,
    days: int = rules.RECENT_DAYS,
) -> DataFrame:
    """Raw listings per vehicle and part: recent history, else parsed pages.

    The anti join sees each recent pair once: pairs are made distinct inside
    the map tasks before the shuffle.
    """
    recent = recent_listings(history, as_of, days)
    fresh = parsed.join(recent.select(*PAIR).distinct(), PAIR, "left_anti")
    url = F.col("search_url") if "search_url" in parsed.columns else F.lit("")
    stored = _as_raw(recent, run_id, as_of, F.lit(rules.HISTORY_SOURCE_LABEL))
    return stored.unionByName(_as_raw(fresh, run_id, as_of, url))


def active_snapshot(
    grid: DataFrame, counts: DataFrame, *, run_id: str, scrape_ts: Column
) -> DataFrame:
    """One supply row per grid cell; a cell without a landed count has 0."""
    cell = ["search_year", "search_make", "search_model", "search_part"]
    columns = [F.col(c) for c in cell]
    joined = grid.select(*cell).join(counts.select(*cell, "result_count"), cell, "left")
    return conform(
        joined.withColumns(
            {
                "run_id": F.lit(run_id),
                "scrape_ts": scrape_ts,
                "pass_type": F.lit("all"),
                "search_key": keys.search_key(*columns),
                "execution_key": keys.execution_key(*columns, F.lit("all")),
                "search_scope": F.lit("all"),
                "search_url": F.lit(rules.COUNT_API_URL),
                "result_count": F.coalesce(F.col("result_count").cast("long"), F.lit(0).cast("long")),
                "page_count_observed": F.lit(1),
            }
        ),
        MARKET_SUMMARY,
    )


#: Buckets that keep the rows of a vehicle together inside a day.
KEY_BUCKETS = 64


def append_history(rows: DataFrame, path: str) -> None:
    """Append parsed rows to the history, one folder per scrape date.

    Rows are clustered by date and key bucket before the write, which keeps the number
    of files down and a vehicle's rows of a day in one or few of them; they are sorted
    by lookup key inside each file and have Bloom filters over it.  Rebalancing merges
    small buckets and splits large ones.
    """
    dated = conform(rows, SOLD_HISTORY).withColumns(
        {"scrape_date": F.to_date("scraped_at"), "_bucket": F.pmod(F.xxhash64("vehicle_key"), F.lit(KEY_BUCKETS))}
    )
    sorted_ = (
        dated.hint("rebalance", "scrape_date", "_bucket")
        .sortWithinPartitions("scrape_date", *PAIR, F.desc("scraped_at"))
        .drop("_bucket")
    )
    bloom_filters(sorted_.write, PAIR).mode("append").partitionBy("scrape_date").parquet(path)


def vehicle_listings(
    history: DataFrame,
    vehicle_key: str,
    search_part: str,
    as_of: datetime | str,
    days: int = rules.RECENT_DAYS,
) -> DataFrame:
    """Recent rows of one vehicle and part, newest first.

    Both keys are pushed into the scan: of the days in the window, only row groups that
    may hold the key are read.
    """
    wanted = (F.col("vehicle_key") == vehicle_key) & (F.col("search_part") == search_part)
    return newest_first(recent_listings(history.filter(wanted), as_of, days))
