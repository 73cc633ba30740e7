"""Hot keys: one address, cell or vehicle holds a third of all rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from partyard.operators.keyed import latest_per_key
from partyard.operators.market import sold_summary
from partyard.operators.normalize import dedup_stats, deduplicate
from partyard.operators.trend import price_trend

ROWS = 30_000


@pytest.fixture(scope="module")
def listings(spark):
    hot = F.col("id") % 3 == 0
    cents = F.pmod(F.xxhash64("id"), F.lit(50_000))
    return spark.range(0, ROWS, numPartitions=6).select(
        "id",
        F.when(hot, "u").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("listing_url"),
        F.lit(2018).alias("search_year"),
        F.lit("Ford").alias("search_make"),
        F.when(hot, "F-150").otherwise(F.concat(F.lit("m"), F.col("id") % 50)).alias("search_model"),
        F.lit("door").alias("search_part_std"),
        (cents / 100.0).alias("price_clean"),
        F.lit("2024-01-01 00:00:00").alias("scrape_ts"),
    )


def test_copies_collapse_to_the_first(listings):
    kept = deduplicate(listings, [F.col("id").asc()])
    got = kept.agg(F.count("*").alias("n"), F.min(F.when(F.col("listing_url") == "u", F.col("id"))).alias("first")).first()
    assert (got.n, got.first) == (ROWS * 2 // 3 + 1, 0)
    assert dedup_stats(listings).first().after_count == got.n


def test_hot_cell_is_exact(listings):
    got = {r.model: r for r in sold_summary(listings).collect()}
    frame = listings.select("search_model", "price_clean").toPandas()
    assert len(got) == frame.search_model.nunique()
    for model, prices in frame.groupby("search_model").price_clean:
        kept = prices[(prices >= np.percentile(prices, 5)) & (prices <= np.percentile(prices, 95))]
        assert got[model].sold_count == len(prices)
        assert got[model].median_sold_price == pytest.approx(kept.median(), rel=1e-12)
        assert got[model].mean_sold_price == pytest.approx(kept.mean(), rel=1e-9)


def test_hot_pair_trend_is_exact(listings):
    history = listings.select(
        F.lit("k").alias("vehicle_key"),
        "search_year",
        "search_make",
        "search_model",
        F.col("search_part_std").alias("search_part"),
        F.concat(F.lit("$"), F.col("price_clean").cast("decimal(10,2)").cast("string")).alias("price_raw"),
        F.when(F.col("id") % 2 == 0, F.lit("2024-02-20"))
        .otherwise(F.lit("2024-01-20"))
        .cast("timestamp")
        .alias("scraped_at"),
    )
    got = price_trend(history, "2024-03-01 00:00:00").filter("vehicle_key = '2018|ford|f-150'").first()
    frame = listings.filter("search_model = 'F-150' AND price_clean > 0").select("id", "price_clean").toPandas()
    recent = frame[frame.id % 2 == 0].price_clean.median()
    assert got.current_avg == round(recent, 2)


def test_latest_row_of_a_hot_key(listings):
    rows = latest_per_key(listings, ["search_model"], F.desc("id"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    newest = {r.search_model: r.id for r in rows.collect()}
    assert newest["F-150"] == ROWS - 3
