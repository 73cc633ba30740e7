"""Sold summaries, scores, ranking, net value and trend."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from partyard.contracts import ANALYSIS_SUMMARY, CELL, RANKED_PARTS, RESULT_ITEMS
from partyard.operators.market import active_summary, analysis_summary, export_summary, sold_summary
from partyard.operators.ranking import rank_parts, top_parts
from partyard.operators.selection import price_bin
from partyard.operators.trend import price_trend
from partyard.operators.value import pull_profiles, result_items, with_net_value, with_trend
from partyard.plans.analysis import enrich

SOLD = "search_year int, search_make string, search_model string, search_part_std string, price_clean double, scrape_ts string"
ACTIVE = "search_year int, search_make string, search_model string, search_part string, result_count int, scrape_ts string"


def sold(spark, *rows):
    """Rows of (part, price[, year, make, timestamp]) for one model."""
    full = []
    for part, price, *rest in rows:
        year, make, seen = [*rest, *(2018, "Toyota", "2025-09-03 06:00:00")[len(rest) :]]
        full.append((year, make, "Camry", part, price, seen))
    return spark.createDataFrame(full, SOLD)


def active(spark, *rows):
    full = []
    for part, count, *rest in rows:
        year, make, seen = [*rest, *(2018, "Toyota", "2025-09-03 08:00:00")[len(rest) :]]
        full.append((year, make, "Camry", part, count, seen))
    return spark.createDataFrame(full, ACTIVE)


def by_part(df):
    return {r.part: r for r in df.collect()}


def test_summary_of_two_parts(spark):
    seen = (2018, "Toyota", "2025-09-03 06:00:00")
    got = by_part(
        analysis_summary(
            sold(spark, *(("radiator", p, *seen) for p in (61.0, 75.0, 95.5)), ("seat", 44.0, *seen)),
            active(spark, ("radiator", 5, 2018, "Toyota", "2025-09-03 10:30:00"), ("seat", 9)),
        )
    )
    r, s = got["radiator"], got["seat"]
    assert (r.sold_count, r.active_count, r.median_sold_price, r.str) == (3, 5, 75.0, 0.375)
    assert (s.sold_count, s.active_count, s.median_sold_price, s.str) == (1, 9, 44.0, 0.1)
    assert (r.confidence_score, s.confidence_score) == (0.36, 0.34)
    assert r.opportunity_score == 10.125
    assert r.time_diff_hours == 4.5
    assert (r.stale_snapshot_flag, r.low_sample_flag, r.very_low_sold_flag) == (False, True, False)


def test_sold_summary_groups(spark):
    prices = [12.5, None, 40.0, 19.0, 28.5]
    rows = sold(spark, *(("grille", p, 2013, "Ram", f"2025-09-0{k} 06:00:00") for k, p in enumerate(prices, 1)))
    (one,) = sold_summary(rows).collect()
    assert (one.sold_count, one.median_sold_price, one.mean_sold_price) == (4, 23.75, 25.0)
    assert (one.min_sold_price, one.max_sold_price) == (12.5, 40.0)
    assert str(one.sold_timestamp) == "2025-09-05 06:00:00"


def test_cells_without_price_and_null_keys_stay(spark):
    rows = sold(spark, ("door", None), ("door", None, 2018, None), ("seat", 5.0, 2018, None))
    got = {(r.make, r.part): r for r in sold_summary(rows).collect()}
    assert set(got) == {("Toyota", "door"), (None, "door"), (None, "seat")}
    empty = got[("Toyota", "door")]
    assert empty.sold_count == 0
    assert [empty.median_sold_price, empty.mean_sold_price, empty.sold_timestamp] == [None] * 3
    joined = analysis_summary(rows, active(spark, ("seat", 4, 2018, None)))
    assert {(r.make, r.part): r.active_count for r in joined.collect()}[(None, "seat")] == 4
    score = {(r.make, r.part): (r.str, r.opportunity_score) for r in joined.collect()}
    assert score[("Toyota", "door")] == (0.0, 0.0)


@pytest.mark.parametrize("size", [1, 2, 19, 20, 21, 40, 61])
def test_trimmed_statistics_match_brute_force(spark, size):
    random.seed(size)
    prices = [round(random.choice([5.0, 9.99, random.uniform(1, 500)]), 2) for _ in range(size)]
    (one,) = sold_summary(sold(spark, *[("door", p) for p in prices])).collect()
    kept = np.array(prices)
    if size >= 20:
        low, high = np.percentile(kept, [5, 95])
        kept = kept[(kept >= low) & (kept <= high)]
    assert one.sold_count == size
    assert one.median_sold_price == np.median(kept)
    assert one.mean_sold_price == pytest.approx(kept.mean(), rel=1e-12)
    assert (one.min_sold_price, one.max_sold_price) == (min(prices), max(prices))


def test_hot_cell_is_counted_before_the_second_shuffle(spark):
    plan = sold_summary(sold(spark, ("door", 1.0)))._jdf.queryExecution().executedPlan().toString()
    scan_side = plan[plan.index("Sort [") :]
    assert "partial_count" in scan_side
    assert "collect_list" not in plan and "percentile" not in plan


@pytest.mark.parametrize("size", [1, 19, 20, 41, 400])
def test_many_prices_match_brute_force(spark, size):
    random.seed(size)
    kinds = [lambda: random.uniform(20, 30), lambda: 25 + random.random() * 1e-9, lambda: 0.0, lambda: -random.expovariate(1)]
    prices = [random.choice(kinds)() for _ in range(size)]
    rows = sold(spark, *[("door", p) for p in prices], ("hood", None), ("hood", float("nan")), ("seat", 5.5, 2018, None))
    got = {r.part: r for r in sold_summary(rows, many_prices=True).collect()}
    kept = np.array(prices)
    if size >= 20:
        low, high = np.percentile(kept, [5, 95])
        kept = kept[(kept >= low) & (kept <= high)]
    one = got["door"]
    assert (one.sold_count, one.median_sold_price) == (size, np.median(kept))
    assert one.mean_sold_price == pytest.approx(kept.mean(), rel=1e-9)
    assert (one.min_sold_price, one.max_sold_price) == (min(prices), max(prices))
    assert (got["hood"].sold_count, got["hood"].median_sold_price, got["hood"].mean_sold_price) == (0, None, None)
    assert (got["seat"].make, got["seat"].median_sold_price) == (None, 5.5)
    assert sold_summary(rows.limit(0), many_prices=True).count() == 0


def test_bins_rise_with_the_price(evaluate):
    values = [-float("inf"), -1e300, -2.0, -5e-324, 0.0, 5e-324, 1.0, 1.0000001, 1.001, 3.0, 1e300, float("inf")]
    bins = evaluate(price_bin, *values, None, kind="double")
    assert bins[-1] is None and bins[:-1] == sorted(bins[:-1])
    assert bins[3] < bins[4] < bins[5] and bins[6] == bins[7] < bins[8]


def test_active_rows_are_not_aggregated(spark):
    rows = active(spark, ("door", 3, 2018, "T", "2026-04-10 10:00:00"), ("door", 5, 2018, "T", "2025-09-03 06:00:00"))
    prepared = active_summary(rows)
    assert prepared.columns == [*CELL, "active_count", "timestamp"]
    assert sorted(r.active_count for r in prepared.collect()) == [3, 5]
    fanned = analysis_summary(sold(spark, ("door", 1.0, 2018, "T")), rows)
    assert sorted(r.active_count for r in fanned.collect()) == [3, 5]


def test_missing_supply_is_zero_and_year_is_a_key(spark):
    rows = sold(spark, ("door", 100.0), ("door", 150.0, 2019))
    got = {r.year: r for r in analysis_summary(rows, active(spark, ("door", 3))).collect()}
    assert (got[2018].active_count, got[2019].active_count) == (3, 0)
    assert got[2019].str == 1.0
    assert got[2019].time_diff_hours is None
    assert got[2019].stale_snapshot_flag is False


def test_stale_flag_and_unreadable_times(spark):
    rows = sold(spark, ("door", 1.0, 2018, "T", "2025-09-01 07:00:00"), ("seat", 1.0, 2018, "T", "soon"))
    got = by_part(analysis_summary(rows, active(spark, ("door", 1, 2018, "T"), ("seat", 1, 2018, "T"))))
    assert got["door"].time_diff_hours == 49.0
    assert got["door"].stale_snapshot_flag is True
    assert got["seat"].sold_timestamp is None
    assert got["seat"].stale_snapshot_flag is False


def test_aliased_supply(spark):
    rows, supply = sold(spark, ("ecu", 9.0)), active(spark, ("ecm", 7))
    assert analysis_summary(rows, supply).first().active_count == 0
    assert analysis_summary(rows, supply, standardize_active=True).first().active_count == 7


def test_export_contract(spark):
    exported = export_summary(analysis_summary(sold(spark, ("door", 1.0)), active(spark)))
    assert exported.columns == ANALYSIS_SUMMARY.names
    assert exported.first().median_price == 1.0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="price_clean"):
        sold_summary(sold(spark, ("a", 1.0)).drop("price_clean"))


SUMMARY = "year int, make string, model string, part string, median_sold_price double, str double, sold_count long, active_count long, confidence_score double, opportunity_score double"


def summary(spark, *rows):
    """Rows of (part, opportunity, active, median)."""
    return spark.createDataFrame(
        [(2018, "Toyota", "Camry", part, m, 0.5, 1, a, 0.5, o) for part, o, a, m in rows], SUMMARY
    )


def test_rank_order_and_ties(spark):
    rows = summary(
        spark,
        ("b", 5.0, 1, 1.0),
        ("a", 5.0, 1, 1.0),
        ("c", 5.0, 2, 1.0),
        ("d", 5.0, 1, 9.0),
        ("e", 7.0, 0, None),
        ("f", None, 9, 9.0),
        (None, 5.0, 1, 1.0),
    )
    ranked = rank_parts(rows)
    assert ranked.columns == RANKED_PARTS.names
    order = [r.part for r in ranked.orderBy("vehicle_rank").collect()]
    assert order == ["e", "c", "d", "a", "b", None, "f"]
    assert [r.part for r in top_parts(ranked, 2).orderBy("vehicle_rank").collect()] == ["e", "c"]
    plan = top_parts(ranked, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_net_value_join(spark):
    ranked = rank_parts(summary(spark, (" Alternator ", 9.0, 1, 200.0), ("spoiler", 8.0, 1, 100.0), ("door", 7.0, 1, 0.0)))
    got = {r.part: r for r in with_net_value(ranked).collect()}
    assert got[" Alternator "].estimated_net_value == round(200 - 26 - 20 - 45 - 40 / 60 * 25, 2)
    assert got[" Alternator "].recommendation == "Pull"
    assert got[" Alternator "].shipping_class == "medium"
    assert (got["spoiler"].estimated_net_value, got["spoiler"].difficulty_score) == (87.0, None)
    assert (got["door"].estimated_net_value, got["door"].recommendation) == (None, "Skip")
    own = with_net_value(ranked, pull_profiles(spark).filter("part_name = 'none'"), tolerance="high")
    assert {r.part: r.estimated_net_value for r in own.collect()}[" Alternator "] == 174.0


HISTORY = "vehicle_key string, search_year int, search_make string, search_model string, search_part string, price_raw string, scraped_at timestamp"
AS_OF = "2024-03-01 00:00:00"


def history(spark, recent, prior, part="Alternator"):
    rows = [("2018|Toyota|Camry", 2018, "Toyota", "Camry", part, p, "2024-02-15 00:00:00") for p in recent]
    rows += [("2018|Toyota|Camry", 2018, "Toyota", "Camry", part, p, "2024-01-10 00:00:00") for p in prior]
    rows += [("2018|Toyota|Camry", 2018, "Toyota", "Camry", part, "$999", "2023-12-01 00:00:00")]
    df = spark.createDataFrame(rows, HISTORY.replace("timestamp", "string"))
    return df.withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))


@pytest.mark.parametrize(
    "recent, prior, expected",
    [
        (["$110", "$1 to $2", "$120", "$130"], ["$100"] * 3, ("up", 15.0, 115.0, 100.0)),
        (["$90"] * 3, ["$100"] * 4, ("down", -10.0, 90.0, 100.0)),
        (["$105"] * 3, ["$100"] * 3, ("neutral", 5.0, 105.0, 100.0)),
        (["$105"] * 2, ["$100"] * 3, ("new", None, None, None)),
        (["$105"] * 3, ["$100"] * 2, ("new", None, 105.0, None)),
        (["$105", "$0", "call", "$1"], ["$100"] * 3, ("new", None, None, None)),
    ],
)
def test_price_trend(spark, recent, prior, expected):
    (one,) = price_trend(history(spark, recent, prior), AS_OF).collect()
    assert (one.vehicle_key, one.search_part) == ("2018|toyota|camry", "alternator")
    assert (one.direction, one.pct_change, one.current_avg, one.prior_avg) == expected


def test_trend_window_edges(spark):
    rows = [("k", 2018, "a", "b", "p", "$10", t) for t in ("2024-01-31 00:00:00",) * 3 + ("2024-01-01 00:00:00",) * 3]
    df = spark.createDataFrame(rows, HISTORY.replace("timestamp", "string"))
    df = df.withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    (one,) = price_trend(df, AS_OF).collect()
    assert (one.direction, one.current_avg, one.prior_avg) == ("neutral", 10.0, 10.0)


def test_trend_join_modes(spark):
    ranked = rank_parts(summary(spark, ("alternator", 9.0, 1, 200.0), ("door", 1.0, 1, 1.0)))
    rows = history(spark, ["$110"] * 3, ["$100"] * 3)
    got = {r.part: r for r in enrich(ranked, rows, AS_OF).collect()}
    assert (got["alternator"].trend_direction, got["alternator"].trend_pct) == ("up", 10.0)
    assert (got["door"].trend_direction, got["door"].trend_pct) == ("new", None)
    exact = enrich(ranked, rows, AS_OF, match="exact")
    assert {r.trend_direction for r in exact.collect()} == {"new"}


def test_result_items(spark):
    ranked = rank_parts(summary(spark, ("door", 1.0, 1, 0.0))).withColumn("str", F.lit(0.0))
    enriched = with_trend(with_net_value(ranked), price_trend(history(spark, [], []), AS_OF))
    kept = result_items(enriched, 7).first()
    assert result_items(enriched, 7).columns == RESULT_ITEMS.names
    assert (kept.result_set_id, kept.part_name) == (7, "door")
    assert (kept.sell_through_rate, kept.median_price) == (0.0, 0.0)
    nulled = result_items(enriched, 7, zero_as_null=True).first()
    assert (nulled.sell_through_rate, nulled.median_price) == (None, None)
