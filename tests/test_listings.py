"""Cleansing, normalization and de-duplication."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from partyard.contracts import NORMALIZED_LISTINGS, RAW_LISTINGS, conform, pad_columns, require_columns
from partyard.operators.cleanse import cleanse, real_titles, without_heavy_duty
from partyard.operators.normalize import dedup_stats, deduplicate, normalize, normalize_raw, standardize_listings

DEDUP = "listing_url string, title string, price double, search_make_std string, search_model_std string, search_part_std string"
CAR = ("Nissan", "Rogue", "radiator")


def raw(spark, *rows):
    base = {
        "run_id": "r", "scrape_ts": "2025-12-01 07:15:00", "pass_type": "sold", "search_year": 2018,
        "search_make": "Toyota", "search_model": "Camry", "search_part": "alternator",
        "search_url": "u", "search_page": 1, "title": "t", "price_raw": "$1", "subtitle": None,
        "listing_url": None, "raw_text": "t",
    }
    names = RAW_LISTINGS.names
    data = [tuple({**base, **row}[n] for n in names) for row in rows]
    return spark.createDataFrame(data, RAW_LISTINGS)


def test_require_columns_names_the_missing(spark):
    df = spark.range(1).withColumn("search_year", F.lit(2018))
    with pytest.raises(ValueError, match="search_model"):
        require_columns(df, ["search_year", "search_model"], "sold_df")


def test_pad_and_conform(spark):
    df = spark.createDataFrame([("a",)], "title string")
    padded = pad_columns(df, RAW_LISTINGS)
    assert set(padded.columns) == set(RAW_LISTINGS.names)
    shaped = conform(df, RAW_LISTINGS)
    assert shaped.columns == RAW_LISTINGS.names
    assert shaped.schema["search_year"].dataType == RAW_LISTINGS["search_year"].dataType


def test_cleanse_then_normalize(spark):
    rows = raw(
        spark,
        {
            "search_year": 2014, "search_make": "honda", "search_model": "crv", "search_part": "rim",
            "title": "Honda  CR-V  starter  59810-31207", "subtitle": "local pickup only",
            "price_raw": "US $1,048.50 ", "listing_url": "https://shop.example/item/77?ref=mail",
            "raw_text": "Honda CR-V starter 2013 Sold Mar 9, 2023 $7.25 shipping", "search_page": 3,
        },
        {
            "search_year": 2014, "search_make": "HONDA", "search_model": "CR-V", "search_part": "wheel",
            "listing_url": "https://shop.example/item/77?ref=home", "search_page": 4,
        },
        {"search_part": "grille", "title": "Front grille", "listing_url": "https://shop.example/item/78#a"},
    )
    cleansed = cleanse(rows)
    first = cleansed.filter("search_part = 'rim'").first()
    assert first.title == "Honda CR-V starter 59810-31207"
    assert first.price_clean == 1048.5
    assert first.vehicle_guess == "Honda Cr-V"
    assert first.part_guess == "starter"
    assert first.part_number_guess == "59810-31207"
    assert first.sold_date_guess == "Mar 9, 2023"
    assert first.shipping_text == "$7.25 shipping"
    assert first.years_found == "2013, 2023"
    out = normalize(cleansed)
    assert out.columns == NORMALIZED_LISTINGS.names
    got = {r.listing_url: r for r in out.collect()}
    assert set(got) == {"https://shop.example/item/77", "https://shop.example/item/78#a"}
    kept = got["https://shop.example/item/77"]
    assert kept.search_page == 3
    assert (kept.search_make_std, kept.search_model_std) == ("Honda", "CR-V")
    assert kept.search_part_std == "wheel"
    assert kept.part_guess_std == "starter"
    assert kept.part_category_from_text == "Starter"


def test_dropping_copies_first_changes_nothing(spark):
    urls = ["https://x/1?a=1", "https://x/1?a=2", "", None, "  ", "https://x/2"]
    rows = raw(
        spark,
        *[
            {"listing_url": url, "title": title, "search_page": page, "price_raw": f"${page}"}
            for url in urls
            for title in ("Used  headlight", "", None)
            for page in (2, 1)
        ],
    )
    fast = normalize_raw(rows)
    assert fast.columns == NORMALIZED_LISTINGS.names
    assert sorted(map(str, fast.collect())) == sorted(map(str, normalize(cleanse(rows)).collect()))
    assert fast.count() == 4


def test_normalize_pads_absent_columns(spark):
    row = ("run-7", "2025-11-30T18:45:00+00:00", "sold", 2016, "dodge ram", "ram 1500", "coil pack", "shock absorber", "Pair of rear strut units", "tested", "Pair of rear strut units, tested")
    names = "run_id string, scrape_ts string, pass_type string, search_year int, search_make string, search_model string, search_part string, part_guess string, title string, subtitle string, raw_text string, listing_url string"
    df = spark.createDataFrame([(*row, f"https://shop.example/lot/5?from={k}") for k in range(3)], names)
    (one,) = normalize(df).collect()
    assert one.listing_url == "https://shop.example/lot/5"
    assert (one.search_make_std, one.search_model_std, one.search_part_std) == ("Ram", "1500", "ignition coil")
    assert (one.search_part_category, one.part_guess_category) == ("Ignition Coil", "Strut / Shock")
    stats = dedup_stats(standardize_listings(df)).first()
    assert (stats.before_count, stats.after_count, stats.removed_count) == (3, 1, 2)
    assert stats.removed_rate == 2 / 3


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("k7", "x", 41.0), ("k7", "y", 41.5), ("k9", "z", 12.0)], 2),
        ([("k1", "x", 9.0), ("k2", "x", 9.0)], 2),
        ([("", "x", 3.0), ("", "x", 3.0), (None, "x", 8.0)], 2),
        ([(None, None, None), ("", "", None)], 1),
    ],
)
def test_deduplicate(spark, rows, expected):
    df = spark.createDataFrame([(*row, *CAR) for row in rows], DEDUP)
    kept = deduplicate(df)
    assert kept.count() == expected
    assert kept.filter("listing_url = '' OR title = ''").count() == 0
    stats = dedup_stats(df).first()
    assert (stats.before_count, stats.after_count) == (len(rows), expected)


def test_deduplicate_needs_the_address(spark):
    df = spark.createDataFrame([("a", 1.0)], "title string, price double")
    with pytest.raises(ValueError, match="Missing required columns"):
        deduplicate(df)


def test_dedup_sends_one_row_per_key_and_task(spark):
    df = spark.createDataFrame([("u", "a", 1.0, *CAR)] * 50, DEDUP)
    plan = deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedup_stats_of_nothing(spark):
    stats = dedup_stats(spark.createDataFrame([], DEDUP)).first()
    assert stats.asDict() == {
        "before_count": 0, "after_count": 0, "removed_count": 0, "removed_rate": 0.0,
    }


def test_title_filters(spark):
    rows = raw(spark, {"title": "Shop on eBay"}, {"title": "F250 door", "search_make": "Ford"}, {"title": "ok"})
    assert real_titles(rows).count() == 2
    assert {r.title for r in without_heavy_duty(rows).collect()} == {"Shop on eBay", "ok"}
