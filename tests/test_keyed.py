"""Upserts, freshness, queues, catalog lists and vehicle attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from partyard.contracts import CRAWL_STATUS, VEHICLES
from partyard.operators import catalog, keyed
from partyard.operators.value import pull_profiles

NOW = "2024-03-01 00:00:00"


def stamped(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def vehicles(spark, *rows):
    """Rows of (key, trim, engine)."""
    full = [(k, 2018, "Ford", k, t, None, e, None, None, None, "2020-01-01 00:00:00") for k, t, e in rows]
    ddl = ", ".join(f"{f.name} {'string' if f.name == 'created_at' else f.dataType.simpleString()}" for f in VEHICLES)
    return stamped(spark.createDataFrame(full, ddl), "created_at")


def test_vehicle_upsert_folds_the_delta(spark):
    stored = vehicles(spark, ("a", "old", "V6"), ("b", None, None))
    delta = (
        vehicles(spark, ("a", "new", None), ("c", None, "I4"))
        .withColumn("seq", F.lit(1))
        .unionByName(vehicles(spark, ("a", None, None), ("c", "late", None)).withColumn("seq", F.lit(2)))
        .withColumn("make", F.concat("make", F.col("seq").cast("string")))
    )
    out = keyed.upsert_vehicles(stored, delta)
    assert out.columns == stored.columns
    got = {r.vehicle_key: r for r in out.collect()}
    assert (got["a"].trim, got["a"].engine, got["a"].make) == ("new", "V6", "Ford")
    assert (got["b"].trim, got["b"].engine) == (None, None)
    assert (got["c"].trim, got["c"].engine, got["c"].make) == ("late", "I4", "Ford1")


def status(spark, *rows):
    """Rows of (key, last crawl, parts)."""
    full = [(k, t, p, 5, t) for k, t, p in rows]
    ddl = "vehicle_key string, last_crawled_at string, parts_scraped long, total_listings long, updated_at string"
    return stamped(spark.createDataFrame(full, ddl), "last_crawled_at", "updated_at")


def test_crawl_upsert(spark):
    out = keyed.upsert_crawl_status(
        status(spark, ("a", NOW, 1), ("b", NOW, 2)),
        status(spark, ("a", "2023-01-01 00:00:00", 7), ("a", "2023-01-02 00:00:00", 8), ("c", NOW, 3)),
    )
    assert out.columns == CRAWL_STATUS.names
    assert {r.vehicle_key: r.parts_scraped for r in out.collect()} == {"a": 8, "b": 2, "c": 3}


def test_crawl_queue(spark):
    fleet = vehicles(spark, *[(k, None, None) for k in "abcde"])
    crawled = status(spark, ("a", "2024-02-20 00:00:00", 1), ("b", "2024-02-01 00:00:00", 1), ("c", "2024-01-01 00:00:00", 1), ("d", "2024-02-16 00:00:00", 1))
    queue = keyed.crawl_queue(fleet, crawled, NOW)
    assert [r.vehicle_key for r in queue.collect()] == ["e", "c", "b"]
    assert keyed.crawl_queue(fleet, crawled, NOW, limit=1).count() == 1


def sets(spark, *rows):
    """Rows of (id, key, status, window, scraped, expires)."""
    ddl = "id long, vehicle_key string, status string, window_days int, scraped_at string, cache_expires_at string"
    return stamped(spark.createDataFrame(list(rows), ddl), "scraped_at", "cache_expires_at")


def test_cache_status(spark):
    fleet = vehicles(spark, *[(k, None, None) for k in "abcdefg"])
    rows = sets(
        spark,
        (1, "a", "completed", 90, "2024-02-25 00:00:00", "2024-03-10 00:00:00"),
        (2, "a", "completed", 90, "2024-02-28 00:00:00", "2024-02-29 00:00:00"),
        (3, "b", "completed", 90, "2024-01-31 00:00:00", "2024-02-14 00:00:00"),
        (4, "c", "completed", 90, "2024-01-30 00:00:00", "2024-02-13 00:00:00"),
        (5, "d", "running", 90, "2024-02-25 00:00:00", "2024-03-10 00:00:00"),
        (6, "e", "completed", 30, "2024-02-25 00:00:00", "2024-03-10 00:00:00"),
        (7, "g", "completed", 90, None, None),
    )
    got = {r.vehicle_key: (r.cache_status, r.result_set_id) for r in keyed.cache_status(fleet, rows, NOW).collect()}
    assert got == {
        "a": ("fresh", 1),
        "b": ("usable_stale", 3),
        "c": ("expired", 4),
        "d": ("missing", None),
        "e": ("missing", None),
        "f": ("missing", None),
        "g": ("missing", None),
    }


def test_recent_searches(spark):
    fleet = vehicles(spark, ("a", "t", None), ("b", None, None))
    rows = sets(
        spark,
        (1, "a", "completed", 90, "2024-02-25 00:00:00", NOW),
        (2, "a", "completed", 90, "2024-02-27 00:00:00", NOW),
        (3, "b", "completed", 90, "2024-02-26 00:00:00", NOW),
        (4, "b", "failed", 90, "2024-02-29 00:00:00", NOW),
        (5, "gone", "completed", 90, "2024-02-29 00:00:00", NOW),
    )
    out = keyed.recent_searches(fleet, rows)
    assert [(r.vehicle_key, r.result_set_id) for r in out.collect()] == [("a", 2), ("b", 3)]


def test_seeding(spark):
    seeds = spark.createDataFrame([("Ford", "F-150"), ("Kia", "Soul")], "make string, model string")
    rows = keyed.seed_rows(seeds, last_year=2024, years=2)
    assert rows.count() == 4
    known = vehicles(spark, ("2023|Ford|F-150", None, None))
    missing = keyed.seed_missing(rows, known)
    assert {r.vehicle_key for r in missing.collect()} == {"2024|Ford|F-150", "2023|Kia|Soul", "2024|Kia|Soul"}


def test_seeding_profiles(spark):
    profiles = pull_profiles(spark)
    missing = keyed.seed_missing(profiles, profiles.filter("part_name <> 'door'"), "part_name")
    assert [r.part_name for r in missing.collect()] == ["door"]


def test_result_header(spark):
    out = keyed.result_header(vehicles(spark, ("a", None, None), ("a", None, None)), NOW, window_days=30)
    (row,) = out.collect()
    assert (row.window_days, row.status, row.source) == (30, "completed", "ebay")
    assert str(row.cache_expires_at) == "2024-03-15 00:00:00"


ENTRY = "cache_type string, make string, model string, year int, names array<string>, seq int"


def test_catalog_cache(spark):
    entries = spark.createDataFrame(
        [
            ("makes", None, None, None, ["A"], 1),
            ("makes", None, None, None, ["A", "B"], 2),
            ("models", "Ford", None, 2018, [], 1),
        ],
        ENTRY,
    )
    cache = keyed.upsert_catalog(entries, "2024-02-01 00:00:00")
    assert {r.data for r in cache.collect()} == {'["A","B"]', "[]"}
    asked = entries.select("cache_type", "make", "model", "year").distinct()
    live = {r.cache_type: r.names for r in keyed.catalog_lookup(asked, cache, NOW).collect()}
    assert live == {"makes": ["A", "B"], "models": []}
    assert keyed.catalog_lookup(asked, cache, "2024-03-02 00:00:00").count() == 0


def test_catalog_lists(spark):
    rows = spark.createDataFrame(
        [
            ("Ford", "F-150", 2018, "XL"),
            ("Ford", "F-150", 2018, " "),
            ("Ford", "Edge", None, "SE"),
            ("Ford", None, 2019, None),
            ("", "x", None, None),
            (None, "y", None, None),
            ("Kia", "Soul", 2018, "EX"),
            ("Kia", "Soul", 2018, "LX"),
        ],
        "make string, model string, year int, trim string",
    )
    assert [r.make for r in catalog.make_list(rows).collect()] == ["Ford", "Kia"]
    asked = spark.createDataFrame([("Ford", 2018), ("Ford", 2019), ("Ford", 2018), ("Kia", 2020)], "make string, year int")
    got = {(r.make, r.year): r.models for r in catalog.model_lists(rows, asked).collect()}
    assert got == {("Ford", 2018): ["F-150"], ("Ford", 2019): ["Edge"], ("Kia", 2020): []}
    trims = {(r.make, r.model, r.year): r.trims for r in catalog.trim_lists(rows).collect()}
    assert trims[("Kia", "Soul", 2018)] == ["EX", "LX"]
    assert trims[("Ford", "F-150", 2018)] == ["XL"]


def test_vin_profiles(spark):
    good, bad = "1hgcm82633a004352", "1HGCM82633A00435X"
    rows = [
        (good, "Model Year", "2003", 1),
        (good, "Make", " HONDA ", 2),
        (good, "Model", "Accord", 3),
        (good, "Trim", "EX", 4),
        (good, "Trim", "LX", 5),
        (good, "Trim", "Not Applicable", 6),
        (good, "Series", "", 7),
        (good, "Body Class", "Coupe", 8),
        (good, "Drive Type", "FWD", 9),
        (good, "Displacement (L)", "3.0", 10),
        (good, "Engine Configuration", "V-Shaped", 11),
        (good, "Engine Number of Cylinders", "6", 12),
        (good, "Fuel Type - Primary", "Gasoline", 13),
        (good, "Plant City", "MARYSVILLE", 14),
        (bad, "Make", "HONDA", 1),
        (bad, "Model", "Accord", 2),
        ("short", "Model Year", "2003", 1),
        ("short", "Make", "x", 2),
        ("short", "Model", "x", 3),
    ]
    df = spark.createDataFrame(rows, "vin string, variable string, value string, seq int")
    (one,) = catalog.vin_profiles(df).collect()
    assert tuple(one) == (good.upper(), 2003, "HONDA", "Accord", "LX", None, "Coupe", "FWD", "3.0L V6", "Gas")


def test_vin_profiles_sort_behind_their_only_shuffle(spark):
    """A scan task holds no rows: what sorts or combines them gets a share of the VINs."""
    df = spark.createDataFrame([("1hgcm82633a004352", "Make", "HONDA", 1)], "vin string, variable string, value string, seq int")
    plan = catalog.vin_profiles(df)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning")
    assert "Sort" in above and "Aggregate" in above
    assert "Sort" not in below and "Aggregate" not in below


def test_totals_and_counts(spark):
    attempts = spark.createDataFrame([("a", "door"), ("a", "hood"), ("a", "door"), ("b", "door")], "vehicle_key string, search_part string")
    listings = spark.createDataFrame([("a",)] * 3, "vehicle_key string")
    totals = keyed.crawl_totals(attempts, listings, F.lit(NOW).cast("timestamp"))
    assert {r.vehicle_key: (r.parts_scraped, r.total_listings) for r in totals.collect()} == {"a": (2, 3), "b": (1, 0)}
    counts = keyed.table_counts({"x": attempts, "y": listings})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"x": 4, "y": 3}
    newest = keyed.latest_rows(spark.range(30), "id", ["id"])
    assert [r.id for r in newest.collect()] == list(range(29, 19, -1))


def test_pages_join_to_the_lists(spark):
    """A make with most of the names spans ranges; pages in their order are the whole list."""
    ids = spark.range(0, 3000, numPartitions=3)
    year = F.when(F.col("id") % 3 == 0, F.lit(2018))
    make = F.when(F.col("id") % 10 < 8, F.lit("Hot")).when(F.col("id") % 10 == 8, F.lit("Rare"))
    model = F.when(F.col("id") % 7 != 0, F.concat(F.lit("m"), F.col("id") % 1300))
    rows = ids.select(make.alias("make"), model.alias("model"), year.alias("year"), F.lit(" ").alias("trim"))
    asked = spark.createDataFrame([("Hot", 2018), ("Hot", 2019), ("Rare", 2018), ("None", 2018)], "make string, year int")
    pages = catalog.model_pages(rows, asked, 50).collect()
    lists = {(r.make, r.year): r.models for r in catalog.model_lists(rows, asked).collect()}
    got = {}
    for r in sorted(pages, key=lambda r: (r.make, r.year, r.page)):
        assert r.page * 50 == len(got.setdefault((r.make, r.year), []))
        assert len(r.models) <= 50
        got[r.make, r.year] += r.models
    assert got == lists
    assert len(lists["Hot", 2019]) > 500 and lists["None", 2018] == []
    assert catalog.trim_pages(rows).count() == 0
    whole = catalog.name_pages(rows.select("make", "model"), ["make"], "model", 10_000)
    assert {r.make for r in whole.collect()} == {"Hot", "Rare", None}
