"""Tables under a manifest: batches, merges, keyed buckets, price counts by day."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyard.contracts import SOLD_HISTORY
from partyard.operators import keyed, price_days, trend
from partyard.operators.seen import SeenListings
from partyard.sources import folders, history
from partyard.streaming import ingest

DAYS = T.StructType([T.StructField("n", T.LongType()), T.StructField("day", T.DateType())])


def numbers(spark, *ns, day="2024-01-01"):
    return spark.createDataFrame([(n,) for n in ns], "n long").withColumn("day", F.lit(day).cast("date"))


def content(table):
    return sorted(r.n for r in table.current().collect())


def test_two_hundred_batches_read_few_files(spark, tmp_path):
    table = folders.BatchTable(spark, str(tmp_path / "t"), DAYS, "day")
    for batch in range(200):
        folder = tmp_path / "t" / "batches" / "stream=s" / f"batch={batch}"
        (folder / f"day=2024-01-0{1 + batch % 3}").mkdir(parents=True)
        pq.write_table(pa.table({"n": [batch]}), folder / f"day=2024-01-0{1 + batch % 3}" / "part-0.parquet")
        (folder / "_SUCCESS").touch()
        if batch % 25 == 24:
            table.compact()
            table.vacuum()
    assert content(table) == list(range(200))
    days = 3
    assert len(table.current().inputFiles()) <= days * (folders.MOST_FOLDERS + 1)
    stored = sum(name.endswith(".parquet") for _, _, names in os.walk(tmp_path / "t" / "data") for name in names)
    assert stored <= 2 * days * (folders.MOST_FOLDERS + 1)
    assert len(os.listdir(tmp_path / "t" / "batches" / "stream=s")) <= 50


def test_days_are_pruned(spark, tmp_path):
    table = folders.BatchTable(spark, str(tmp_path / "t"), DAYS, "day")
    for batch, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-03")):
        table.write_batch(numbers(spark, batch, day=day), "s", batch)
    table.compact()
    plan = table.current().filter("day = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert [r.n for r in table.current().filter("day = DATE'2024-01-02'").collect()] == [1]


def test_repeated_and_broken_batches_count_once(spark, tmp_path):
    path = str(tmp_path / "t")
    table = folders.BatchTable(spark, path, DAYS, "day")
    table.write_batch(numbers(spark, 1, 2), "s", 0)
    table.write_batch(numbers(spark, 1, 2), "s", 0)
    table.write_batch(numbers(spark, 3), "s", 1)
    assert content(table) == [1, 2, 3]
    assert table.compact() and not table.compact()
    # The stream stops before it has committed the batch and repeats it after the merge.
    table.write_batch(numbers(spark, 3), "s", 1)
    assert content(table) == [1, 2, 3]
    # A batch without its success marker does not count yet.
    table.write_batch(numbers(spark, 4), "s", 2)
    os.remove(f"{path}/batches/stream=s/batch=2/_SUCCESS")
    assert content(table) == [1, 2, 3]
    table.write_batch(numbers(spark, 4), "s", 2)
    table.write_batch(numbers(spark, 5), "other", 0)
    table.write_batch(numbers(spark).filter("false"), "other", 1)
    assert content(table) == [1, 2, 3, 4, 5]
    table.compact()
    table.vacuum(1)
    assert content(table) == [1, 2, 3, 4, 5]
    assert table.manifest().marks == {"s": 2, "other": 1}


def test_a_merge_that_dies_before_its_manifest(spark, tmp_path, monkeypatch):
    table = folders.BatchTable(spark, str(tmp_path / "t"), DAYS, "day")
    table.write_batch(numbers(spark, 1), "s", 0)
    table.compact()
    table.write_batch(numbers(spark, 2), "s", 1)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(folders, "publish_snapshot", dies)
        with pytest.raises(RuntimeError):
            table.compact()
    assert content(table) == [1, 2]
    assert table.compact()
    table.vacuum(1)
    assert content(table) == [1, 2]


def test_null_days_and_empty_tables(spark, tmp_path):
    table = folders.BatchTable(spark, str(tmp_path / "t"), DAYS, "day")
    assert content(table) == [] and not table.compact()
    table.vacuum()
    table.write_batch(spark.createDataFrame([(1, None), (2, None)], DAYS), "s", 0)
    table.compact()
    table.write_batch(spark.createDataFrame([(3, None)], DAYS), "s", 1)
    assert content(table) == [1, 2, 3]


def files(table):
    return {f for f in table.rows().inputFiles()}


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    schema = T._parse_datatype_string("vehicle_key string, parts_scraped long, updated_at timestamp, last_crawled_at timestamp")
    table = folders.KeyedTable(spark, str(tmp_path / "t"), schema, "vehicle_key", 8)

    def rows(keys, parts):
        return spark.createDataFrame([(k, parts) for k in keys], "vehicle_key string, parts_scraped long").withColumns(
            {c: F.lit("2024-01-01").cast("timestamp") for c in ("updated_at", "last_crawled_at")}
        )

    keys = [f"2018|Ford|{k}" for k in range(80)] + [None]
    table.merge(rows(keys, 1), keyed.upsert_crawl_status)
    before = files(table)
    table.merge(rows(["2018|Ford|3", "new"], 2), keyed.upsert_crawl_status)
    after = files(table)
    assert len(before & after) >= 6 and after - before
    got = {r.vehicle_key: r.parts_scraped for r in table.rows().collect()}
    assert got == {k: 1 for k in keys} | {"2018|Ford|3": 2, "new": 2}
    assert table.look_up("new").first().parts_scraped == 2
    assert {f.split("bucket=")[1].split("/")[0] for f in table.look_up("new").inputFiles()} == {
        str(spark.sql("select pmod(xxhash64('new'), 8)").first()[0])
    }
    with pytest.raises(ValueError):
        folders.KeyedTable(spark, str(tmp_path / "t"), schema, "vehicle_key", 16).merge(rows(["x"], 1), keyed.upsert_crawl_status)


def test_an_upsert_that_dies_before_its_manifest(spark, tmp_path, monkeypatch):
    schema = T._parse_datatype_string("vehicle_key string, n long")
    table = folders.KeyedTable(spark, str(tmp_path / "t"), schema, "vehicle_key", 4)

    def newest(stored, delta):
        return keyed.latest_per_key(stored.unionByName(delta), ["vehicle_key"], F.desc("n"))

    def delta(n):
        return spark.createDataFrame([("a", n), ("b", n)], schema)

    table.merge(delta(1), newest)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(folders, "publish_snapshot", dies)
        with pytest.raises(RuntimeError):
            table.merge(delta(2), newest)
    assert {r.n for r in table.rows().collect()} == {1}
    table.merge(delta(3), newest)
    table.vacuum(1)
    assert {r.n for r in table.rows().collect()} == {3}


def sold(spark, rows):
    """Rows of (model, part, price, time)."""
    df = spark.createDataFrame(
        [(f"2018|Ford|{m}", 2018, "Ford", m, p, "t", x, "u", None, t) for m, p, x, t in rows],
        "vehicle_key string, search_year int, search_make string, search_model string, search_part string, title string,"
        "price_raw string, listing_url string, sold_date date, scraped_at timestamp",
    )
    return df


def scanned(spark, df):
    """Rows the file scan of a plan gives out when it runs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return leaves.apply(0).metrics().get("numOutputRows").get().value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_vehicle_s_rows_are_found_without_reading_the_others(spark, tmp_path):
    path = str(tmp_path / "h")
    rng = random.Random(3)
    rows = spark.range(40_000).select(
        F.concat(F.lit("2018|Ford|M"), F.md5((F.col("id") % 4_000).cast("string"))).alias("vehicle_key"),
        F.concat(F.lit("part "), (F.col("id") % 7).cast("string")).alias("search_part"),
        F.lit("$5").alias("price_raw"),
        (F.lit("2024-01-20").cast("timestamp") + F.make_interval(days=(F.col("id") % 2).cast("int"))).alias("scraped_at"),
    )
    wanted = rows.filter("search_part = 'part 3'").select("vehicle_key").limit(50).collect()[rng.randrange(50)][0]
    for old, new in (("parquet.block.size", "65536"),):
        spark._jsc.hadoopConfiguration().set(old, new)
    try:
        history.append_history(rows, path)
    finally:
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
    stored = spark.read.parquet(path)
    found = history.vehicle_listings(stored, wanted, "part 3", "2024-02-01", 30)
    assert {(r.vehicle_key, r.search_part) for r in found.collect()} == {(wanted, "part 3")}
    assert found.count() == rows.filter((F.col("vehicle_key") == wanted) & (F.col("search_part") == "part 3")).count()
    assert scanned(spark, history.vehicle_listings(stored, wanted, "part 3", "2024-02-01", 30)) < 10_000
    # A key between others, in no row: every group's filter or dictionary denies it.
    assert scanned(spark, history.vehicle_listings(stored, "2018|Ford|M77", "part 3", "2024-02-01", 30)) < 4_000


@pytest.mark.parametrize("as_of", ["2024-02-14 00:00:00", "2024-02-14 12:30:00", "2024-02-13 23:59:59.999999"])
def test_trend_from_price_days(spark, tmp_path, as_of):
    rng = random.Random(7)
    start = datetime(2023, 12, 1)
    rows = [
        (
            rng.choice(["F-150", "f-150 ", "Focus"]),
            rng.choice(["door", "headlamp", "hood"]),
            rng.choice(["$5.00", "$9", "$1,250.50", "call", None, f"${rng.randrange(1, 400)}"]),
            start + timedelta(hours=rng.randrange(24 * 90)),
        )
        for _ in range(900)
    ]
    edges = [datetime.fromisoformat(as_of) - timedelta(days=d, microseconds=u) for d in (30, 60) for u in (-1, 0, 1)]
    rows += [("F-150", "door", "$700", t) for t in edges]
    listings = sold(spark, rows)
    table = price_days.price_table(spark, str(tmp_path / "p"))
    for batch in range(4):
        table.write_batch(price_days.daily_prices(listings.filter(F.pmod(F.hash("title", "scraped_at"), F.lit(4)) == batch)), "s", batch)
        if batch == 2:
            table.compact()
    direct = trend.price_trend(listings, as_of)
    stored = price_days.trend_from_days(table.current(), listings, as_of)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))


def test_a_trend_of_whole_days_reads_counts_only(spark, tmp_path):
    listings = sold(spark, [("F-150", "door", "$5", datetime(2024, 2, 1))])
    listings.write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    days = price_days.daily_prices(listings)
    whole = price_days.trend_from_days(days, stored, "2024-02-14")
    assert "FileScan" not in whole._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in price_days.trend_from_days(days, stored, "2024-02-14 06:00:00")._jdf.queryExecution().executedPlan().toString()


def test_a_stream_merges_its_outputs(spark, tmp_path):
    from tests.test_streaming import card, land

    landed = str(tmp_path / "landed")
    paths = {f"{k}_path": str(tmp_path / k) for k in ("history", "status", "checkpoint", "prices")}
    for page in range(5):
        schema = land(spark, landed, (f"p{page}", f"part {page % 2}", 1 + page % 2, card(f"t{page}", f"/{page}")))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    ingest.ingest_pages(stream, compact_every=2, **paths).awaitTermination()
    assert sorted(r.title for r in ingest.ingested_history(spark, paths["history_path"]).collect()) == [f"t{k}" for k in range(5)]
    assert ingest.history_table(spark, paths["history_path"]).manifest().version == 2
    (status,) = ingest.current_crawl_status(spark, paths["status_path"]).collect()
    assert (status.parts_scraped, status.total_listings) == (1, 2)
    days = price_days.price_table(spark, paths["prices_path"]).current()
    assert {(str(r.day), r.price, r.n) for r in days.collect()} == {("2024-02-01", 5.0, 3), ("2024-02-02", 5.0, 2)}
    assert set(SOLD_HISTORY.names) < set(ingest.ingested_history(spark, paths["history_path"]).columns)


def urls(spark, *pairs):
    return sold(spark, [("F-150", "door", "$5", datetime(2024, 2, 1))] * len(pairs)).limit(0).unionByName(
        spark.createDataFrame(
            [("2018|Ford|F-150", 2018, "Ford", "F-150", "door", t, "$5", u, None, datetime(2024, 2, 1)) for t, u in pairs],
            "vehicle_key string, search_year int, search_make string, search_model string, search_part string, title string,"
            "price_raw string, listing_url string, sold_date date, scraped_at timestamp",
        )
    )


def test_addresses_are_remembered_for_good(spark, tmp_path):
    seen = SeenListings(spark, str(tmp_path / "seen"))
    first = urls(spark, ("a", "/1?x=1"), ("b", "/2"), ("c", ""), ("d", None))
    new = seen.unseen(first, "s", 0)
    assert sorted(r.title for r in new.collect()) == ["a", "b", "c", "d"]
    seen.add(new, "s", 0)
    # The batch is repeated after a failure: it does not meet itself.
    assert seen.unseen(first, "s", 0).count() == 4
    later = urls(spark, ("a again", "/1?x=2"), ("e", "/3"), ("e copy", "/3?y=1"), ("f", ""))
    found = sorted(r.title for r in seen.unseen(later, "s", 1).collect())
    assert len(found) == 2 and found[0] in ("e", "e copy") and found[1] == "f"
    seen.compact()
    seen.vacuum(1)
    assert seen.unseen(later, "other", 0).count() == 2
    assert seen.unseen(urls(spark), "s", 2).count() == 0


def test_a_second_run_appends_nothing(spark, tmp_path):
    from tests.test_streaming import card, land

    landed = str(tmp_path / "landed")
    stored = {f"{k}_path": str(tmp_path / k) for k in ("history", "status", "seen")}
    for page in range(3):
        schema = land(spark, landed, (f"p{page}", "door", 1 + page, card(f"t{page}", f"/{page}?s={page}") + card("same", "/x")))
    for run in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        ingest.ingest_pages(stream, checkpoint_path=str(tmp_path / f"checkpoint-{run}"), compact_every=2, **stored).awaitTermination()
        rows = ingest.ingested_history(spark, stored["history_path"]).collect()
        assert sorted(r.title for r in rows) == ["same", "t0", "t1", "t2"]
