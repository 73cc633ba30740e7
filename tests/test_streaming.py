"""Incremental ingest of landed pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from partyard.streaming import ingest

DDL = "page_id string, vehicle_key string, search_year int, search_make string, search_model string, search_part string, scraped_at string, html string"


def card(title, url):
    link = f'<a class="s-card__link" href="{url}">x</a>' if url else ""
    return f'<li class="s-card"><div class="s-card__title">{title}</div><span class="s-card__price">$5</span>{link}</li>'


def land(spark, folder, *pages):
    """Pages of (id, part, day, html) of one vehicle."""
    rows = [(i, "2018|Ford|F-150", 2018, "Ford", "F-150", p, f"2024-02-{d:02d} 00:00:00", h) for i, p, d, h in pages]
    df = spark.createDataFrame(rows, DDL).withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


@pytest.mark.parametrize("drop_repeats, expected", [(False, 7), (True, 5)])
def test_ingest(spark, tmp_path, drop_repeats, expected):
    landed = str(tmp_path / "landed")
    paths = {f"{k}_path": str(tmp_path / k) for k in ("history", "status", "checkpoint")}

    def run(schema):
        stream = spark.readStream.schema(schema).parquet(landed)
        ingest.ingest_pages(stream, drop_repeats=drop_repeats, **paths).awaitTermination()

    schema = land(
        spark,
        landed,
        ("p1", "door", 1, card("a", "/1?x=1") + card("b", "") + card("c", "")),
        ("p2", "hood", 1, "<html>no cards</html>"),
    )
    run(schema)
    run(schema)
    first = ingest.current_crawl_status(spark, paths["status_path"]).collect()
    assert [(r.parts_scraped, r.total_listings) for r in first] == [(2, 3)]
    land(
        spark,
        landed,
        ("p3", "door", 2, card("a again", "/1?x=2") + card("d", "/2")),
        ("p4", "door", 2, card("d again", "/2") + card("e", "/3")),
    )
    run(schema)
    rows = ingest.ingested_history(spark, paths["history_path"]).collect()
    assert len(rows) == expected
    assert {"a", "b", "c", "e"} <= {r.title for r in rows}
    (latest,) = ingest.current_crawl_status(spark, paths["status_path"]).collect()
    assert latest.parts_scraped == 1
    assert latest.total_listings == expected - 3
    assert str(latest.last_crawled_at) == "2024-02-02 00:00:00"


def run_in_single_files(spark, tmp_path, *pages, **options):
    landed = str(tmp_path / "landed")
    paths = {f"{k}_path": str(tmp_path / k) for k in ("history", "status", "checkpoint")}
    for page in pages:
        schema = land(spark, landed, page)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    ingest.ingest_pages(stream, **options, **paths).awaitTermination()
    return paths


@pytest.mark.parametrize("drop_repeats", [False, True])
def test_a_crawl_over_several_batches(spark, tmp_path, drop_repeats):
    paths = run_in_single_files(
        spark,
        tmp_path,
        ("p1", "door", 1, card("a", "/1")),
        ("p2", "hood", 1, card("b", "/2")),
        ("p3", "visor", 1, card("c", "/3")),
        drop_repeats=drop_repeats,
    )
    (status,) = ingest.current_crawl_status(spark, paths["status_path"]).collect()
    assert (status.parts_scraped, status.total_listings) == (3, 3)


def test_late_pages_are_kept(spark, tmp_path):
    """An old crawl that lands two months after a newer one loses nothing."""
    landed = str(tmp_path / "landed")
    paths = {f"{k}_path": str(tmp_path / k) for k in ("history", "status", "checkpoint")}
    for day, url in (("2024-03-01", "/1"), ("2024-01-01", "/2"), ("2024-01-02", "/1?x=9")):
        rows = [(url, "2018|Ford|F-150", 2018, "Ford", "F-150", "door", day, card("t", url))]
        df = spark.createDataFrame(rows, DDL).withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(df.schema).parquet(landed)
        ingest.ingest_pages(stream, drop_repeats=True, **paths).awaitTermination()
    rows = ingest.ingested_history(spark, paths["history_path"]).collect()
    assert sorted(r.listing_url for r in rows) == ["/1", "/2"]


def test_totals_are_kept_as_state(spark, tmp_path):
    """Totals over several runs and batches equal those of the log; old buckets stay."""
    landed = str(tmp_path / "landed")
    totals = str(tmp_path / "totals")
    paths = {f"{k}_path": str(tmp_path / k) for k in ("history", "status", "checkpoint")}

    def run(schema):
        def stream():
            return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)

        ingest.ingest_pages(stream(), **paths).awaitTermination()
        ingest.count_crawls(stream(), totals_path=totals, checkpoint_path=str(tmp_path / "counting")).awaitTermination()
        table = ingest.totals_table(spark, totals)
        log = ingest.status_table(spark, paths["status_path"]).current().drop("status_date")
        assert sorted(map(tuple, table.rows().collect())) == sorted(map(tuple, log.select(table.rows().columns).collect()))
        assert ingest.newest_crawls(table.rows()).collect() == ingest.current_crawl_status(spark, paths["status_path"]).collect()
        return table.manifest()

    for page in (("p1", "door", 1, card("a", "/1")), ("p2", "hood", 1, "<html></html>"), ("p3", "door", 1, card("b", "/2"))):
        schema = land(spark, landed, page)
    first = run(schema)
    assert run(schema) == first
    land(spark, landed, ("p4", "door", 1, card("c", "/3")))
    land(spark, landed, ("p5", "visor", 2, card("d", "/4")))
    assert run(schema).version == first.version + 2


def test_pages_of_one_file_are_several_tasks(spark):
    """Equal ids or null ones do not bring the pages together again."""
    page = F.concat(F.lit(card("a", "/")), F.col("id"))
    texts = [F.lit("x").alias(c) for c in ("vehicle_key", "search_make", "search_model", "search_part")]
    landed = spark.range(0, 100, numPartitions=1).select(
        F.lit(None).cast("string").alias("page_id"), *texts, F.lit(2018).alias("search_year"), F.lit("2024-02-01").cast("timestamp").alias("scraped_at"), page.alias("html")
    )
    tasks = ingest.page_rows(landed).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 200
