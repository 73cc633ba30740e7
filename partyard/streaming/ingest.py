"""Incremental ingest of landed result pages into the sold history."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from partyard.contracts import CRAWL_LOG, CRAWL_TOTALS, STORED_HISTORY
from partyard.functions.text import blank_to_null, strip_query
from partyard.operators import price_days
from partyard.operators.keyed import latest_per_key
from partyard.operators.seen import SeenListings
from partyard.session import spread
from partyard.sources.folders import BatchTable, KeyedTable
from partyard.sources.pages import is_listing, listing_rows, split_cards

PAGE_COLUMNS = [
    "page_id",
    "vehicle_key",
    "search_year",
    "search_make",
    "search_model",
    "search_part",
    "scraped_at",
    "crawl_id",
]
REPEAT_KEY = ["vehicle_key", "search_part", "_address"]


def page_rows(pages: DataFrame) -> DataFrame:
    """One marker row per page (place 0, no fields) and one row per card.

    The marker keeps the fact that a page was crawled when it has no card left.
    Pages without a ``crawl_id`` belong to the crawl of their day.  Pages are dealt out
    before they are parsed: those of one landed file would else be one task.
    """
    if "crawl_id" not in pages.columns:
        pages = pages.withColumn("crawl_id", F.to_date("scraped_at").cast("string"))
    cards = split_cards(F.col("html"))
    dealt = spread(pages.select(*PAGE_COLUMNS, "html"), "page_id", "html")
    return listing_rows(dealt, F.array_insert(cards, 1, F.lit(None)), "place")


def without_repeats(rows: DataFrame, delay: str) -> DataFrame:
    """Drop listings that arrived before, by address without its query.

    What counts is when a page arrives, not when it was crawled, so a late page of an
    old crawl is never dropped as such; ``delay`` only bounds how long an address is
    remembered.  Rows without an address must not fall together, so they and the page
    markers get an address of their own.
    """
    own = F.concat_ws("#", F.col("page_id").cast("string"), F.col("place").cast("string"))
    address = F.coalesce(blank_to_null(strip_query(F.col("listing_url"))), own)
    return (
        rows.withColumns({"_address": address, "_arrived": F.current_timestamp()})
        .withWatermark("_arrived", delay)
        .dropDuplicatesWithinWatermark(REPEAT_KEY)
        .drop("_address", "_arrived")
    )


def status_rows(rows: DataFrame) -> DataFrame:
    """Listings and newest time of every vehicle, crawl and part among page rows."""
    counted = rows.groupBy("vehicle_key", "crawl_id", "search_part").agg(
        F.max("scraped_at").alias("last_crawled_at"), F.count("title").alias("listings")
    )
    return counted.withColumn("status_date", F.to_date("last_crawled_at"))


def _fold_status(rows: DataFrame) -> DataFrame:
    """Rows of one vehicle, crawl and part added up; they stay under their newest day."""
    return rows.groupBy("vehicle_key", "crawl_id", "search_part").agg(
        F.max("last_crawled_at").alias("last_crawled_at"),
        F.sum("listings").alias("listings"),
        F.max("status_date").alias("status_date"),
    )


def history_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, STORED_HISTORY, "scrape_date")


def status_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, CRAWL_LOG, "status_date", _fold_status)


def ingest_pages(
    pages: DataFrame,
    *,
    history_path: str,
    status_path: str,
    checkpoint_path: str,
    prices_path: str | None = None,
    seen_path: str | None = None,
    drop_repeats: bool = False,
    delay: str = "14 days",
    compact_every: int | None = 50,
) -> StreamingQuery:
    """Parse newly landed pages, append listings, log crawl status; then stop.

    Each output is a table under a manifest: a batch is stored under its number, and
    after every ``compact_every`` batches the stored ones are merged into a few folders
    per day.  A batch that is repeated after a failure replaces itself, or is left out
    if a merge has taken it in, so the append is exactly-once; see ``folders``.  Which
    batch stands for what is told by the checkpoint, so the stream is named after it and
    a stream with a new checkpoint cannot overwrite older batches.  With ``prices_path``
    daily price counts are kept for the trend.

    Repeats: ``drop_repeats`` remembers addresses in the state store for ``delay``; with
    ``seen_path`` they are kept beside the history for good, so a second run over the
    same pages, by whatever stream, appends nothing.  Pages count for the crawl status
    with all their listings then.
    """
    stream = md5(checkpoint_path.encode()).hexdigest()[:12]
    rows = page_rows(pages).filter((F.col("place") == 0) | is_listing())
    if drop_repeats:
        rows = without_repeats(rows, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        # All writes read the parsed batch; a lost block is parsed again.
        batch = batch.persist()
        try:
            spark = batch.sparkSession
            listings = batch.filter("title IS NOT NULL")
            seen = SeenListings(spark, seen_path) if seen_path else None
            if seen:
                listings = seen.unseen(listings, stream, batch_id).persist()
            outputs = [
                (history_table(spark, history_path), listings.withColumn("scrape_date", F.to_date("scraped_at"))),
                (status_table(spark, status_path), status_rows(batch)),
            ]
            if prices_path:
                outputs.append((price_days.price_table(spark, prices_path), price_days.daily_prices(listings)))
            for table, found in outputs:
                table.write_batch(found, stream, batch_id)
            # Addresses are stored and merged after the listings they stand for.
            if seen:
                seen.add(listings, stream, batch_id)
            if compact_every and batch_id % compact_every == compact_every - 1:
                for table in [t for t, _ in outputs] + ([seen] if seen else []):
                    table.compact()
                    table.vacuum()
            if seen:
                listings.unpersist()
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def ingested_history(spark: SparkSession, history_path: str) -> DataFrame:
    """The appended listings; the scrape date stays for partition pruning."""
    return history_table(spark, history_path).current()


def totals_table(spark: SparkSession, path: str) -> KeyedTable:
    """Totals per vehicle, crawl and part, in buckets by vehicle."""
    return KeyedTable(spark, path, CRAWL_TOTALS, "vehicle_key")


def _replace_totals(stored: DataFrame, newer: DataFrame) -> DataFrame:
    keys = ["vehicle_key", "crawl_id", "search_part"]
    named = newer.select([F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return stored.join(named, same, "left_anti").unionByName(newer)


def count_crawls(pages: DataFrame, *, totals_path: str, checkpoint_path: str) -> StreamingQuery:
    """Keep the totals of every crawl as streaming state; then stop.

    The state store holds one row per vehicle, crawl and part, so a batch costs its own
    pages and the rows it changes, and no log is read again.  Only changed rows come
    out and replace theirs in the buckets of ``totals_table``.  They are whole totals,
    not increments: a batch repeated after a failure writes the same rows again.  Late
    pages count whenever they come, so state is kept for good; a large one belongs on
    the RocksDB provider.
    """
    rows = page_rows(pages).filter((F.col("place") == 0) | is_listing())

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                table = totals_table(batch.sparkSession, totals_path)
                table.merge(batch, _replace_totals)
                table.vacuum()
        finally:
            batch.unpersist()

    return (
        status_rows(rows)
        .drop("status_date")
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def current_crawl_status(spark: SparkSession, status_path: str) -> DataFrame:
    """Parts and listings of each vehicle's newest crawl, over all batches that held it."""
    return newest_crawls(status_table(spark, status_path).current())


def newest_crawls(totals: DataFrame) -> DataFrame:
    """Status of each vehicle's newest crawl from totals per vehicle, crawl and part."""
    crawls = (
        totals.groupBy("vehicle_key", "crawl_id")
        .agg(
            F.max("last_crawled_at").alias("last_crawled_at"),
            F.countDistinct("search_part").alias("parts_scraped"),
            F.sum("listings").alias("total_listings"),
        )
        .withColumn("updated_at", F.col("last_crawled_at"))
    )
    newest = [F.desc("updated_at"), F.desc("crawl_id")]
    return latest_per_key(crawls, ["vehicle_key"], *newest).drop("crawl_id")
