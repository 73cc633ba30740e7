"""Registered queries: each runs an operator of the engine on whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partyard import rules
from partyard.contracts import RANKED_PARTS
from partyard.functions.keys import lookup_vehicle_key
from partyard.functions.numeric import round_scaled
from partyard.functions.standardize import standardize_make
from partyard.functions.text import is_heavy_duty, is_junk_title
from partyard.operators import catalog, keyed, market, paired, price_days, ranking, trend, value
from partyard.operators import normalize as norm
from partyard.operators.cleanse import clean_columns, cleanse
from partyard.operators.seen import SeenListings
from partyard.plans.analysis import analyze, enrich
from partyard.session import apply_settings, settle, shared_dir
from partyard.sources import files, folders, grid, history, pages
from partyard.streaming import ingest
from queryset.views import AS_OF, ORDERS_AS_OF, Inputs

HISTORY_AS_OF = "2024-02-05 00:00:00"
PAIR = ("alternator", "headlight")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query over the inputs under its function name."""

    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(run(Inputs(apply_settings(spark), sf_dir)))

    call.__name__ = run.__name__
    QUERIES[run.__name__] = call
    return run


def _portable(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, so both engines hash the same values."""
    kinds = dict(df.dtypes)
    dated = [c for c in df.columns if kinds[c] in ("timestamp", "timestamp_ntz", "date")]
    return df.withColumns({c: F.col(c).cast("string") for c in dated}) if dated else df


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: round_scaled(F.col(c), n) for c, n in digits.items()})


# -- search grid ------------------------------------------------------------


@query
def search_grid(i: Inputs) -> DataFrame:
    return grid.search_grid(i.grid_vehicles, first_year=2012, last_year=2013)


@query
def pending_searches(i: Inputs) -> DataFrame:
    cells = grid.search_grid(i.grid_vehicles, first_year=2012, last_year=2013)
    return grid.pending_searches(cells, i.completed_searches).select("execution_key")


# -- landed pages and history -----------------------------------------------


def _landed(i: Inputs) -> DataFrame:
    """Landed pages with their text: at most 60 cards are put on one page."""
    cards = F.array_sort(F.collect_list(F.struct("card_id", "card")))
    html = i.card_html.groupBy("page_id").agg(
        F.concat(
            F.lit("<html><ul class='results'>"),
            F.array_join(F.transform(cards, lambda c: c.card), ""),
            F.lit("</ul></html>"),
        ).alias("html")
    )
    return i.landed_pages.join(html, "page_id")


def _page_rows(i: Inputs) -> DataFrame:
    return pages.page_listings(_landed(i))


@query
def page_cards(i: Inputs) -> DataFrame:
    return _page_rows(i).withColumn("position_in_page", F.col("position_in_page").cast("long"))


@query
def foreign_pages(i: Inputs) -> DataFrame:
    """Raw pages of other sites behind one card each: the card ends before the page."""
    card = F.concat(
        F.lit('<li class="s-card"><div class="s-card__title">Page <b>'),
        F.col("page_id").cast("string"),
        F.lit('</b></div><span class="s-card__price">$'),
        (F.col("page_id") + 1).cast("string"),
        F.lit("</span></li>"),
    )
    found = pages.page_listings(
        i.table("pages").select(
            F.col("page_id"),
            F.lit("2012|Ford|F-150").alias("vehicle_key"),
            F.lit(2012).alias("search_year"),
            F.lit("Ford").alias("search_make"),
            F.lit("F-150").alias("search_model"),
            F.lit("").alias("search_part"),
            F.lit(AS_OF).cast("timestamp").alias("scraped_at"),
            F.concat(card, F.coalesce("html", F.lit(""))).alias("html"),
        )
    )
    return found.select("page_id", "title", "price_raw", "listing_url")


@query
def recent_listings(i: Inputs) -> DataFrame:
    return history.recent_listings(i.sold_history, HISTORY_AS_OF)


@query
def listing_history(i: Inputs) -> DataFrame:
    return history.listing_history(i.sold_history, "2024-03-10 00:00:00")


@query
def history_first(i: Inputs) -> DataFrame:
    return history.history_first(
        i.sold_history, _page_rows(i), run_id="run-h", as_of=HISTORY_AS_OF
    )


@query
def active_snapshot(i: Inputs) -> DataFrame:
    cells = grid.search_grid(i.searched_models, first_year=2012, last_year=2015, scope="all")
    return history.active_snapshot(
        cells, i.market, run_id="run-a", scrape_ts=F.lit("2024-02-14T00:00:00")
    )


def _ingested(i: Inputs) -> str:
    """Ingest the part file as a stream of one-card pages; gives the output folder."""
    spark = i.spark
    parts = (
        spark.readStream.schema(i.part.schema)
        .option("pathGlobFilter", "part.parquet")
        .parquet(i.sf_dir)
    )
    card = F.concat(
        F.lit('<ul><li class="s-card"><div class="s-card__title">'),
        F.replace("p_name", F.lit("&"), F.lit("&amp;")),
        F.lit('</div><span class="s-card__price">$'),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string"),
        F.lit("</span><a class='s-card__link' href='/itm/"),
        (F.col("p_partkey") % 1500).cast("string"),
        F.lit("?hash="),
        F.col("p_partkey").cast("string"),
        F.lit("'>x</a></li></ul>"),
    )
    landed = parts.select(
        F.col("p_partkey").alias("page_id"),
        F.concat(F.lit("2015|Ford|"), F.col("p_brand")).alias("vehicle_key"),
        F.lit(2015).alias("search_year"),
        F.lit("Ford").alias("search_make"),
        F.col("p_brand").alias("search_model"),
        F.col("p_type").alias("search_part"),
        F.lit(AS_OF).cast("timestamp").alias("scraped_at"),
        card.alias("html"),
    )
    base = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    run = ingest.ingest_pages(
        landed,
        history_path=f"{base}/history",
        status_path=f"{base}/status",
        checkpoint_path=f"{base}/checkpoint",
    )
    run.awaitTermination()
    return base


@query
def page_stream(i: Inputs) -> DataFrame:
    """The listings a stream of landed pages has appended, read back from storage."""
    return ingest.ingested_history(i.spark, f"{_ingested(i)}/history").drop("scrape_date")


@query
def page_stream_status(i: Inputs) -> DataFrame:
    """The crawl status the same stream has logged."""
    return ingest.current_crawl_status(i.spark, f"{_ingested(i)}/status")


def _land_files(i: Inputs) -> tuple[str, DataFrame]:
    """A folder and the stream of one-card pages landed in it, one file per micro-batch.

    Addresses come again every 400 parts, in other files; every seventh page is of
    the newest crawl, all others are up to three months older and land in between.
    """
    key = F.col("p_partkey")
    base = f"{shared_dir(i.spark)}/ingest-{uuid.uuid4().hex}"
    card = F.concat(
        F.lit("<li class='s-card'><div class='s-card__title'>A part</div><span class='s-card__price'>$"),
        (key + 1).cast("string"),
        F.lit("</span><a class='s-card__link' href='/itm/"),
        (key % 400).cast("string"),
        F.lit("?hash="),
        key.cast("string"),
        F.lit("'>x</a></li>"),
    )
    days = F.when(key % 7 == 0, 0).otherwise(1 + key % 90).cast("int")
    pages_ = i.part.select(
        key.alias("page_id"),
        F.concat(F.lit("2015|Ford|"), (key % 5).cast("string")).alias("vehicle_key"),
        F.lit(2015).alias("search_year"),
        F.lit("Ford").alias("search_make"),
        (key % 5).cast("string").alias("search_model"),
        F.concat(F.lit("part "), (key % 4).cast("string")).alias("search_part"),
        (F.lit(AS_OF).cast("timestamp") - F.make_interval(days=days)).alias("scraped_at"),
        F.when(key % 7 == 0, "newest").otherwise(F.concat(F.lit("day "), days.cast("string"))).alias("crawl_id"),
        card.alias("html"),
    )
    pages_.repartition(4, key % 4).write.parquet(f"{base}/landed")
    stream = i.spark.readStream.schema(pages_.schema).option("maxFilesPerTrigger", 1)
    return base, stream.parquet(f"{base}/landed")


def _several_files(i: Inputs, unique: bool) -> str:
    """Ingest the landed pages."""
    base, landed = _land_files(i)
    run = ingest.ingest_pages(
        landed,
        history_path=f"{base}/history",
        status_path=f"{base}/status",
        checkpoint_path=f"{base}/checkpoint",
        drop_repeats=unique,
        compact_every=2,
    )
    run.awaitTermination()
    return base


@query
def page_stream_unique(i: Inputs) -> DataFrame:
    """Addresses that a stream without repeats has stored, each once."""
    rows = ingest.ingested_history(i.spark, f"{_several_files(i, unique=True)}/history")
    address = F.split_part("listing_url", F.lit("?"), F.lit(1))
    return rows.select("vehicle_key", "search_part", address.alias("address"))


@query
def page_stream_crawls(i: Inputs) -> DataFrame:
    """The newest crawl's status, its pages spread over several batches."""
    return ingest.current_crawl_status(i.spark, f"{_several_files(i, unique=False)}/status")


@query
def page_stream_totals(i: Inputs) -> DataFrame:
    """The newest crawl's status from totals that are kept as streaming state."""
    base, landed = _land_files(i)
    ingest.count_crawls(landed, totals_path=f"{base}/totals", checkpoint_path=f"{base}/counting").awaitTermination()
    return ingest.newest_crawls(ingest.totals_table(i.spark, f"{base}/totals").rows())


@query
def repeated_run(i: Inputs) -> DataFrame:
    """The listings of all history rows run twice: addresses stored before are dropped."""
    base = f"{shared_dir(i.spark)}/repeats-{uuid.uuid4().hex}"
    rows = i.sold_history.withColumn("listing_url", F.concat(F.lit("/itm/"), F.col("event_id") % 5000, F.lit("?v="), F.col("event_id")))
    stored = ingest.history_table(i.spark, f"{base}/history")
    seen = SeenListings(i.spark, f"{base}/seen")
    for batch in range(2):
        new = settle(seen.unseen(rows, "run", batch, F.asc("scraped_at"), F.asc("event_id")))
        stored.write_batch(new.withColumn("scrape_date", F.to_date("scraped_at")), "run", batch)
        seen.add(new, "run", batch)
    return stored.current().drop("scrape_date")


def _stored_history(i: Inputs) -> DataFrame:
    """The history written by scrape date and read back."""
    path = f"{shared_dir(i.spark)}/history-{uuid.uuid4().hex}"
    history.append_history(i.sold_history, path)
    return i.spark.read.parquet(path)


@query
def vehicle_listings(i: Inputs) -> DataFrame:
    """Recent rows of one vehicle and part out of the stored history, newest first."""
    return history.vehicle_listings(
        _stored_history(i), "2012|Ford|F-150", "alternator", "2024-02-14 00:00:00", 60
    ).drop("scrape_date")


@query
def stored_history(i: Inputs) -> DataFrame:
    return history.recent_listings(_stored_history(i), HISTORY_AS_OF).drop("scrape_date")


@query
def stored_trend(i: Inputs) -> DataFrame:
    return trend.price_trend(_stored_history(i), AS_OF)


def _price_days(i: Inputs) -> DataFrame:
    """Price counts of the history, added in three batches and merged after two."""
    table = price_days.price_table(i.spark, f"{shared_dir(i.spark)}/prices-{uuid.uuid4().hex}")
    for batch in range(3):
        rows = i.sold_history.filter(F.col("event_id") % 3 == batch)
        table.write_batch(price_days.daily_prices(rows), "history", batch)
        if batch == 1:
            table.compact()
    return table.current()


@query
def price_trend_days(i: Inputs) -> DataFrame:
    """The trend read from stored price counts alone."""
    return price_days.trend_from_days(_price_days(i), i.sold_history, AS_OF)


@query
def price_trend_midday(i: Inputs) -> DataFrame:
    """The trend from stored price counts, its windows starting at noon."""
    return price_days.trend_from_days(_price_days(i), _stored_history(i), "2024-02-14 12:00:00")


@query
def stored_ranking(i: Inputs) -> DataFrame:
    """The full ranking written as CSV and read back under its contract."""
    base = f"{shared_dir(i.spark)}/ranking-{uuid.uuid4().hex}"
    files.save_rankings(_analysis(i).ranked, f"{base}/full", f"{base}/top", 3)
    return files.read_run_csv(i.spark, f"{base}/full", RANKED_PARTS)


# -- cleansing and normalization --------------------------------------------


@query
def cleanse_listings(i: Inputs) -> DataFrame:
    return cleanse(i.listings)


@query
def junk_titles(i: Inputs) -> DataFrame:
    return i.listings.filter(is_junk_title(F.col("title"))).select(
        "position_in_page", "search_page", "title"
    )


@query
def heavy_duty_filter(i: Inputs) -> DataFrame:
    heavy = is_heavy_duty(F.col("title"), standardize_make(F.col("search_make")))
    return i.listings.filter(~heavy).select("position_in_page", "search_make", "title")


@query
def normalize_listings(i: Inputs) -> DataFrame:
    return norm.normalize_raw(i.sold_listings)


@query
def dedup_stats(i: Inputs) -> DataFrame:
    return norm.dedup_stats(norm.standardize_search(clean_columns(i.sold_listings)))


# -- market analysis --------------------------------------------------------


def _analysis(i: Inputs, **options):
    return analyze(i.sold_listings, i.market, **options)


@query
def sold_summary(i: Inputs) -> DataFrame:
    rows = market.sold_summary(norm.normalize_raw(i.sold_listings))
    return _rounded(rows, mean_sold_price=4)


@query
def converted_summary(i: Inputs) -> DataFrame:
    """The sold summary in another currency: prices are no cents, ranks are found in bins."""
    rows = norm.normalize_raw(i.sold_listings)
    rows = rows.withColumn("price_clean", F.col("price_clean") * F.col("search_year") / 2187.0)
    return _rounded(market.sold_summary(rows, many_prices=True), mean_sold_price=4)


@query
def analysis_summary(i: Inputs) -> DataFrame:
    return _rounded(_analysis(i).exported, avg_price=4)


@query
def analysis_summary_matched(i: Inputs) -> DataFrame:
    """The summary with both sides keyed by the standard part."""
    return _rounded(_analysis(i, standardize_active=True).exported, avg_price=4)


@query
def ranked_parts(i: Inputs) -> DataFrame:
    return _analysis(i).ranked


@query
def top_parts(i: Inputs) -> DataFrame:
    return _analysis(i, top_n=3).top


@query
def vehicle_analysis(i: Inputs) -> DataFrame:
    """One vehicle's lookup: the same graph under a filter that reaches the scan."""
    one = (F.col("search_year") == 2013) & (F.col("search_model") == "Accord")
    return analyze(i.sold_listings.filter(one), i.market.filter(one)).top


@query
def net_value(i: Inputs) -> DataFrame:
    return value.with_net_value(_analysis(i).ranked)


@query
def net_value_cautious(i: Inputs) -> DataFrame:
    return value.with_net_value(
        _analysis(i).ranked, tolerance="low", fee_percent=0.1, labor_rate=40.0
    )


@query
def net_value_bold(i: Inputs) -> DataFrame:
    return value.with_net_value(_analysis(i).ranked, tolerance="high")


@query
def price_trend_exact(i: Inputs) -> DataFrame:
    """Trends under the stored keys as they are."""
    return trend.price_trend(i.sold_history, AS_OF, match="exact")


@query
def price_trend(i: Inputs) -> DataFrame:
    return trend.price_trend(i.sold_history, AS_OF)


def _enriched(i: Inputs) -> DataFrame:
    return enrich(_analysis(i).top, i.sold_history, AS_OF)


@query
def enriched_parts(i: Inputs) -> DataFrame:
    return _enriched(i)


def _result_items(i: Inputs, **options) -> DataFrame:
    vehicle = lookup_vehicle_key(F.col("year"), F.col("make"), F.col("model"))
    return value.result_items(_enriched(i), keyed.result_set_id(vehicle, AS_OF), **options)


@query
def result_items(i: Inputs) -> DataFrame:
    return _result_items(i, zero_as_null=True)


@query
def result_set_lookup(i: Inputs) -> DataFrame:
    """The items of one result set, looked up by id in the stored items."""
    path = f"{shared_dir(i.spark)}/items-{uuid.uuid4().hex}"
    value.store_items(_result_items(i), path)
    wanted = i.spark.range(1).select(keyed.result_set_id(F.lit("2013|ford|f-150"), AS_OF)).first()[0]
    return value.stored_items(i.spark, path, wanted)


@query
def result_headers_pending(i: Inputs) -> DataFrame:
    """Headers of all vehicles, those with an odd id still pending."""
    headers = keyed.pending_headers(i.vehicles, AS_OF)
    done = headers.filter("id % 2 = 0").select("id")
    return keyed.complete_headers(headers, done, "2024-02-15 06:00:00")


@query
def result_headers(i: Inputs) -> DataFrame:
    return keyed.result_header(i.vehicles, AS_OF)


# -- keyed tables -----------------------------------------------------------


@query
def seed_missing(i: Inputs) -> DataFrame:
    seeds = i.spark.createDataFrame(rules.SEED_VEHICLES, "make string, model string")
    return keyed.seed_missing(keyed.seed_rows(seeds, last_year=2024), i.seeded_vehicles)


@query
def seed_profiles(i: Inputs) -> DataFrame:
    """Pull profiles that the stored table does not have yet."""
    return keyed.seed_missing(value.pull_profiles(i.spark), i.stored_profiles, "part_name")


@query
def vehicle_upsert(i: Inputs) -> DataFrame:
    return keyed.upsert_vehicles(i.vehicles, i.vehicle_delta)


@query
def crawl_upsert(i: Inputs) -> DataFrame:
    return keyed.upsert_crawl_status(i.crawl_status, i.crawl_delta)


def _vehicle_table(i: Inputs) -> folders.KeyedTable:
    """The vehicles in buckets by key, the delta merged into its buckets."""
    path = f"{shared_dir(i.spark)}/vehicles-{uuid.uuid4().hex}"
    table = folders.KeyedTable(i.spark, path, i.vehicles.schema, "vehicle_key", 16)
    table.merge(i.vehicles, lambda stored, delta: stored.unionByName(delta))
    table.merge(i.vehicle_delta, keyed.upsert_vehicles)
    return table


@query
def vehicle_merge(i: Inputs) -> DataFrame:
    """The upsert of vehicles into a stored table, read back."""
    return _vehicle_table(i).rows()


@query
def crawl_merge(i: Inputs) -> DataFrame:
    """The upsert of crawl status into a stored table, read back."""
    path = f"{shared_dir(i.spark)}/crawls-{uuid.uuid4().hex}"
    table = folders.KeyedTable(i.spark, path, i.crawl_status.schema, "vehicle_key", 16)
    table.merge(i.crawl_status, lambda stored, delta: stored.unionByName(delta))
    table.merge(i.crawl_delta, keyed.upsert_crawl_status)
    return table.rows()


@query
def crawl_totals(i: Inputs) -> DataFrame:
    return keyed.crawl_totals(
        i.landed_pages, _page_rows(i), F.lit("2024-02-01 12:00:00").cast("timestamp")
    )


@query
def crawl_queue(i: Inputs) -> DataFrame:
    return keyed.crawl_queue(i.vehicles, i.crawl_status, ORDERS_AS_OF)


@query
def recent_searches(i: Inputs) -> DataFrame:
    return keyed.recent_searches(i.vehicles, i.result_sets)


@query
def cache_status(i: Inputs) -> DataFrame:
    return keyed.cache_status(i.vehicles, i.result_sets, ORDERS_AS_OF)


@query
def latest_crawls(i: Inputs) -> DataFrame:
    return keyed.latest_rows(i.crawl_status, "last_crawled_at", ["vehicle_key"]).select(
        "vehicle_key", "last_crawled_at", "parts_scraped", "total_listings"
    )


@query
def latest_sold(i: Inputs) -> DataFrame:
    return keyed.latest_rows(i.sold_history, "scraped_at", ["event_id"]).select(
        "vehicle_key", "search_part", "price_raw", "sold_date", "scraped_at"
    )


@query
def table_counts(i: Inputs) -> DataFrame:
    return keyed.table_counts(
        {
            "vehicles": i.vehicles,
            "sold_listings": i.sold_history,
            "crawl_status": i.crawl_status,
            "result_sets": i.result_sets,
        }
    )


# -- catalog ----------------------------------------------------------------


def _catalog_entries(i: Inputs) -> DataFrame:
    return i.catalog_entries.withColumn("names", F.array("first_name", "second_name"))


@query
def catalog_store(i: Inputs) -> DataFrame:
    return keyed.upsert_catalog(_catalog_entries(i), AS_OF)


@query
def catalog_lookup(i: Inputs) -> DataFrame:
    """Lookups of every brand's key against entries stored at two times."""
    entries = _catalog_entries(i)
    stored = keyed.upsert_catalog(entries.filter("year = 2012 OR year IS NULL"), AS_OF)
    expired = keyed.upsert_catalog(entries.filter("year > 2012"), "2023-12-01 00:00:00")
    asked = i.catalog_entries.select("cache_type", "make", "model", "year").distinct()
    found = keyed.catalog_lookup(asked, stored.unionByName(expired), AS_OF)
    return found.withColumn("names", F.array_join("names", "|"))


@query
def make_list(i: Inputs) -> DataFrame:
    return catalog.make_list(i.catalog_rows)


@query
def model_lists(i: Inputs) -> DataFrame:
    asked = i.catalog_rows.select("make", F.coalesce("year", F.lit(2013)).alias("year"))
    lists = catalog.model_lists(i.catalog_rows, asked)
    return lists.withColumn("models", F.array_join("models", "|"))


@query
def trim_lists(i: Inputs) -> DataFrame:
    lists = catalog.trim_lists(i.catalog_rows)
    return lists.withColumn("trims", F.array_join("trims", "|"))


@query
def model_pages(i: Inputs) -> DataFrame:
    """The model lists on pages of two names."""
    asked = i.catalog_rows.select("make", F.coalesce("year", F.lit(2013)).alias("year"))
    lists = catalog.model_pages(i.catalog_rows, asked, 2)
    return lists.withColumn("models", F.array_join("models", "|"))


@query
def trim_pages(i: Inputs) -> DataFrame:
    """The trim lists on pages of two names."""
    lists = catalog.trim_pages(i.catalog_rows, 2)
    return lists.withColumn("trims", F.array_join("trims", "|"))


@query
def vin_profile(i: Inputs) -> DataFrame:
    names = dict(
        zip(
            [
                "model_year", "make", "model", "trim_name", "series", "body_class",
                "drive_type", "engine_layout", "cylinders", "displacement", "fuel",
            ],
            rules.VIN_VARIABLES,
        )
    )
    wide = i.vin_wide.withColumnsRenamed({**names, "plant": "Plant City"})
    columns = [*names.values(), "Plant City"]
    long = wide.unpivot("vin", [F.col(f"`{c}`") for c in columns], "variable", "value")
    # Every value comes three times: first another one, then itself, then a value that
    # must not count.
    seq = F.explode(F.sequence(F.lit(1), F.lit(3))).alias("seq")
    several = long.select("vin", "variable", "value", seq)
    blank = F.when(F.hash("vin", "variable") % 2 == 0, "Not Applicable")
    value_ = (
        F.when(F.col("seq") == 1, F.when(~F.col("value").isin("", "Not Applicable"), "1999"))
        .when(F.col("seq") == 2, F.col("value"))
        .otherwise(blank)
    )
    return catalog.vin_profiles(several.withColumn("value", value_))


# -- paired comparison ------------------------------------------------------


def _part_pairs(i: Inputs) -> DataFrame:
    return paired.part_pairs(_analysis(i).summary, *PAIR)


def _pairs(i: Inputs) -> DataFrame:
    """The pairs, stored once: the tests below read them several times."""
    return settle(_part_pairs(i))


@query
def part_pairs(i: Inputs) -> DataFrame:
    return _rounded(_part_pairs(i), diff=9)


@query
def paired_summary(i: Inputs) -> DataFrame:
    columns = ["mean_a", "mean_b", "mean_diff", "median_diff", "positive_rate"]
    return _rounded(paired.paired_summary(_part_pairs(i)), **{c: 9 for c in columns})


@query
def signed_rank(i: Inputs) -> DataFrame:
    return _rounded(paired.signed_rank(_pairs(i)), z=9, p_value=9)


@query
def permutation_test(i: Inputs) -> DataFrame:
    return _rounded(paired.permutation_test(_pairs(i)), statistic=9)


@query
def compare_parts(i: Inputs) -> DataFrame:
    """All results of the comparison in one row."""
    nine = ["mean_a", "mean_b", "mean_diff", "median_diff", "positive_rate", "permutation_statistic"]
    nine += ["wilcoxon_p_value", "ci_low", "ci_high"]
    return _rounded(paired.compare_parts(_analysis(i).summary, *PAIR), **dict.fromkeys(nine, 9))


@query
def bootstrap_ci(i: Inputs) -> DataFrame:
    return _rounded(paired.bootstrap_ci(_pairs(i)), ci_low=9, ci_high=9)


