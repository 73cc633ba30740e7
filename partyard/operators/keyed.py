"""Keyed tables: upserts, seeding, freshness checks and queues."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions.keys import history_vehicle_key
from partyard.sources.history import since

VEHICLE_ATTRIBUTES = ["trim", "series", "body_class", "drive_type", "engine", "fuel_type"]
VEHICLE_IDENTITY = ["year", "make", "model", "created_at"]


def latest_per_key(df: DataFrame, keys: Sequence[str], *newest_first: Column) -> DataFrame:
    """One row per key, the first under ``newest_first``.

    The filter on the row number is pushed below the shuffle as a group limit.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def upsert_vehicles(vehicles: DataFrame, delta: DataFrame, sequence: str = "seq") -> DataFrame:
    """Insert new vehicles; fill attributes of known ones with values that are not null.

    Applying the delta row by row in ``sequence`` order amounts to: identity
    from the stored row, else the first delta row; each attribute from the last
    delta row that has one, else the stored row.
    """
    order = F.col(sequence)
    folded = delta.groupBy("vehicle_key").agg(
        *[F.min_by(c, order).alias(f"_{c}") for c in VEHICLE_IDENTITY],
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_{c}")
            for c in VEHICLE_ATTRIBUTES
        ],
    )
    joined = vehicles.withColumn("_known", F.lit(True)).join(folded, "vehicle_key", "full")
    known = F.col("_known").isNotNull()
    merged = {c: F.when(known, F.col(c)).otherwise(F.col(f"_{c}")) for c in VEHICLE_IDENTITY}
    merged |= {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in VEHICLE_ATTRIBUTES}
    return joined.select([merged.get(c, F.col(c)).alias(c) for c in vehicles.columns])


def upsert_crawl_status(status: DataFrame, delta: DataFrame) -> DataFrame:
    """Replace the status of each crawled vehicle by its newest row."""
    rows = status.withColumn("_new", F.lit(0)).unionByName(delta.withColumn("_new", F.lit(1)))
    newest = [F.desc("_new"), F.desc_nulls_last("updated_at"), F.desc_nulls_last("last_crawled_at")]
    rest = [F.desc_nulls_last(c) for c in status.columns if c != "vehicle_key"]
    return latest_per_key(rows, ["vehicle_key"], *newest, *rest).drop("_new")


def upsert_catalog(
    entries: DataFrame,
    as_of: datetime | str,
    *,
    sequence: str = "seq",
    ttl_days: int = rules.CATALOG_TTL_DAYS,
) -> DataFrame:
    """Latest list per catalog key, stored as JSON text with an expiry time.

    ``entries`` has cache_type, make, model, year, names (array), and an order.
    """
    keys = ["cache_type", "make", "model", "year"]
    now = F.lit(as_of).cast("timestamp")
    return latest_per_key(entries, keys, F.desc(sequence)).select(
        *keys,
        F.to_json("names").alias("data"),
        now.alias("cached_at"),
        (now + F.make_interval(days=F.lit(ttl_days))).alias("expires_at"),
    )


def catalog_lookup(requests: DataFrame, cache: DataFrame, as_of: datetime | str) -> DataFrame:
    """Cached list of each requested key that has not expired; null keys match."""
    keys = ["cache_type", "make", "model", "year"]
    live = cache.filter(F.col("expires_at") > F.lit(as_of).cast("timestamp")).select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.from_json("data", "array<string>").alias("names"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return requests.join(live, same, "inner").select(*requests.columns, "names")


def seed_rows(
    seeds: DataFrame, *, last_year: int, years: int = rules.SEED_YEARS
) -> DataFrame:
    """Every seed vehicle in every year of the window."""
    span = F.sequence(F.lit(last_year - years + 1), F.lit(last_year))
    exploded = seeds.select(F.explode(span).alias("year"), "make", "model")
    key = history_vehicle_key(F.col("year"), F.col("make"), F.col("model"))
    return exploded.select(key.alias("vehicle_key"), "year", "make", "model")


def seed_missing(rows: DataFrame, table: DataFrame, key: str = "vehicle_key") -> DataFrame:
    """The rows to insert: those whose key the table does not have yet.

    Seeds vehicles by their key, pull profiles by ``part_name``.
    """
    return rows.join(table.select(key).distinct(), key, "left_anti")


def cache_status(
    vehicles: DataFrame,
    result_sets: DataFrame,
    as_of: datetime | str,
    *,
    window_days: int = rules.DEFAULT_WINDOW_DAYS,
    usable_days: int = rules.USABLE_DAYS,
) -> DataFrame:
    """Freshness of the stored results of each vehicle.

    Unexpired sets come first, then the newest: one ranking answers both the
    "fresh" and the "most recent" lookup.
    """
    now = F.lit(as_of).cast("timestamp")
    completed = result_sets.filter(
        (F.col("status") == "completed") & (F.col("window_days") == window_days)
    ).withColumn("_fresh", F.coalesce(F.col("cache_expires_at") > now, F.lit(False)))
    best = latest_per_key(
        completed,
        ["vehicle_key"],
        F.desc("_fresh"),
        F.desc_nulls_first("scraped_at"),
        F.desc("id"),
    ).select(
        "vehicle_key",
        F.col("id").alias("result_set_id"),
        "scraped_at",
        "cache_expires_at",
        "_fresh",
    )
    day = 86_400_000_000
    age_days = F.floor((F.unix_micros(now) - F.unix_micros(F.col("scraped_at").cast("timestamp"))) / F.lit(day))
    label = (
        F.when(F.col("_fresh"), "fresh")
        .when(F.col("scraped_at").isNull(), "missing")
        .when(age_days <= usable_days, "usable_stale")
        .otherwise("expired")
    )
    known = label != "missing"
    return vehicles.select("vehicle_key").join(best, "vehicle_key", "left").select(
        "vehicle_key",
        label.alias("cache_status"),
        F.when(known, F.col("result_set_id")).alias("result_set_id"),
        "scraped_at",
        F.when(known, F.col("cache_expires_at")).alias("cache_expires_at"),
    )


def recent_searches(
    vehicles: DataFrame, result_sets: DataFrame, limit: int = rules.RECENT_SEARCHES
) -> DataFrame:
    """The vehicles with the newest completed results, newest first."""
    latest = latest_per_key(
        result_sets.filter(F.col("status") == "completed"),
        ["vehicle_key"],
        F.desc_nulls_first("scraped_at"),
        F.desc("id"),
    ).select("vehicle_key", F.col("id").alias("result_set_id"), "scraped_at", "cache_expires_at")
    joined = vehicles.select("year", "make", "model", "trim", "vehicle_key").join(
        latest, "vehicle_key"
    )
    return joined.orderBy(F.desc_nulls_first("scraped_at"), F.desc("result_set_id")).limit(limit)


def crawl_queue(
    vehicles: DataFrame,
    status: DataFrame,
    as_of: datetime | str,
    *,
    stale_days: int = rules.CRAWL_STALE_DAYS,
    limit: int = rules.CRAWL_BATCH,
) -> DataFrame:
    """Vehicles never crawled or crawled too long ago, the stalest first."""
    joined = vehicles.select("vehicle_key", "year", "make", "model").join(
        status.select("vehicle_key", "last_crawled_at"), "vehicle_key", "left"
    )
    due = F.col("last_crawled_at").isNull() | (F.col("last_crawled_at") < since(as_of, stale_days))
    return (
        joined.filter(due)
        .orderBy(F.asc_nulls_first("last_crawled_at"), F.asc("vehicle_key"))
        .limit(limit)
    )


def latest_rows(df: DataFrame, by: str, ties: Sequence[str], limit: int = rules.LATEST_ROWS) -> DataFrame:
    """The newest rows of a table; ``ties`` makes the choice total."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in ties]).limit(limit)


def crawl_totals(attempts: DataFrame, listings: DataFrame, updated_at: Column) -> DataFrame:
    """Parts attempted and listings found per vehicle, as crawl-status rows."""
    parts = attempts.groupBy("vehicle_key").agg(
        F.countDistinct("search_part").alias("parts_scraped")
    )
    found = listings.groupBy("vehicle_key").agg(F.count("*").alias("total_listings"))
    return parts.join(found, "vehicle_key", "left").select(
        "vehicle_key",
        updated_at.alias("last_crawled_at"),
        "parts_scraped",
        F.coalesce(F.col("total_listings"), F.lit(0)).alias("total_listings"),
        updated_at.alias("updated_at"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    union = counts[0]
    for one in counts[1:]:
        union = union.unionByName(one)
    return union


def result_set_id(vehicle_key: Column, as_of: datetime | str) -> Column:
    """Stable id of the results of one vehicle and time, for header and items alike."""
    named = F.concat_ws("|", vehicle_key, F.lit(as_of).cast("timestamp").cast("string"))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def pending_headers(
    vehicle_keys: DataFrame,
    as_of: datetime | str,
    *,
    window_days: int = rules.DEFAULT_WINDOW_DAYS,
    source: str = "ebay",
    profile_version: str = rules.PROFILE_VERSION,
) -> DataFrame:
    """One new result-set header per vehicle, still without results."""
    never = F.lit(None).cast("timestamp")
    return vehicle_keys.select("vehicle_key").distinct().select(
        result_set_id(F.col("vehicle_key"), as_of).alias("id"),
        "vehicle_key",
        F.lit(window_days).alias("window_days"),
        F.lit(source).alias("source"),
        F.lit("pending").alias("status"),
        never.alias("scraped_at"),
        F.lit(as_of).cast("timestamp").alias("created_at"),
        never.alias("cache_expires_at"),
        F.lit(profile_version).alias("part_profile_version"),
    )


def complete_headers(
    headers: DataFrame, done: DataFrame, at: datetime | str, *, ttl_days: int = rules.RESULT_TTL_DAYS
) -> DataFrame:
    """Mark the headers whose ``id`` is in ``done`` as completed; expiry starts then."""
    now = F.lit(at).cast("timestamp")
    ids = done.select(F.col("id").alias("_id")).distinct()
    hit = F.col("_id").isNotNull()
    changed = {
        "status": F.when(hit, "completed").otherwise(F.col("status")),
        "scraped_at": F.when(hit, now).otherwise(F.col("scraped_at")),
        "cache_expires_at": F.when(hit, now + F.make_interval(days=F.lit(ttl_days))).otherwise(
            F.col("cache_expires_at")
        ),
    }
    return headers.join(ids, headers["id"] == ids["_id"], "left").withColumns(changed).drop("_id")


def result_header(vehicle_keys: DataFrame, as_of: datetime | str, **options) -> DataFrame:
    """One header per vehicle, created and completed at the same time."""
    ttl = {"ttl_days": options.pop("ttl_days")} if "ttl_days" in options else {}
    headers = pending_headers(vehicle_keys, as_of, **options)
    return complete_headers(headers, headers, as_of, **ttl)
