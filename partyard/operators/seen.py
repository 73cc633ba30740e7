"""Addresses of listings that were stored before, across runs and without expiry.

A listing is told by vehicle, part and address without its query.  The addresses of
every batch are kept as digests in buckets, with Bloom filters in their files; a new
batch reads the buckets its own digests fall into and drops what they hold.  Listings
without an address never count as repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partyard.contracts import SEEN_LISTINGS
from partyard.functions.text import blank_to_null, strip_query
from partyard.operators.keyed import latest_per_key
from partyard.sources.folders import BatchTable

#: Buckets of digests; a batch reads those its digests fall into.
SEEN_BUCKETS = 64


def address_digest() -> Column:
    """Digest of vehicle, part and address; null without an address."""
    address = blank_to_null(strip_query(F.col("listing_url")))
    named = F.to_json(F.struct("vehicle_key", "search_part", address.alias("address")))
    return F.when(address.isNotNull(), F.md5(named))


def _bucket(digest: Column) -> Column:
    return F.pmod(F.crc32(digest), F.lit(SEEN_BUCKETS)).cast("int")


class SeenListings(BatchTable):
    """The stored digests; batches add theirs under the number they have in their stream."""

    bloom = ("digest",)

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__(spark, path, SEEN_LISTINGS, "bucket", lambda rows: rows.distinct())

    def unseen(self, rows: DataFrame, stream: str, batch: int, *newest_first: Column) -> DataFrame:
        """The rows whose address no earlier batch has stored, each address once.

        Of several rows of one address the first in the given order stays.  Copies go
        before the stored digests are met, below the shuffle, so a listing that fills a
        third of a batch is one row of the join.  What the batch itself has stored in an
        earlier attempt does not count, so a repeated batch gives the same rows.
        """
        order = newest_first or (F.asc_nulls_last("scraped_at"), F.xxhash64(*rows.columns))
        marked = rows.withColumn("_digest", address_digest())
        own = latest_per_key(marked.filter("_digest IS NOT NULL"), ["_digest"], *order)
        # At most as many rows as there are buckets.
        touched = own.select(_bucket(F.col("_digest")).alias("b")).distinct().collect()
        stored = self.current(until=(stream, batch), parts={f"bucket={r['b']}" for r in touched})
        fresh = own.join(stored.select(F.col("digest").alias("_digest")), "_digest", "left_anti")
        return fresh.unionByName(marked.filter("_digest IS NULL")).drop("_digest")

    def add(self, rows: DataFrame, stream: str, batch: int) -> None:
        """Store the digests of a batch's new rows."""
        digests = rows.select(address_digest().alias("digest")).filter("digest IS NOT NULL").distinct()
        self.write_batch(digests.withColumn("bucket", _bucket(F.col("digest"))), stream, batch)
