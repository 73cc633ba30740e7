"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.  Each query is
built, planned and run in full; a no-op sink consumes every row and column.

The tables lie in one file with one row group each, which only one core can read.  They
are first written again as one file per core, as a cluster's tables would lie; this is
not timed.  BENCH_AS_IS=1 reads the given files.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from partyard.session import local_session
from queryset.spark_queries import QUERIES

TABLES = ["customer", "events", "lineitem", "nation", "orders", "part"]
HEADLINE = [
    "search_grid",
    "page_cards",
    "cleanse_listings",
    "normalize_listings",
    "dedup_stats",
    "sold_summary",
    "analysis_summary",
    "ranked_parts",
    "top_parts",
    "vehicle_analysis",
    "net_value",
    "price_trend",
    "enriched_parts",
    "history_first",
    "active_snapshot",
    "vehicle_upsert",
    "crawl_upsert",
    "cache_status",
    "recent_searches",
    "crawl_queue",
    "catalog_store",
    "model_lists",
    "vin_profile",
    "signed_rank",
    "permutation_test",
    "bootstrap_ci",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    # Tables of a few MB: read and shuffle them in as many parts as there are cores.
    spark = local_session(
        cpus,
        "bench",
        **{
            "spark.sql.files.openCostInBytes": "256k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    work = tempfile.mkdtemp(prefix="bench-")
    spark.sparkContext.setCheckpointDir(work)
    read_dir = sf_dir if os.environ.get("BENCH_AS_IS") else f"{work}/{os.path.basename(sf_dir.rstrip('/'))}"
    for table in TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        if read_dir != sf_dir:
            rows.repartition(int(cpus) if cpus.isdigit() else 8).write.parquet(f"{read_dir}/{table}.parquet")
        spark.read.parquet(f"{read_dir}/{table}.parquet").count()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, read_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
