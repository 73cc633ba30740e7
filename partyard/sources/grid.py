"""The grid of searches to run, and what is left of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions import keys
from partyard.functions.literals import text_array
from partyard.session import spread


def search_grid(
    vehicles: DataFrame,
    *,
    first_year: int = rules.FIRST_YEAR,
    last_year: int = rules.LAST_YEAR,
    parts: Sequence[str] = rules.SEARCH_PARTS,
    scope: str = "sold",
    used_only: bool = True,
) -> DataFrame:
    """One row per vehicle, year and part, with its keys, address and position.

    ``vehicles`` has ``make`` and ``model``, and may have ``position`` for their
    order.  Years and parts are exploded from literal arrays, without a join.  The
    vehicles are dealt out before: a small file of them makes many cells.  Every
    vehicle gets the same years.
    """
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    years_n, parts_n = last_year - first_year + 1, len(parts)
    terms = text_array(parts)
    order = F.col("position") if "position" in vehicles.columns else F.lit(0)
    named = vehicles.select(
        F.col("make").alias("search_make"),
        F.col("model").alias("search_model"),
        order.cast("long").alias("_order"),
    )
    exploded = spread(named, *named.columns).select("*", F.explode(years).alias("search_year")).select("*", F.posexplode(terms).alias("_place", "search_part"))
    cell = [F.col(f"search_{name}") for name in ("year", "make", "model", "part")]
    year_place = F.col("search_year") - F.lit(first_year)
    return exploded.select(
        "search_year",
        "search_make",
        "search_model",
        "search_part",
        keys.search_key(*cell).alias("search_key"),
        keys.execution_key(*cell, F.lit(scope)).alias("execution_key"),
        keys.search_url(*cell, scope=scope, used_only=used_only).alias("search_url"),
        keys.lookup_vehicle_key(*cell[:3]).alias("lookup_key"),
        keys.history_vehicle_key(*cell[:3]).alias("history_key"),
        keys.rank_vehicle_key(*cell[:3]).alias("rank_key"),
        ((F.col("_order") * years_n + year_place) * parts_n + F.col("_place")).alias(
            "grid_position"
        ),
    )


def pending_searches(grid: DataFrame, completed: DataFrame) -> DataFrame:
    """Grid cells whose execution key is not among the completed ones."""
    done = completed.select("execution_key").distinct()
    return grid.join(done, "execution_key", "left_anti")
