"""Ranked parts of each vehicle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partyard import rules
from partyard.contracts import RANKED_PARTS, require_columns
from partyard.functions.keys import rank_vehicle_key

DERIVED = ("vehicle_key", "vehicle_rank")


def rank_parts(summary: DataFrame) -> DataFrame:
    """Number the parts of each vehicle, best opportunity first, nulls last."""
    require_columns(
        summary, [f.name for f in RANKED_PARTS if f.name not in DERIVED], "ranking input"
    )
    keyed = summary.withColumn(
        "vehicle_key", rank_vehicle_key(F.col("year"), F.col("make"), F.col("model"))
    )
    best_first = Window.partitionBy("vehicle_key").orderBy(
        F.desc_nulls_last("opportunity_score"),
        F.desc_nulls_last("active_count"),
        F.desc_nulls_last("median_sold_price"),
        F.asc_nulls_last("part"),
    )
    return keyed.withColumn("vehicle_rank", F.row_number().over(best_first)).select(
        [f.name for f in RANKED_PARTS]
    )


def top_parts(ranked: DataFrame, top_n: int = rules.TOP_PARTS) -> DataFrame:
    """The first ``top_n`` parts of each vehicle.

    On a ranking made by ``rank_parts`` Spark pushes the limit below the
    shuffle, so a vehicle never sends more than ``top_n`` rows per task.
    """
    return ranked.filter(F.col("vehicle_rank") <= top_n)
