"""Sold summaries, the join with active supply, scores and quality flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyard import rules
from partyard.contracts import (
    ACTIVE_ROLES,
    ANALYSIS_SUMMARY,
    CELL,
    EXPORT_NAMES,
    SOLD_ROLES,
    conform,
    rename,
    require_columns,
)
from partyard.functions import scoring
from partyard.functions.standardize import standardize_part
from partyard.operators.selection import trimmed_summary


def as_timestamp(df: DataFrame, name: str) -> Column:
    """A text column read as timestamps, null where unreadable; others as they are."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return column.try_cast("timestamp")
    return column.cast("timestamp")


class PriceRanks:
    """Order statistics over a price histogram, without collecting prices.

    The histogram has one row per key and distinct price, with a row count in
    ``n``.  Running counts give the price at any rank of the full, sorted group.
    All statistics of a key share one shuffle and one sort on (key, price).
    """

    def __init__(self, keys: Sequence[str], price: str = "price") -> None:
        self.price = F.col(price)
        self.group = Window.partitionBy(*keys)
        self.running = self.group.orderBy(self.price.asc_nulls_last()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        self.n = F.when(self.price.isNotNull(), F.col("n")).otherwise(F.lit(0))

    def counted(self, histogram: DataFrame) -> DataFrame:
        """Add rows up to and including each price, and priced rows per key."""
        return histogram.withColumn("upto", F.sum(self.n).over(self.running)).withColumn(
            "priced", F.sum(self.n).over(self.group)
        )

    def at(self, rank: Column) -> Column:
        """The price if the zero-based ``rank`` falls on this histogram row."""
        return F.when((F.col("upto") > rank) & (F.col("upto") - self.n <= rank), self.price)

    def quantile(self, q: float) -> Column:
        """Linearly interpolated quantile of the key, on each of its rows."""
        place = F.lit(q) * (F.col("priced") - 1).cast("double")
        low, high = F.floor(place), F.ceil(place)
        a = F.max(self.at(low)).over(self.group)
        b = F.max(self.at(high)).over(self.group)
        t = place - low.cast("double")
        return F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1.0 - t))


def sold_summary(
    sold: DataFrame,
    roles: Mapping[str, str] = SOLD_ROLES,
    *,
    trim_min_rows: int = rules.TRIM_MIN_ROWS,
    trim_low: float = rules.TRIM_LOW,
    trim_high: float = rules.TRIM_HIGH,
    many_prices: bool = False,
) -> DataFrame:
    """Price statistics per year, make, model and part.

    Count, range and latest timestamp cover every priced row.  Median and mean
    cover the rows left after trimming both tails, once a cell has
    ``trim_min_rows`` priced rows.  Cells without a price keep a row.

    Rows are first counted per (cell, price) inside each map task.  Prices are
    amounts in cents, so a cell that holds a third of all rows reaches the next
    shuffle as its distinct prices, and the windows over them spill to disk.
    For prices that hardly repeat (converted or computed ones) ``many_prices`` finds
    the ranks in bins instead, so no window spans a cell; see ``selection``.
    """
    require_columns(sold, roles.values(), "sold listings")
    price = F.col(roles["price"]).cast("double")
    histogram = (
        sold.select(
            *[F.col(roles[k]).alias(k) for k in CELL],
            F.when(~F.isnan(price), price).alias("price"),
            as_timestamp(sold, roles["timestamp"]).alias("seen"),
        )
        .groupBy(*CELL, "price")
        .agg(F.count("*").alias("n"), F.max("seen").alias("seen"))
    )
    if many_prices:
        return trimmed_summary(
            histogram, CELL, trim_min_rows=trim_min_rows, trim_low=trim_low, trim_high=trim_high
        )
    ranks = PriceRanks(CELL)
    counted = ranks.counted(histogram)
    bounded = counted.withColumns(
        {"floor": ranks.quantile(trim_low), "ceiling": ranks.quantile(trim_high)}
    )
    small = F.col("priced") < trim_min_rows
    inside = (ranks.price >= F.col("floor")) & (ranks.price <= F.col("ceiling"))
    kept_n = F.when(small | inside, ranks.n).otherwise(F.lit(0))
    below_n = F.when(~small & (ranks.price < F.col("floor")), ranks.n).otherwise(F.lit(0))
    trimmed = bounded.withColumns(
        {
            "kept_n": kept_n,
            "below": F.sum(below_n).over(ranks.group),
            "kept": F.sum(kept_n).over(ranks.group),
        }
    )
    middle = F.col("below") + F.floor((F.col("kept") - 1) / 2)
    middle_up = F.col("below") + F.ceil((F.col("kept") - 1) / 2)
    return trimmed.groupBy(*CELL).agg(
        F.sum(ranks.n).alias("sold_count"),
        ((F.max(ranks.at(middle)) + F.max(ranks.at(middle_up))) / 2.0).alias("median_sold_price"),
        F.try_divide(F.sum(ranks.price * F.col("kept_n")), F.sum("kept_n")).alias("mean_sold_price"),
        F.min(ranks.price).alias("min_sold_price"),
        F.max(ranks.price).alias("max_sold_price"),
        F.max(F.when(ranks.price.isNotNull(), F.col("seen"))).alias("sold_timestamp"),
    )


def active_summary(active: DataFrame, roles: Mapping[str, str] = ACTIVE_ROLES) -> DataFrame:
    """Active snapshot rows under the names of the join; nothing is aggregated."""
    require_columns(active, roles.values(), "active snapshot")
    names = [*CELL, "active_count", "timestamp"]
    return active.select([F.col(roles[name]).alias(name) for name in names])


def analysis_summary(
    sold: DataFrame,
    active: DataFrame,
    *,
    sold_roles: Mapping[str, str] = SOLD_ROLES,
    active_roles: Mapping[str, str] = ACTIVE_ROLES,
    standardize_active: bool = False,
    stale_after_hours: float = rules.STALE_AFTER_HOURS,
    low_sample_below: int = rules.LOW_SAMPLE_BELOW,
    very_low_sold_below: int = rules.VERY_LOW_SOLD_BELOW,
    **confidence_options: float,
) -> DataFrame:
    """Join demand to supply and score every cell.

    Keys match null to null, and several snapshots of one cell give several
    rows.  Supply is keyed by the raw search term while demand is keyed by the
    standard one, so aliased parts find no supply; ``standardize_active``
    standardizes both sides instead.
    """
    demand = sold_summary(sold, sold_roles)
    supply = active_summary(active, active_roles)
    supply = supply.withColumn("timestamp", as_timestamp(supply, "timestamp"))
    if standardize_active:
        supply = supply.withColumn("part", standardize_part(F.col("part")))
    supply = supply.withColumnsRenamed({k: f"_{k}" for k in CELL})
    same_cell = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in CELL]
    joined = demand.join(supply, same_cell, "left").drop(*[f"_{k}" for k in CELL])

    sold_n, active_n = F.col("sold_count"), F.col("active_count")
    counts = joined.withColumns(
        {
            "active_count": F.coalesce(active_n.cast("long"), F.lit(0).cast("long")),
            "active_timestamp": F.col("timestamp"),
        }
    ).drop("timestamp")
    scores = counts.withColumns(
        {
            "total_count": sold_n + active_n,
            "str": scoring.sell_through(sold_n, active_n),
            "confidence_score": scoring.confidence(sold_n, active_n, **confidence_options),
            "time_diff_hours": scoring.hours_between(
                F.col("sold_timestamp"), F.col("active_timestamp")
            ),
        }
    )
    return scores.withColumns(
        {
            "opportunity_score": scoring.opportunity(
                F.col("median_sold_price"), F.col("str"), F.col("confidence_score")
            ),
            "stale_snapshot_flag": F.coalesce(
                F.col("time_diff_hours") > stale_after_hours, F.lit(False)
            ),
            "low_sample_flag": sold_n < low_sample_below,
            "very_low_sold_flag": sold_n < very_low_sold_below,
        }
    )


def export_summary(summary: DataFrame) -> DataFrame:
    """The summary under its published names, in contract order."""
    return conform(rename(summary, EXPORT_NAMES), ANALYSIS_SUMMARY)
