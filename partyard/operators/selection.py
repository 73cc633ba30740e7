"""Trimmed statistics of cells with very many distinct prices.

Prices in cents repeat, so windows over a cell's distinct prices are short.  Converted
or computed prices hardly repeat: a cell has as many distinct ones as rows.  Here ranks
are found in two steps.  Prices fall into bins that rise with the price and are counted
per cell; running counts over the bins name the one bin that holds a rank.  Only the
prices of such bins are sorted, each bin for itself, so no window sees all prices of a
cell.

A bin spans 1/4096 of an octave (0.017 %), whatever the data.  A cell has as many bins
as its prices span, about 4,096 per doubling; prices closer than that share a bin,
which is the group a task sorts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partyard.session import stored

PER_OCTAVE = 4096
#: Above every exponent of a double; keeps the bins of positive prices above zero's.
_OCTAVES = 1100


def price_bin(price: Column, per_octave: int = PER_OCTAVE) -> Column:
    """Number of a price's bin: never smaller for a larger price; null for null."""
    size = F.least(F.log2(F.abs(price)), F.lit(float(_OCTAVES - 1)))
    place = F.floor(size * per_octave) + _OCTAVES * per_octave
    return F.when(price > 0, place).when(price < 0, -place).when(price == 0, F.lit(0)).cast("long")


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null to null; the right side's keys are dropped."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(right, same, how).drop(*[f"_{k}" for k in keys])


def _counted_bins(binned: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, sum, range and newest time per bin; rows up to each bin and of its cell."""
    bins = binned.groupBy(*keys, "bin").agg(
        F.sum(F.when(F.col("price").isNotNull(), F.col("n")).otherwise(F.lit(0))).alias("n"),
        F.sum(F.col("price") * F.col("n")).alias("total"),
        F.min("price").alias("lowest"),
        F.max("price").alias("highest"),
        F.max(F.when(F.col("price").isNotNull(), F.col("seen"))).alias("seen"),
    )
    group = Window.partitionBy(*keys)
    running = group.orderBy(F.col("bin").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return bins.withColumns({"upto": F.sum("n").over(running), "priced": F.sum("n").over(group)})


def _at_ranks(binned: DataFrame, bins: DataFrame, keys: list[str], ranks: Sequence[Column]) -> DataFrame:
    """Per cell a map from zero-based rank to price, for a few ``ranks``."""
    before = F.col("upto") - F.col("n")
    held = F.filter(
        F.array_distinct(F.array(*ranks)), lambda rank: (rank >= before) & (rank < F.col("upto"))
    )
    asked = bins.select(*keys, "bin", before.alias("before"), held.alias("held")).filter(F.size("held") > 0)
    inside = Window.partitionBy(*keys, "bin").orderBy("price").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = _joined(binned, asked, [*keys, "bin"]).withColumn("reach", F.col("before") + F.sum("n").over(inside))
    start = F.col("reach") - F.col("n")
    hit = F.filter("held", lambda rank: (rank >= start) & (rank < F.col("reach")))
    found = rows.select(*keys, "price", F.explode(hit).alias("rank"))
    return found.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "price"))).alias("at")
    )


def trimmed_summary(
    histogram: DataFrame,
    keys: Sequence[str],
    *,
    trim_min_rows: int,
    trim_low: float,
    trim_high: float,
) -> DataFrame:
    """Count, trimmed median and mean, range and newest time per cell.

    ``histogram`` has one row per key and distinct ``price`` with a row count ``n`` and
    a newest time ``seen``.  Null prices count for nothing but keep their cell; null
    keys are cells; an empty table gives no rows.  The histogram and the bins are
    stored once in the shared folder.
    """
    keys = list(keys)
    binned = stored(histogram.withColumn("bin", price_bin(F.col("price"))))
    bins = stored(_counted_bins(binned, keys))

    def place(q: float) -> Column:
        return F.lit(q) * (F.col("priced") - 1).cast("double")

    def quantile(q: float) -> Column:
        low, high = F.floor(place(q)), F.ceil(place(q))
        a, b = F.try_element_at("at", low), F.try_element_at("at", high)
        t = place(q) - low.cast("double")
        return F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1.0 - t))

    ends = [end(place(q)) for q in (trim_low, trim_high) for end in (F.floor, F.ceil)]
    small = F.col("priced") < trim_min_rows
    bounded = _joined(bins, _at_ranks(binned, bins, keys, ends), keys, "left").withColumns(
        {
            "floor": F.when(small, F.lit(float("-inf"))).otherwise(quantile(trim_low)),
            "ceiling": F.when(small, F.lit(float("inf"))).otherwise(quantile(trim_high)),
        }
    )
    # A bin lies below, above or inside the bounds as a whole, but for those of the bounds.
    whole = (F.col("lowest") >= F.col("floor")) & (F.col("highest") <= F.col("ceiling"))
    below = F.col("highest") < F.col("floor")
    above = F.col("lowest") > F.col("ceiling")
    cut = bounded.filter(~(whole | below | above)).select(*keys, "bin", "floor", "ceiling")
    within = (F.col("price") >= F.col("floor")) & (F.col("price") <= F.col("ceiling"))
    pieces = bounded.select(
        *keys,
        F.when(below, F.col("n")).otherwise(F.lit(0)).alias("below"),
        F.when(whole, F.col("n")).otherwise(F.lit(0)).alias("kept"),
        F.when(whole, F.col("total")).alias("total"),
    ).unionByName(
        _joined(binned, cut, [*keys, "bin"]).select(
            *keys,
            F.when(F.col("price") < F.col("floor"), F.col("n")).otherwise(F.lit(0)).alias("below"),
            F.when(within, F.col("n")).otherwise(F.lit(0)).alias("kept"),
            F.when(within, F.col("price") * F.col("n")).alias("total"),
        )
    )
    sums = pieces.groupBy(*keys).agg(
        F.sum("below").alias("below"), F.sum("kept").alias("kept"), F.sum("total").alias("kept_total")
    )
    middle = F.col("below") + F.floor((F.col("kept") - 1) / 2)
    middle_up = F.col("below") + F.ceil((F.col("kept") - 1) / 2)
    medians = _at_ranks(binned, _joined(bins, sums, keys), keys, [middle, middle_up])
    cells = bins.groupBy(*keys).agg(
        F.sum("n").alias("sold_count"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.max("seen").alias("seen"),
    )
    full = _joined(_joined(cells, sums, keys), medians, keys, "left")
    return full.select(
        *keys,
        "sold_count",
        ((F.try_element_at("at", middle) + F.try_element_at("at", middle_up)) / 2.0).alias("median_sold_price"),
        F.try_divide("kept_total", "kept").alias("mean_sold_price"),
        F.col("lowest").alias("min_sold_price"),
        F.col("highest").alias("max_sold_price"),
        F.col("seen").alias("sold_timestamp"),
    )
