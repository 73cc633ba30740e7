"""Paired comparison of two parts over the vehicles that have both.

Functions here read ``pairs`` more than once; store them with ``settle`` first
when they come from a long plan.  Random draws come from a digest of (seed, pair, block of draws), so a result
does not depend on partitioning and can be repeated by any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partyard.functions.keys import history_vehicle_key
from partyard.functions.numeric import normal_upper_tail
from partyard.session import settle

PERMUTATIONS = 100_000
BOOTSTRAPS = 10_000
CONFIDENCE_LEVEL = 0.95
ALPHA = 0.05
SIGNS_PER_DIGEST = 60
WEIGHTS_PER_DIGEST = 4
#: Differences are summed in whole multiples of this, so sums are exact.
GRAIN = 1e-12
#: Draws that are made from one row of input before the next shuffle.
DRAWS_PER_ROW = 1_000
#: A Poisson weight of mean 1 is the number of these shares below a uniform number.
POISSON_STEPS = [
    0.36787944117, 0.73575888234, 0.91969860293, 0.98101184312, 0.99634015317,
    0.99940581518, 0.99991675885, 0.99998975080, 0.99999887480, 0.99999988857,
]


def part_pairs(summary: DataFrame, part_a: str, part_b: str, metric: str = "str") -> DataFrame:
    """Metric of both parts per vehicle and their difference, complete pairs only."""
    key = history_vehicle_key(F.col("year"), F.col("make"), F.col("model"))
    value = F.col(metric)
    return (
        summary.filter(F.col("part").isin(part_a, part_b))
        .groupBy(key.alias("vehicle_key"))
        .agg(
            F.max(F.when(F.col("part") == part_a, value)).alias("a"),
            F.max(F.when(F.col("part") == part_b, value)).alias("b"),
        )
        .filter("a IS NOT NULL AND b IS NOT NULL")
        .withColumn("diff", F.col("a") - F.col("b"))
    )


def paired_summary(pairs: DataFrame) -> DataFrame:
    """Number of pairs, means, median difference and share of positive ones.

    The median is read from running counts over the distinct differences, bucketed,
    so no task holds all pairs.
    """
    size = F.abs(F.col("diff"))
    scale = F.floor(F.log2(F.greatest(size, F.lit(5e-324))) * 64) + 100_000
    counts = (
        pairs.filter("diff IS NOT NULL")
        .groupBy("diff")
        .agg(F.count("*").alias("n"))
        .withColumn("bucket", F.when(F.col("diff") == 0, 0).otherwise(F.signum("diff").cast("long") * scale))
    )
    total = pairs.agg(F.count("diff")).scalar()
    middle = [(total - 1 - F.pmod(total - 1, F.lit(2))) / 2, (total - 1 + F.pmod(total - 1, F.lit(2))) / 2]
    placed = _count_before(counts, "bucket", "diff")
    at = [
        F.max(F.when((F.col("before") <= m) & (F.col("before") + F.col("n") > m), F.col("diff"))) for m in middle
    ]
    median = placed.agg(((at[0] + at[1]) / 2.0).alias("median")).scalar()
    return pairs.agg(
        F.count("*").alias("n_pairs"),
        F.avg("a").alias("mean_a"),
        F.avg("b").alias("mean_b"),
        F.avg("diff").alias("mean_diff"),
        F.avg((F.col("diff") > 0).cast("double")).alias("positive_rate"),
    ).select("n_pairs", "mean_a", "mean_b", "mean_diff", median.alias("median_diff"), "positive_rate")


def _count_before(counts: DataFrame, bucket: str, order: str) -> DataFrame:
    """Add to each row the total ``n`` of all rows that sort before it.

    ``bucket`` must rise with ``order``.  Totals per bucket are summed up over
    the few buckets, and rows only inside their bucket, so no task sees all
    rows.
    """
    over_buckets = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy(bucket)
        .agg(F.sum("n").alias("_n"))
        .select(bucket, F.coalesce(F.sum("_n").over(over_buckets), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy(bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    running = counts.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return (
        running.join(offsets, bucket)
        .withColumn("before", F.col("_offset") + F.col("_inside"))
        .drop("_offset", "_inside")
    )


def signed_rank(pairs: DataFrame) -> DataFrame:
    """One-sided signed-rank test that the differences lie above 0.

    Zero differences are dropped, ties share their mean rank, and the variance
    is corrected for ties; there is no continuity correction.  Tied sizes are
    counted first, so ranks are found over distinct sizes.
    """
    size = F.abs(F.col("diff"))
    sizes = (
        pairs.filter("diff <> 0")
        .groupBy(size.alias("size"))
        .agg(F.count("*").alias("n"), F.count_if(F.col("diff") > 0).alias("positive"))
        .withColumn("bucket", F.floor(F.log2("size") * 64))
    )
    n, rank = F.col("n"), F.col("before") + (F.col("n") + 1) / 2.0
    sums = _count_before(sizes, "bucket", "size").agg(
        F.sum(n).alias("n_used"),
        F.sum(F.col("positive") * rank).alias("statistic"),
        F.sum((n * n * n - n).cast("double")).alias("_ties"),
    )
    m = F.col("n_used").cast("double")
    mean = m * (m + 1.0) / 4.0
    variance = m * (m + 1.0) * (2.0 * m + 1.0) / 24.0 - F.col("_ties") / 48.0
    z = F.try_divide(F.col("statistic") - mean, F.sqrt(variance))
    return sums.withColumn("z", z).select(
        "n_used", "statistic", "z", normal_upper_tail(F.col("z")).alias("p_value")
    )


def _digest(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def _grains(diff: Column) -> Column:
    return F.round(diff / GRAIN).cast("long")


def _drawn(rows: DataFrame, draws: int) -> DataFrame:
    """Every row once per draw; blocks of draws are dealt out before they unfold."""
    blocks = -(-draws // DRAWS_PER_ROW)
    block, width = F.col("_block") * DRAWS_PER_ROW, F.lit(DRAWS_PER_ROW)
    dealt = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition("_block")
    last = F.least(block + width, F.lit(draws)) - 1
    return dealt.withColumn("draw", F.explode(F.sequence(block, last))).drop("_block")


def permutation_test(
    pairs: DataFrame, *, draws: int = PERMUTATIONS, seed: int = 42
) -> DataFrame:
    """Share of random sign flips whose mean difference reaches the observed one.

    Pairs of equal size are counted first.  Of ``n`` of them the number that keeps its
    sign is the number of ones in ``n`` random bits, 60 bits from one digest of (seed,
    size, draw, word): rows are distinct sizes times draws, not pairs times draws.
    """
    grains = _grains(F.col("diff"))
    sizes = pairs.groupBy(F.abs(grains).alias("size")).agg(F.count("*").alias("n")).filter("size > 0")
    words = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / SIGNS_PER_DIGEST).cast("long"))
    bits = F.least(F.col("n") - F.col("word") * SIGNS_PER_DIGEST, F.lit(SIGNS_PER_DIGEST))
    parts = sizes.withColumn("word", F.explode(words)).select("size", "word", bits.alias("bits"))
    random = F.conv(F.substring(_digest(seed, F.col("size"), F.col("draw"), F.col("word")), 1, 15), 16, 10)
    ones = F.bit_count(
        F.call_function(
            "shiftrightunsigned", random.cast("long"), SIGNS_PER_DIGEST - F.col("bits").cast("int")
        )
    )
    observed = pairs.agg(F.sum(grains)).scalar()
    mean = pairs.agg(F.avg("diff")).scalar()
    sums = (
        _drawn(parts, draws)
        .select("draw", (F.col("size") * (2 * ones - F.col("bits"))).alias("signed"))
        .groupBy("draw")
        .agg(F.sum("signed").alias("total"))
    )
    return sums.agg(
        F.avg((F.col("total") >= observed).cast("double")).alias("p_value"),
        F.count("*").alias("draws"),
    ).select(mean.alias("statistic"), "p_value", "draws")


def bootstrap_ci(
    pairs: DataFrame,
    *,
    draws: int = BOOTSTRAPS,
    level: float = CONFIDENCE_LEVEL,
    seed: int = 42,
) -> DataFrame:
    """Percentile interval of the mean difference over resampled pairs.

    The Poisson bootstrap: in every draw each pair counts a Poisson number of times,
    read from a digest of its own, so pairs need no numbering and no join.  The draws of
    a pair unfold where the pair lies, and every task adds them into its own vector of
    one sum per draw; what is shuffled is that vector, however many pairs there are.
    """
    blocks = -(-draws // WEIGHTS_PER_DIGEST)
    key = F.col("vehicle_key")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    digests = pairs.select(key, _grains(F.col("diff")).alias("grains"), every).select(
        "grains", "block", _digest(seed, key, F.col("block")).alias("hex")
    )
    places = F.sequence(F.lit(0), F.lit(WEIGHTS_PER_DIGEST - 1))
    slots = digests.withColumn("place", F.explode(places))
    word = F.conv(F.substring("hex", F.col("place") * 8 + 1, F.lit(8)), 16, 10).cast("long")
    weight = sum((F.col("word") >= int(step * 2**32)).cast("long") for step in POISSON_STEPS)
    means = (
        slots.select(
            (F.col("block") * WEIGHTS_PER_DIGEST + F.col("place")).alias("draw"), "grains", word.alias("word")
        )
        .filter(F.col("draw") < draws)
        .select("draw", "grains", weight.alias("weight"))
        .groupBy("draw")
        .agg(F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("grains")).alias("total"))
        .select("draw", F.try_divide(F.col("total"), F.col("weight")).alias("mean"))
    )
    tail = (1.0 - level) / 2.0
    return means.agg(
        (F.percentile("mean", F.lit(tail)) * GRAIN).alias("ci_low"),
        (F.percentile("mean", F.lit(1.0 - tail)) * GRAIN).alias("ci_high"),
        F.count("*").alias("draws"),
    )


def compare_parts(
    summary: DataFrame,
    part_a: str,
    part_b: str,
    *,
    metric: str = "str",
    alpha: float = ALPHA,
    permutations: int = PERMUTATIONS,
    bootstraps: int = BOOTSTRAPS,
    seed: int = 42,
) -> DataFrame:
    """All paired results of two parts in one row.

    Every test reads the pairs, so they are stored once; there is one row per
    vehicle.
    """
    pairs = settle(part_pairs(summary, part_a, part_b, metric))

    def one(df: DataFrame, column: str) -> Column:
        return df.select(column).scalar()

    flips = permutation_test(pairs, draws=permutations, seed=seed)
    ranks = signed_rank(pairs)
    interval = bootstrap_ci(pairs, draws=bootstraps, seed=seed)
    p_value = one(flips, "p_value")
    return paired_summary(pairs).select(
        F.lit(part_a).alias("part_a"),
        F.lit(part_b).alias("part_b"),
        F.lit(metric).alias("metric"),
        F.lit(alpha).alias("alpha"),
        F.lit("greater").alias("alternative"),
        "n_pairs",
        "mean_a",
        "mean_b",
        "mean_diff",
        "median_diff",
        "positive_rate",
        F.lit("paired_permutation").alias("permutation_test_name"),
        F.col("mean_diff").alias("permutation_statistic"),
        p_value.alias("permutation_p_value"),
        F.lit(permutations).alias("permutation_count"),
        F.lit("wilcoxon_signed_rank").alias("wilcoxon_test_name"),
        one(ranks, "statistic").alias("wilcoxon_statistic"),
        one(ranks, "p_value").alias("wilcoxon_p_value"),
        F.lit("bootstrap_percentile_mean_diff").alias("ci_method"),
        F.lit(CONFIDENCE_LEVEL).alias("ci_confidence_level"),
        one(interval, "ci_low").alias("ci_low"),
        one(interval, "ci_high").alias("ci_high"),
        F.lit(bootstraps).alias("ci_bootstrap_iterations"),
        (p_value < alpha).alias("reject_null"),
    )
