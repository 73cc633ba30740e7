"""Paired comparison: known results, brute force, and independence of partitioning."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from partyard.operators import paired

# FIXED VALUES: sell-through of two parts on 64 vehicles, (first, second) per vehicle
PAIRS = [
    (0.0661, 0.0476), (0.0496, 0.0476), (0.1943, 0.1071), (0.1205, 0.0972), (0.1061, 0.0682),
    (0.1762, 0.1486), (0.0359, 0.1239), (0.0091, 0.0325), (0.0669, 0.0939), (0.0184, 0.0747),
    (0.0657, 0.0521), (0.0166, 0.1171), (0.2006, 0.1972), (0.012, 0.069), (0.0714, 0.0223),
    (0.0397, 0.0915), (0.0325, 0.0683), (0.0035, 0.0065), (0.0031, 0.0112), (0.001, 0.0206),
    (0.0109, 0.0637), (0.0625, 0.1029), (0.0408, 0.081), (0.0014, 0.0206), (0.05, 0.0649),
    (0.0233, 0.0501), (0.004, 0.0007), (0.0204, 0.0674), (0.0014, 0.0011), (0.0043, 0.0148),
    (0.0018, 0.0909), (0.0107, 0.0698), (0.0088, 0.0054), (0.0377, 0.0665), (0.0073, 0.0018),
    (0.0032, 0.1065), (0.004, 0.0101), (0.0024, 0.0868), (0.0017, 0.0138), (0.025, 0.0061),
    (0.0132, 0.0021), (0.0007, 0.0551), (0.0061, 0.0046), (0.0027, 0.0561), (0.0431, 0.0153),
    (0.0011, 0.009), (0.0277, 0.0712), (0.0005, 0.004), (0.0095, 0.0105), (0.0294, 0.0647),
    (0.0515, 0.0436), (0.0036, 0.0499), (0.0168, 0.0457), (0.0008, 0.0417), (0.0083, 0.0018),
    (0.062, 0.1031), (0.0053, 0.0062), (0.0057, 0.0196), (0.0012, 0.0533), (0.0036, 0.0334),
    (0.0008, 0.0113), (0.0028, 0.0299), (0.05, 0.1283), (0.018, 0.0491),
]

# FIXED VALUES: results known for these pairs
KNOWN = {
    "n_pairs": 64,
    "mean_a": 0.030862500000000005,
    "mean_b": 0.0520546875,
    "mean_diff": -0.0211921875,
    "median_diff": -0.0194,
    "positive_rate": 0.296875,
}
KNOWN_STATISTIC, KNOWN_P = 406.0, 0.9999888179340344
KNOWN_CI = (-0.029773515625, -0.012407539062500004)

SUMMARY = "year int, make string, model string, part string, str double"


@pytest.fixture(scope="module")
def summary(spark):
    rows = []
    for n, (a, b) in enumerate(PAIRS):
        rows += [(2012, "Make", f"M{n}", "alternator", a), (2012, "Make", f"M{n}", "headlight", b)]
    rows += [(2012, "Make", "alone", "headlight", 0.5), (2012, "Make", "M0", "door", 0.9)]
    return spark.createDataFrame(rows, SUMMARY)


@pytest.fixture(scope="module")
def pairs(summary):
    return paired.part_pairs(summary, "alternator", "headlight")


def test_summary(pairs):
    got = paired.paired_summary(pairs).first().asDict()
    assert got.keys() == KNOWN.keys()
    for name, value in KNOWN.items():
        assert got[name] == pytest.approx(value, rel=1e-12), name


def test_signed_rank(pairs):
    got = paired.signed_rank(pairs).first()
    assert (got.n_used, got.statistic) == (64, KNOWN_STATISTIC)
    assert got.p_value == pytest.approx(KNOWN_P, rel=1e-10)


def test_signed_rank_with_ties_and_zeros(spark):
    diffs = [0.0, 1.0, -1.0, 1.0, 2.0, -3.0, 3.0, 5.0, 0.0, 0.25]
    df = spark.createDataFrame([(str(n), d) for n, d in enumerate(diffs)], "vehicle_key string, diff double")
    used = np.array([d for d in diffs if d])
    size = np.abs(used)
    rank = np.array([(size < s).sum() + ((size == s).sum() + 1) / 2 for s in size])
    n = len(used)
    ties = sum(c**3 - c for c in np.unique(size, return_counts=True)[1])
    z = (rank[used > 0].sum() - n * (n + 1) / 4) / math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48)
    got = paired.signed_rank(df).first()
    assert got.statistic == rank[used > 0].sum()
    assert got.p_value == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-9)


def test_permutation(pairs):
    got = paired.permutation_test(pairs, draws=20_000).first()
    assert got.draws == 20_000
    assert got.statistic == pytest.approx(KNOWN["mean_diff"], rel=1e-12)
    assert got.p_value >= 0.999


def test_permutation_of_few_pairs_is_near_the_full_count(spark):
    diffs = [3.0, 2.0, -1.0, 4.0, 1.5]
    df = spark.createDataFrame([(str(n), d) for n, d in enumerate(diffs)], "vehicle_key string, diff double")
    signs = np.array(np.meshgrid(*[[1, -1]] * 5)).reshape(5, -1)
    full = ((signs * np.array(diffs)[:, None]).sum(0) >= sum(diffs) - 1e-12).mean()
    assert paired.permutation_test(df, draws=20_000).first().p_value == pytest.approx(full, abs=0.01)


def test_bootstrap(pairs):
    got = paired.bootstrap_ci(pairs, draws=10_000).first()
    assert got.draws == 10_000
    assert (got.ci_low, got.ci_high) == pytest.approx(KNOWN_CI, abs=0.001)


def test_median_of_many_and_of_ties(spark):
    rng = np.random.RandomState(4)
    for diffs in (rng.standard_normal(501), rng.randint(-2, 3, 400) / 7, np.zeros(4), np.array([-1.0, 2.0])):
        df = spark.createDataFrame([(0.0, 0.0, float(d)) for d in diffs], "a double, b double, diff double")
        assert paired.paired_summary(df).first().median_diff == np.median(diffs)


def test_signs_of_many_equal_pairs(spark):
    df = spark.createDataFrame([(str(n), 0.5 if n < 110 else -0.5) for n in range(200)], "vehicle_key string, diff double")
    p = 0.5 * math.erfc((20 - 1) / math.sqrt(200) / math.sqrt(2))
    assert paired.permutation_test(df, draws=20_000).first().p_value == pytest.approx(p, abs=0.01)


def test_draws_do_not_depend_on_partitioning(pairs):
    one = paired.permutation_test(pairs.repartition(2), draws=1_000).first()
    two = paired.permutation_test(pairs.repartition(7), draws=1_000).first()
    assert one.p_value == two.p_value
    low = [paired.bootstrap_ci(pairs.repartition(n), draws=500).first().ci_low for n in (2, 7)]
    assert low[0] == pytest.approx(low[1], abs=1e-12)


def test_one_row_of_results(summary):
    got = paired.compare_parts(summary, "alternator", "headlight", permutations=2_000, bootstraps=500).first()
    assert len(got) == 24
    assert (got.part_a, got.part_b, got.metric) == ("alternator", "headlight", "str")
    assert got.wilcoxon_statistic == KNOWN_STATISTIC
    assert got.reject_null is False
    assert got.ci_low < got.mean_diff < got.ci_high


def test_bootstrap_draws_where_the_pairs_lie(spark, tmp_path):
    """No shuffle below the sums per draw: every split of the input draws its own pairs."""
    path = str(tmp_path / "pairs")
    spark.range(1000).select(
        F.concat(F.lit("k"), F.col("id")).alias("vehicle_key"), ((F.col("id") % 37 - 18) / 1000.0).alias("diff")
    ).repartition(4).write.parquet(path)
    out = paired.bootstrap_ci(spark.read.parquet(path), draws=400)
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning(draw") :]
    assert "partial_sum" in below and "Exchange" not in below[10:]
    row = out.first()
    assert row.ci_low < row.ci_high and row.draws == 400
