"""Rounding and the normal tail, as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, digits: int) -> Column:
    """Round half to even after scaling, the rule array libraries use.

    ``rint`` stays inside generated code; ``bround`` would build a BigDecimal
    per row.
    """
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def round_exact(value: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even, as Python's ``round`` does.

    ``p`` is the scaled value and ``rest`` the part of the exact product that
    ``p`` lost (Dekker's product).  The lost part matters only when ``p`` sits
    on a tie; it then tells on which side the true value lies.
    """
    scale = float(10**digits)
    split = float(2**27 + 1)
    head = scale * split - (scale * split - scale)
    tail = scale - head
    wide = value * F.lit(split)
    high = wide - (wide - value)
    low = value - high
    p = value * F.lit(scale)
    rest = (
        (high * F.lit(head) - p) + high * F.lit(tail) + low * F.lit(head)
    ) + low * F.lit(tail)
    on_tie = F.abs(p - F.rint(p)) == F.lit(0.5)
    whole = (
        F.when(on_tie & (rest > 0), F.floor(p).cast("double") + F.lit(1.0))
        .when(on_tie & (rest < 0), F.floor(p).cast("double"))
        .otherwise(F.rint(p))
    )
    return whole / F.lit(scale)


def normal_upper_tail(z: Column, terms: int = 160) -> Column:
    """P(Z > z) for a standard normal variable.

    Inside six deviations the odd power series of the distribution function is
    summed; beyond, where the series would cancel, Laplace's continued fraction
    is folded from the inside out.  Meant for summary rows, not for raw data.
    """
    x = F.abs(z)
    density = F.exp(-x * x / 2.0) / F.lit(math.sqrt(2.0 * math.pi))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.struct(x.alias("term"), x.alias("total")),
        lambda acc, k: F.struct(
            (acc.term * x * x / (2.0 * k + 1.0)).alias("term"),
            (acc.total + acc.term * x * x / (2.0 * k + 1.0)).alias("total"),
        ),
        lambda acc: acc.total,
    )
    fraction = F.aggregate(
        F.sequence(F.lit(60), F.lit(1)), x, lambda acc, k: x + k.cast("double") / acc
    )
    upper = F.when(x < 6.0, F.lit(0.5) - density * series).otherwise(density / fraction)
    return F.when(z < 0, F.lit(1.0) - upper).otherwise(upper)
