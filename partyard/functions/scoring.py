"""Market scores, net value, verdict and trend label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions.numeric import round_exact, round_scaled


def sell_through(sold: Column, active: Column) -> Column:
    share = F.try_divide(sold.cast("double"), (sold + active).cast("double"))
    return round_scaled(F.coalesce(share, F.lit(0.0)), 4)


def confidence(
    sold: Column,
    active: Column,
    *,
    sold_target: float = rules.CONFIDENCE_SOLD_TARGET,
    active_target: float = rules.CONFIDENCE_ACTIVE_TARGET,
    sold_weight: float = rules.CONFIDENCE_SOLD_WEIGHT,
    active_weight: float = rules.CONFIDENCE_ACTIVE_WEIGHT,
    ceiling: float = rules.CONFIDENCE_CEILING,
) -> Column:
    """How much data backs a row; 0 when a target is not positive."""
    if sold_target <= 0 or active_target <= 0:
        return F.lit(0.0)
    top = F.lit(float(ceiling))
    sold_part = F.least(top, sold.cast("double") / F.lit(float(sold_target)))
    active_part = F.least(top, active.cast("double") / F.lit(float(active_target)))
    score = sold_part * F.lit(sold_weight) + active_part * F.lit(active_weight)
    return round_scaled(score, 4)


def opportunity(median_price: Column, share: Column, score: Column) -> Column:
    return round_scaled(F.coalesce(median_price, F.lit(0.0)) * share * score, 4)


def hours_between(first: Column, second: Column) -> Column:
    return F.abs(F.unix_micros(first.cast("timestamp")) - F.unix_micros(second.cast("timestamp"))).cast("double") / F.lit(3.6e9)


def net_value(
    median_price: Column,
    shipping_cost: Column,
    yard_cost: Column,
    pull_minutes: Column,
    *,
    fee_percent: float = rules.FEE_PERCENT,
    labor_rate: float = rules.LABOR_RATE,
) -> Column:
    """Median price less fee, shipping, yard price and labor; missing costs are 0."""
    zero = F.lit(0.0)
    labor = F.coalesce(pull_minutes, F.lit(0)).cast("double") / F.lit(60.0) * F.lit(labor_rate)
    net = (
        median_price
        - median_price * F.lit(fee_percent)
        - F.coalesce(shipping_cost, zero)
        - F.coalesce(yard_cost, zero)
        - labor
    )
    return round_exact(net, 2)


def verdict(
    net: Column,
    share: Column,
    tolerance: Column | str | None = None,
    thresholds: Mapping[str, tuple[float, float, float]] = rules.VERDICT_THRESHOLDS,
) -> Column:
    """Pull, Maybe or Skip; an unknown tolerance is read as the default one."""
    if tolerance is None or isinstance(tolerance, str):
        limits = thresholds.get(tolerance or "", thresholds[rules.DEFAULT_TOLERANCE])
        pull_net, pull_str, maybe_net = (F.lit(x) for x in limits)
    else:
        default = thresholds[rules.DEFAULT_TOLERANCE]

        def limit(index: int) -> Column:
            table = F.create_map(
                *[F.lit(x) for name, row in thresholds.items() for x in (name, row[index])]
            )
            return F.coalesce(F.try_element_at(table, tolerance), F.lit(default[index]))

        pull_net, pull_str, maybe_net = limit(0), limit(1), limit(2)
    sold_share = F.coalesce(share, F.lit(0.0))
    return (
        F.when((net >= pull_net) & (sold_share >= pull_str), "Pull")
        .when(net >= maybe_net, "Maybe")
        .otherwise("Skip")
    )


def trend_label(percent: Column, limit: float = rules.TREND_PERCENT) -> Column:
    """Up, down or neutral from the unrounded change; null where there is none."""
    return (
        F.when(percent > limit, "up").when(percent < -limit, "down").when(percent.isNotNull(), "neutral")
    )
