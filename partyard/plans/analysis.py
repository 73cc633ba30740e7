"""The whole analysis as one lazy graph of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame

from partyard import rules
from partyard.operators.market import analysis_summary, export_summary
from partyard.operators.normalize import normalize_raw
from partyard.operators.ranking import rank_parts, top_parts
from partyard.operators.trend import price_trend
from partyard.operators.value import with_net_value, with_trend


@dataclass
class Analysis:
    """The stages of one analysis; each is a plan, none has run yet."""

    normalized: DataFrame
    summary: DataFrame
    top_n: int = rules.TOP_PARTS

    @cached_property
    def exported(self) -> DataFrame:
        return export_summary(self.summary)

    @cached_property
    def ranked(self) -> DataFrame:
        return rank_parts(self.summary)

    @cached_property
    def top(self) -> DataFrame:
        return top_parts(self.ranked, self.top_n)


def analyze(
    raw: DataFrame, active: DataFrame, *, top_n: int = rules.TOP_PARTS, **summary_options
) -> Analysis:
    """Raw listings and an active snapshot to summary and rankings.

    For one vehicle, filter ``raw`` and ``active`` first; the filter reaches the
    scan.  Persist ``summary`` when several of the stages are written.
    """
    normalized = normalize_raw(raw)
    summary = analysis_summary(normalized, active, **summary_options)
    return Analysis(normalized, summary, top_n)


def enrich(
    top: DataFrame,
    history: DataFrame,
    as_of: datetime | str,
    *,
    profiles: DataFrame | None = None,
    match: str = "normalized",
    **value_options,
) -> DataFrame:
    """Ranked parts with net value, verdict and price trend."""
    valued = with_net_value(top, profiles, **value_options)
    return with_trend(valued, price_trend(history, as_of, match=match), match=match)
