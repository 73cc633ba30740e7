"""Search keys, search addresses and the three spellings of a vehicle key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partyard import rules


def search_key(year: Column, make: Column, model: Column, part: Column) -> Column:
    return F.concat_ws("|", year.cast("string"), make, model, part)


def execution_key(
    year: Column, make: Column, model: Column, part: Column, scope: Column
) -> Column:
    return F.concat_ws("|", year.cast("string"), make, model, part, scope)


def form_encode(text: Column) -> Column:
    """Form encoding that leaves ``~`` alone and escapes ``*``."""
    encoded = F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))


def search_url(
    year: Column,
    make: Column,
    model: Column,
    part: Column,
    *,
    scope: str = "sold",
    used_only: bool = True,
    page: Column | None = None,
) -> Column:
    query = F.concat_ws(" ", year.cast("string"), make, model, part)
    flags = rules.SOLD_URL_FLAGS if scope == "sold" else ""
    flags += rules.USED_URL_FLAG if used_only else ""
    pieces = [F.lit(rules.SEARCH_URL_BASE + "?_nkw="), form_encode(query), F.lit(flags)]
    if page is not None:
        page_flag = F.concat(F.lit(rules.PAGE_URL_FLAG), page.cast("string"))
        pieces.append(F.when(page > 1, page_flag).otherwise(F.lit("")))
    return F.concat(*pieces)


def lookup_vehicle_key(year: Column, make: Column, model: Column) -> Column:
    """Lower-cased key of vehicle lookups: ``2017|chrysler|pacifica``."""
    blank = F.lit("")
    return F.concat_ws(
        "|",
        year.cast("string"),
        F.lower(F.trim(F.coalesce(make, blank))),
        F.lower(F.trim(F.coalesce(model, blank))),
    )


def history_vehicle_key(year: Column, make: Column, model: Column) -> Column:
    """Key of stored sold rows, case kept: ``2017|Chrysler|Pacifica``."""
    return F.concat_ws("|", year.cast("string"), make, model)


def rank_vehicle_key(year: Column, make: Column, model: Column) -> Column:
    """Key of ranked rows: ``2017 Chrysler Pacifica``; a missing piece reads ``nan``."""
    pieces = [F.coalesce(F.trim(c.cast("string")), F.lit("nan")) for c in (year, make, model)]
    return F.concat_ws(" ", *pieces)
