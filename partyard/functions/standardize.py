"""Alias lookups and taxonomy classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions.literals import text_map
from partyard.functions.text import contains_any, normalize_token


def _lookup(token: Column, table: Mapping[str, str]) -> Column:
    """Look a token up in a small literal map; null when it is not there."""
    return F.try_element_at(text_map(table), token)


def standardize_make(make: Column, aliases: Mapping[str, str] = rules.MAKE_ALIASES) -> Column:
    """The canonical make of a known alias, else the trimmed original."""
    token = normalize_token(make)
    original = F.regexp_replace(make, r"(?U)^\s+|\s+$", "")
    return F.when(token != "", F.coalesce(_lookup(token, aliases), original))


def standardize_model(
    model: Column, aliases: Mapping[str, str] = rules.MODEL_ALIASES
) -> Column:
    return standardize_make(model, aliases)


def standardize_part(part: Column, aliases: Mapping[str, str] = rules.PART_ALIASES) -> Column:
    """The standard term of a known alias, else the normalized token itself."""
    token = normalize_token(part)
    return F.when(token != "", F.coalesce(_lookup(token, aliases), token))


def category_from_part(
    part: Column,
    categories: Mapping[str, str] = rules.PART_CATEGORIES,
    aliases: Mapping[str, str] = rules.PART_ALIASES,
) -> Column:
    return _lookup(standardize_part(part, aliases), categories)


def classify_token(
    token: Column, categories: Sequence[rules.Category] = rules.CATEGORIES
) -> Column:
    """Taxonomy category of a text that ``normalize_token`` has prepared.

    Text that names both an engine and a transmission module is an engine
    module.  Otherwise the first category wins that has one of its words in the
    text, as a substring, and none of the words that rule it out.
    """
    matching = F.coalesce(
        *(
            F.when(contains_any(token, c.include) & ~contains_any(token, c.exclude), F.lit(c.name))
            for c in categories
        )
    )
    both_modules = contains_any(token, rules.ECM_TERMS) & contains_any(token, rules.TCM_TERMS)
    return F.when(both_modules, F.lit(rules.ECM_AND_TCM_CATEGORY)).otherwise(matching)


def classify_part(
    text: Column, categories: Sequence[rules.Category] = rules.CATEGORIES
) -> Column:
    return classify_token(normalize_token(text), categories)
