"""Text cleaning and field extraction as native column expressions.

Every function maps a column to a column and stays inside the JVM.  ``(?U)``
gives the character classes their Unicode meaning.  Missing and empty text both
give null unless a function says otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions.literals import without_redundant


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def squeeze(text: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def by_alphabet(text: Column, pattern: str, use: Callable[[Column, str], Column]) -> Column:
    """``use`` of a ``(?U)`` pattern; ASCII texts get it without ``U``.

    There both say the same, and the ASCII classes and word boundaries cost much less.
    """
    ascii_only = re.sub(r"^\(\?(i?)U\)", lambda m: "(?i)" if m[1] else "", pattern)
    if ascii_only == pattern:
        return use(text, pattern)
    return F.when(F.length(text) == F.octet_length(text), use(text, ascii_only)).otherwise(use(text, pattern))


def hinted(text: Column, pattern: str, found: Column) -> Column:
    """``found`` where the text holds one of the pattern's hints, or matches its simpler one, else null."""
    hints = rules.MATCH_HINTS.get(pattern)
    if hints is None:
        return found
    if isinstance(hints, str):
        return F.when(by_alphabet(text, hints, lambda t, q: F.rlike(t, F.lit(q))), found)
    return F.when(contains_any(text, hints), found)


def clean_text(text: Column) -> Column:
    """Squeezed text, null where nothing is left.

    Most texts are ASCII with single spaces and no other white space; substring tests
    tell them at a fraction of the cost of the expression.  They read the text several
    times, so it should be a plain column.
    """
    odd = contains_any(text, ["  ", "\t", "\n", "\x0b", "\f", "\r"])
    plain = (F.length(text) == F.octet_length(text)) & ~odd
    return blank_to_null(F.when(plain, F.trim(text)).otherwise(squeeze(text)))


def normalize_token(text: Column) -> Column:
    """Lower-cased, squeezed text for comparisons; null gives the empty string."""
    return F.coalesce(F.lower(squeeze(text)), F.lit(""))


def combined_text(title: Column, subtitle: Column, raw_text: Column) -> Column:
    parts = [F.coalesce(part, F.lit("")) for part in (title, subtitle, raw_text)]
    return F.btrim(F.concat_ws(" | ", *parts), F.lit(" |"))


def clean_price(text: Column) -> Column:
    """The single price in a text; null when the text shows a price range."""
    plain = F.lower(F.replace(text, F.lit(","), F.lit("")))
    numbers = F.regexp_extract_all(plain, F.lit(rules.PRICE_NUMBER), F.lit(1))
    is_range = (F.size(numbers) >= 2) & (
        F.contains(F.trim(plain), F.lit(" to "))
        | F.contains(plain, F.lit("-"))
        | F.contains(plain, F.lit("–"))
    )
    return F.when(~is_range, F.get(numbers, F.lit(0)).try_cast("double"))


def first_price(text: Column) -> Column:
    """The first number in a text, so the low end of a range."""
    number = F.regexp_substr(
        F.replace(text, F.lit("$"), F.lit("")), F.lit(rules.FIRST_NUMBER)
    )
    return F.replace(number, F.lit(","), F.lit("")).try_cast("double")


def condition(
    lowered: Column, patterns: Sequence[tuple[str, str]] = rules.CONDITION_PATTERNS
) -> Column:
    """The first label, in list order, whose pattern occurs in lower-cased text."""
    found = [
        hinted(lowered, p, by_alphabet(lowered, "(?U)" + p, lambda t, q, name=label: F.when(F.rlike(t, F.lit(q)), F.lit(name))))
        for label, p in patterns
    ]
    return F.coalesce(*found)


def part_number(
    text: Column, patterns: Sequence[str] = rules.PART_NUMBER_PATTERNS
) -> Column:
    found = [
        hinted(text, p, by_alphabet(text, "(?iU)" + p, lambda t, q: F.regexp_substr(t, F.lit(q))))
        for p in patterns
    ]
    return F.upper(F.coalesce(*found))


def years_found(text: Column) -> Column:
    years = by_alphabet(text, rules.YEAR_WORD, lambda t, q: F.regexp_extract_all(t, F.lit(q), F.lit(1)))
    return blank_to_null(F.array_join(F.array_sort(F.array_distinct(years)), ", "))


def year_range(text: Column) -> Column:
    def span(t: Column, pattern: str) -> Column:
        first, last = (F.regexp_extract(t, pattern, k) for k in (1, 2))
        return F.when(first != "", F.concat_ws("-", first, last))

    return hinted(text, rules.YEAR_SPAN, by_alphabet(text, rules.YEAR_SPAN, span))


def has_word(lowered: Column, word: str) -> Column:
    """Whether a word occurs as a whole word in lower-cased text.

    The substring test comes first, so the expression runs on few texts.
    """
    return F.contains(lowered, F.lit(word)) & F.rlike(lowered, F.lit(rf"(?U)\b{re.escape(word)}\b"))


def listed_words(lowered: Column, words: Sequence[str]) -> Column:
    """Every listed word that occurs as a whole word in lower-cased text, nested ones too."""
    return F.array_compact(F.array(*(F.when(has_word(lowered, w), F.lit(w)) for w in words)))


def vehicle_words(
    lowered: Column,
    makes: Sequence[str] = rules.GUESS_MAKES,
    models: Sequence[str] = rules.GUESS_MODELS,
) -> Column:
    """Title-cased make and model: the first of their lists that lower-cased text has, else null.

    ``initcap`` would start words at white space only (``Cr-v`` instead of ``Cr-V``).
    """

    def first(words: Sequence[str]) -> Column:
        return F.coalesce(*(F.when(has_word(lowered, w), F.lit(w.title())) for w in words))

    return F.array(first(makes), first(models))


def vehicle_guess(found: Column) -> Column:
    """The ``vehicle_words`` of a text in one; either may be missing."""
    return blank_to_null(F.concat_ws(" ", found))


def part_words(
    lowered: Column, parts: Mapping[str, Sequence[str]] = rules.GUESS_PARTS
) -> Column:
    """The parts a text names, each once."""
    words: dict[str, list[str]] = {}
    for word, part in {word: part for part, words in parts.items() for word in words}.items():
        words.setdefault(part, []).append(word)
    named = [F.when(reduce(or_, (has_word(lowered, w) for w in own)), F.lit(part)) for part, own in words.items()]
    return F.array_compact(F.array(*named))


def part_guess(found: Column) -> Column:
    """The one part of ``part_words``, ``ambiguous`` for several, else null."""
    return F.when(F.size(found) > 1, F.lit(rules.AMBIGUOUS_PART)).otherwise(
        F.get(found, F.lit(0))
    )


def sold_date_words(text: Column) -> Column:
    """The sold date as it is written, without reading it as a date."""
    words = by_alphabet(text, rules.SOLD_DATE_WORDS, lambda t, q: F.regexp_extract(t, q, 1))
    return hinted(text, rules.SOLD_DATE_WORDS, blank_to_null(words))


def parse_sold_date(text: Column) -> Column:
    words = squeeze(F.regexp_substr(text, F.lit(rules.SOLD_DATE)))
    return F.to_date(F.try_to_timestamp(words, F.lit("MMM d, yyyy")))


def shipping_text(text: Column) -> Column:
    words = by_alphabet(text, rules.SHIPPING, lambda t, q: F.regexp_substr(t, F.lit(q)))
    return blank_to_null(squeeze(words))


def strip_query(url: Column) -> Column:
    return F.regexp_replace(url, r"\?.*$", "")


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether any of ``words`` occurs as a substring."""
    tests = [F.contains(text, F.lit(word)) for word in without_redundant(words)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def is_junk_title(
    title: Column, markers: Sequence[str] = rules.JUNK_TITLE_MARKERS
) -> Column:
    """True for missing titles and for titles that carry a non-listing marker."""
    missing = title.isNull() | (title == "")
    return missing | F.coalesce(contains_any(F.lower(title), markers), F.lit(False))


def is_heavy_duty(
    text: Column, make: Column, terms: Mapping[str, Sequence[str]] = rules.HEAVY_DUTY_TERMS
) -> Column:
    """True where the text names a heavy-duty variant of its own make."""
    lowered = F.lower(text)
    hits = [(make == name) & contains_any(lowered, words) for name, words in terms.items()]
    return F.coalesce(reduce(lambda a, b: a | b, hits, F.lit(False)), F.lit(False))
