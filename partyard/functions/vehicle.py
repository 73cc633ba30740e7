"""Readable labels for decoded vehicle attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions.numeric import round_exact
from partyard.functions.text import blank_to_null, contains_any


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def compose_engine(displacement: Column, layout: Column, cylinders: Column) -> Column:
    """Short engine label such as ``3.6L V6``; null when nothing is known."""
    liters = round_exact(displacement.try_cast("double"), 1)
    size = F.coalesce(F.format_string("%.1fL", liters), displacement)
    size = F.when(liters.isNull(), displacement).otherwise(size)
    count = _strip(blank_to_null(cylinders))
    shape = F.upper(blank_to_null(layout))
    block = (
        F.when(shape.isNull(), F.concat(count, F.lit("-cyl")))
        .when(
            F.contains(shape, F.lit("V")) & F.contains(shape, F.lit("SHAPED")),
            F.concat(F.lit("V"), count),
        )
        .when(contains_any(shape, ["IN-LINE", "STRAIGHT"]), F.concat(F.lit("I"), count))
        .when(contains_any(shape, ["FLAT", "BOXER", "OPPOSED"]), F.concat(F.lit("H"), count))
        .when(contains_any(shape, ["ROTARY", "WANKEL"]), F.lit("Rotary"))
        .otherwise(F.concat(count, F.lit("-cyl")))
    )
    block = F.when(count.isNotNull(), block)
    return blank_to_null(F.concat_ws(" ", blank_to_null(size), block))


def drive_type(raw: Column) -> Column:
    upper = F.upper(raw)
    tests = [F.when(contains_any(upper, words), F.lit(label)) for label, words in rules.DRIVE_TYPES]
    return F.when(raw != "", F.coalesce(*tests, _strip(raw)))


def body_class(raw: Column) -> Column:
    """Short body label; other text loses a trailing remark in parentheses."""
    lowered = F.lower(raw)
    tests = [F.when(F.contains(lowered, F.lit(w)), F.lit(label)) for label, w in rules.BODY_CLASSES]
    plain = _strip(F.regexp_replace(_strip(raw), r"(?U)\s*\([^)]+\)\s*$", ""))
    return F.when(raw != "", F.coalesce(*tests, blank_to_null(plain)))


def fuel_type(raw: Column) -> Column:
    text = F.lower(raw)

    def has(*words: str) -> Column:
        return contains_any(text, words)

    label = (
        F.when(has("gasoline", "petrol"), "Gas")
        .when(has("diesel"), "Diesel")
        .when(has("electric") & ~has("hybrid"), "Electric")
        .when(has("hybrid") & has("plug"), "Plug-in Hybrid")
        .when(has("hybrid"), "Hybrid")
        .when(has("natural gas", "cng"), "CNG")
        .when(has("flex", "e85", "ethanol"), "Flex Fuel")
        .otherwise(_strip(raw))
    )
    return F.when(raw != "", label)


def clean_vin(vin: Column) -> Column:
    return F.upper(_strip(vin))


def is_valid_vin(vin: Column) -> Column:
    return F.coalesce(F.length(clean_vin(vin)) == rules.VIN_LENGTH, F.lit(False))
