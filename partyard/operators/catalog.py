"""Catalog lists and vehicle attributes decoded from landed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions import vehicle
from partyard.functions.text import blank_to_null
from partyard.session import stored

#: Names on one page of a paged list.
PAGE_SIZE = 1000


def _sorted_names(rows: DataFrame, keys: list[str], name: Column, alias: str) -> DataFrame:
    """Sorted distinct names per key.

    Names are made distinct in a shuffle on (key, name) first, so a key that
    holds most of the rows arrives as its distinct names only.
    """
    named = rows.select(*keys, name.alias("_name")).filter(F.col("_name").isNotNull())
    return named.distinct().groupBy(*keys).agg(F.array_sort(F.collect_set("_name")).alias(alias))


def make_list(rows: DataFrame) -> DataFrame:
    """The distinct makes, sorted, one per row."""
    makes = rows.select(blank_to_null(F.col("make")).alias("make")).distinct()
    return makes.filter(F.col("make").isNotNull()).orderBy("make")


def model_lists(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """Models of each requested make and year.

    Rows with a year are year-specific, rows without one generic.  The generic
    list of the make answers where the year has no model of its own.
    """
    model = blank_to_null(F.col("model"))
    by_year = _sorted_names(rows.filter("year IS NOT NULL"), ["make", "year"], model, "_own")
    generic = _sorted_names(rows.filter("year IS NULL"), ["make"], model, "_generic")
    asked = requests.select("make", "year").distinct()
    joined = asked.join(by_year, ["make", "year"], "left").join(generic, "make", "left")
    none = F.array().cast("array<string>")
    return joined.select("make", "year", F.coalesce("_own", "_generic", none).alias("models"))


def trim_lists(rows: DataFrame) -> DataFrame:
    """Trims of each make, model and year; blank trims are dropped."""
    trim = F.when(F.trim("trim") != "", F.col("trim"))
    return _sorted_names(rows, ["make", "model", "year"], trim, "trims")


def name_pages(names: DataFrame, keys: Sequence[str], name: str, size: int = PAGE_SIZE) -> DataFrame:
    """Sorted distinct names per key on numbered pages: keys, ``page`` (from 0), ``names``.

    Names are sorted by range over all keys and stored once with the number of their
    range.  A name's place is its place inside the range and the key's names in the
    ranges before, so a key of any size is neither one row nor one task.  Null names
    are left out; a key without names has no page; null keys are keys.
    """
    keys = list(keys)
    distinct = names.select(*keys, F.col(name).alias("_name")).filter(F.col("_name").isNotNull()).distinct()
    ranged = stored(distinct.repartitionByRange(*keys, "_name").withColumn("_range", F.spark_partition_id()))
    # One row per key and range it reaches into: keys and ranges added up at most.
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count("*").alias("_n"))
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_of"),
                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("_range", *keys).orderBy("_name")) - 1
    same = [F.col("_range") == F.col("_of"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]]
    placed = ranged.withColumn("_inside", inside).join(starts, same)
    page = F.floor((F.col("_start") + F.col("_inside")) / size).cast("long")
    return (
        placed.groupBy(*keys, page.alias("page"))
        .agg(F.array_sort(F.collect_list("_name")).alias("names"))
        .select(*keys, "page", "names")
    )


def model_pages(rows: DataFrame, requests: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """The lists of ``model_lists`` on pages; a request without models has one empty page."""
    model = rows.withColumn("model", blank_to_null(F.col("model")))
    own = name_pages(model.filter("year IS NOT NULL"), ["make", "year"], "model", size)
    generic = name_pages(model.filter("year IS NULL"), ["make"], "model", size)
    asked = requests.select("make", "year").distinct()
    answered = own.filter("page = 0").select("make", "year")
    found = asked.join(own, ["make", "year"]).unionByName(
        asked.join(answered, ["make", "year"], "left_anti").join(generic, "make", "left")
    )
    none = F.array().cast("array<string>")
    return found.select(
        "make", "year", F.coalesce("page", F.lit(0).cast("long")).alias("page"), F.coalesce("names", none).alias("models")
    )


def trim_pages(rows: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """The lists of ``trim_lists`` on pages."""
    trims = rows.withColumn("trim", F.when(F.trim("trim") != "", F.col("trim")))
    return name_pages(trims, ["make", "model", "year"], "trim", size).withColumnRenamed("names", "trims")


def vin_profiles(attributes: DataFrame) -> DataFrame:
    """One vehicle per valid VIN from long (vin, variable, value, seq) rows.

    The last usable value of a variable wins.  VINs of the wrong length and
    VINs without year, make or model are left out instead of failing the job.
    The pivot lists its variables, so it needs no extra pass to find them.

    Usable rows go to their VIN's task before anything is sorted: all steps then share
    one shuffle and one sort, and a task sorts its share of the VINs.  Combining below
    the shuffle would sort every row of a scan task, whatever its size.
    """
    wanted = attributes.filter(
        F.col("variable").isin(rules.VIN_VARIABLES)
        & F.col("value").isNotNull()
        & ~F.col("value").isin("", rules.VIN_NO_VALUE)
        & vehicle.is_valid_vin(F.col("vin"))
    ).withColumn("vin", vehicle.clean_vin(F.col("vin")))
    wide = (
        wanted.select("vin", "variable", "value", "seq")
        .repartition("vin")
        .groupBy("vin")
        .pivot("variable", rules.VIN_VARIABLES)
        .agg(F.max_by("value", "seq"))
    )

    def value(name: str) -> Column:
        return F.col(f"`{name}`")

    complete = wide.filter(
        value("Model Year").isNotNull() & value("Make").isNotNull() & value("Model").isNotNull()
    )
    return complete.select(
        "vin",
        value("Model Year").try_cast("int").alias("year"),
        F.trim(value("Make")).alias("make"),
        F.trim(value("Model")).alias("model"),
        value("Trim").alias("trim"),
        value("Series").alias("series"),
        vehicle.body_class(value("Body Class")).alias("body_class"),
        vehicle.drive_type(value("Drive Type")).alias("drive_type"),
        vehicle.compose_engine(
            value("Displacement (L)"),
            value("Engine Configuration"),
            value("Engine Number of Cylinders"),
        ).alias("engine"),
        vehicle.fuel_type(value("Fuel Type - Primary")).alias("fuel_type"),
    )
