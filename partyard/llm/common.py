"""What the corpus operators share: column access, word patterns, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLANK = r"[\x20\x09-\x0D]"
SOLID = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(df: DataFrame, name: str, kind: str) -> Column:
    """The column as the given type; nulls where the table lacks it."""
    return (df[name] if name in df.columns else F.lit(None)).cast(kind).alias(name)


def words(text: Column) -> Column:
    """Blank-separated words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANK}+"), "")


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


Columns = dict[str, list]
#: Rows of an Arrow batch that are Python objects at a time.
SLICE_ROWS = 1024


def slices(*arrays: pa.Array) -> Iterator[list[list]]:
    """Equally long Arrow arrays as Python lists, a bounded number of rows at a time."""
    for start in range(0, len(arrays[0]), SLICE_ROWS):
        yield [a.slice(start, SLICE_ROWS).to_pylist() for a in arrays]


def map_columns(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[[Columns], Columns | None]],
    finish: str | None = None,
) -> DataFrame:
    """Apply a function on column lists to every Arrow batch, a slice at a time.

    ``make`` runs once per task and gives the function, so tables and automata are
    built once; ``finish`` names its method that gives a last batch, if any.
    """
    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                for columns in slices(*batch.columns):
                    out = work(dict(zip(batch.schema.names, columns, strict=True)))
                    if out is not None:
                        yield _batch(out, arrow)
        if finish is not None and (out := getattr(work, finish)()) is not None:
            yield _batch(out, arrow)

    return df.mapInArrow(run, kind)


def _batch(out: Columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(out[f.name], f.type) for f in schema], schema=schema)


class Runs:
    """Calls a function on each run of rows with equal keys, across batch borders."""

    def __init__(self, keys: list[str], function: Callable[[Columns], Columns | None]) -> None:
        self.keys, self.function = keys, function
        self.run: Columns = {}
        self.key: tuple | None = None

    def _end(self, out: Columns) -> None:
        if self.run and (found := self.function(self.run)):
            for name, values in found.items():
                out.setdefault(name, []).extend(values)
        self.run = {}

    def __call__(self, rows: Columns) -> Columns | None:
        out: Columns = {}
        keys = list(zip(*(rows[k] for k in self.keys), strict=True))
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if keys[start] != self.key:
                self._end(out)
                self.key = keys[start]
            for name, values in rows.items():
                self.run.setdefault(name, []).extend(values[start:i])
            start = i
        return out or None

    def rest(self) -> Columns | None:
        out: Columns = {}
        self._end(out)
        return out or None


def map_runs(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    schema: str,
    make: Callable[[], Callable[[Columns], Columns | None]],
) -> DataFrame:
    """Apply a function to every group of rows with equal keys, its rows in order.

    One shuffle by the keys and a sort; the groups stream by, so a task holds one group
    at a time.  The caller keeps groups small.
    """
    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return map_columns(ordered, schema, lambda: Runs(keys, make()), "rest")
