"""Words of UTF-8 texts cut at the level of bytes, in slices of bounded size.

Every byte of a character beyond ASCII is at least 0x80 and belongs to a word, so
texts need not be decoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Text that one call works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

#: Lower case for A-Z, a space for every byte that no word holds.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def byte_words(text: bytes | None) -> list[bytes]:
    """Maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` with A-Z lower-cased; null has none."""
    return text.translate(_FOLD).split() if text else []


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold at most ``limit`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, before + limit, "right")))
        stop = min(stop, start + rows) if rows else stop
        yield batch.slice(start, stop - start)
        start = stop


def map_batches(
    df: DataFrame, schema: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, object]]]
) -> DataFrame:
    """``mapInArrow`` for functions that give columns by name: lists, arrays or Arrow arrays."""
    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind, prefers_large_types=False)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(found):
            yield record_batch(out, arrow)

    return df.mapInArrow(batches, kind)


def record_batch(out: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [v if isinstance(v := out[f.name], pa.Array) else pa.array(v, f.type) for f in schema]
    return pa.record_batch(arrays, schema=schema)


def texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()
