"""Importance resampling towards a target distribution, over hashed runs of words.

A feature is a run of one to ``width`` words, a bucket its CRC-32 modulo the number of
buckets.  The gain of a bucket is the log ratio of its smoothed shares in the target
texts and in all documents; a document's weight is the mean gain of its features, and a
seeded Gumbel draw over the weights picks the sample.

Checksums are taken slice by slice: the distinct features of a slice are sorted by
length, those of one length are a matrix of bytes, and all checksums of a matrix go
forward one column at a time; the buckets are then scattered back to the places where
the features stand.

The documents are read twice (counts, weights).  What leaves the first pass is one count
per bucket and task; what the second pass stores is one row of numbers per document.

Defined results: null and empty texts, and those without a word, have no features and
weight 0; they are drawn like all others if ``least_words`` is 0.  Repeated rows each
count, are weighed alike, have the same place in the draw and take neighbouring ranks.
A null id is drawn as the text ``null`` and comes first among equal scores.  Texts of any
length are counted whole; a text longer than a slice is one slice.  Without target texts
all target shares are equal.  Columns of the input other than id and text are not read,
whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partyard.llm.byte_words import byte_words, map_batches, slices, texts
from partyard.llm.common import column
from partyard.session import stored

BUCKETS = 10_000
WIDTH = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

#: Longer features seldom share a length with others; a matrix of one row saves nothing.
LONG = 512

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


_TABLE = _crc_table()


def checksums(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, one matrix per length and one step per column."""
    if not features:
        return np.zeros(0, np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    out = np.zeros(len(features), np.uint32)
    kinds, firsts = np.unique(lengths[order], return_index=True)
    for length, places in zip(kinds.tolist(), np.split(order, firsts[1:]), strict=True):
        rows = [features[k] for k in places]
        if length > LONG:
            out[places] = np.fromiter(map(zlib.crc32, rows), np.uint32, len(rows))
            continue
        matrix = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), length)
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for values in np.ascontiguousarray(matrix.T):
            crc = _TABLE[(crc ^ values) & 0xFF] ^ (crc >> np.uint32(8))
        out[places] = ~crc
    return out


class Features:
    """Buckets of all features of some texts.

    ``buckets[k]`` and ``owners[k]`` hold bucket and text number of each run of k + 1
    words, place by place.
    """

    def __init__(self, found: list[bytes | None], buckets: int, width: int) -> None:
        lists = [byte_words(t) for t in found]
        self.n_words = np.fromiter(map(len, lists), np.int64, len(lists))
        every = [w for words in lists for w in words]
        numbers = {w: k for k, w in enumerate(dict.fromkeys(every))}
        names = list(numbers)
        words = np.fromiter(map(numbers.__getitem__, every), np.int64, len(every))
        owner = np.repeat(np.arange(len(lists)), self.n_words)
        self.buckets = [(checksums(names) % buckets).astype(np.int64)[words]]
        self.owners = [owner]
        runs, run_names = words, names
        for k in range(1, width):
            whole = np.flatnonzero(owner[: max(len(words) - k, 0)] == owner[k:]) if len(words) > k else np.empty(0, np.int64)
            codes = runs[whole] * max(len(names), 1) + words[whole + k]
            distinct, numbered = np.unique(codes, return_inverse=True)
            heads, tails = np.divmod(distinct, max(len(names), 1))
            run_names = [run_names[a] + b" " + names[b] for a, b in zip(heads.tolist(), tails.tolist(), strict=True)]
            self.buckets.append((checksums(run_names) % buckets).astype(np.int64)[numbered])
            self.owners.append(owner[whole])
            runs = np.zeros(len(words), np.int64)
            runs[whole] = numbered

    def counts(self, buckets: int) -> np.ndarray:
        return sum(np.bincount(b, minlength=buckets) for b in self.buckets)

    def n_features(self) -> np.ndarray:
        return sum(np.bincount(o, minlength=len(self.n_words)) for o in self.owners)

    def sums(self, gains: np.ndarray) -> np.ndarray:
        """Sum of the gains of every text's features; places of a text are neighbours."""
        total = np.zeros(len(self.n_words), np.int64)
        for found, owners in zip(self.buckets, self.owners, strict=True):
            running = np.concatenate([[0], np.cumsum(gains[found])])
            ends = np.searchsorted(owners, np.arange(len(self.n_words)), "right")
            starts = np.searchsorted(owners, np.arange(len(self.n_words)), "left")
            total += running[ends] - running[starts]
        return total


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """Features of all texts per bucket: columns ``bucket`` and ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                total += Features(texts(part, "text"), buckets, width).counts(buckets)
        held = np.flatnonzero(total)
        yield {"bucket": held, "n": total[held]}

    found = map_batches(docs.select(column(docs, "text", "string")), "bucket long, n long", run)
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    """The counts on the driver: as many numbers as buckets, whatever the corpus."""
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of smoothed shares, rounded down."""
    n, s, t = len(raw), float(raw.sum()), float(target.sum())
    ratios = ((target + 1.0) * (s + n)) / ((raw + 1.0) * (t + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios.tolist()], np.int64)


def document_weights(docs: DataFrame, gains: np.ndarray, width: int = WIDTH) -> DataFrame:
    """Id, words, features and weight of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                found = Features(texts(part, "text"), len(table), width)
                n = found.n_features()
                yield {
                    "doc_id": part.column("doc_id"),
                    "n_words": found.n_words,
                    "n_features": n,
                    "weight": np.where(n > 0, found.sums(table) // np.maximum(n, 1), 0),
                }

    read = docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string"))
    return map_batches(read, "doc_id long, n_words long, n_features long, weight long", run)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times seeded Gumbel noise of a document, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """Rank of every stored row among the ``drawn`` best; null below them.

    Scores are a few ten thousand integers (a weight is within 1000 times the logarithm
    of the largest double, the noise between -3,100 and 22,900), so their counts are
    added up on the driver.  Inside a score, rows are counted per id and writing task
    first, so rows of one hot id are never one group.
    """
    able = scored.filter("__able")
    counts = sorted(((r["score"], r["count"]) for r in able.groupBy("score").count().collect()), reverse=True)
    befores, before = [], 0
    for score, n in counts:
        if before >= drawn:
            break
        befores.append((score, before))
        before += n
    if not befores:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    least = befores[-1][0]
    chosen = F.col("__able") & (F.col("score") >= least)
    spark = scored.sparkSession
    offsets = F.broadcast(spark.createDataFrame(befores, "__score long, __before long"))
    rows = scored.filter(chosen)
    groups = rows.groupBy("score", "doc_id", "__task").agg(F.count(F.lit(1)).alias("__n"))
    inside = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_first(), "__task")
    running = groups.withColumn(
        "__ahead", F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__n")
    )
    places = running.join(offsets, F.col("score") == F.col("__score")).select(
        F.col("score").alias("__score"),
        F.col("doc_id").alias("__id"),
        F.col("__task").alias("__of"),
        (F.col("__before") + F.col("__ahead")).alias("__place"),
    )
    same = (
        (F.col("score") == F.col("__score")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__task") == F.col("__of"))
    )
    turn = F.row_number().over(Window.partitionBy("score", "doc_id", "__task").orderBy("n_features"))
    rank = (F.col("__place") + turn).cast("long")
    ranked = rows.join(places, same).withColumn("rank", F.when(rank <= drawn, rank))
    others = scored.filter(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*others.columns).unionByName(others)


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    width: int = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """Every document with its weight, score and, where it is drawn, its rank.

    ``percent`` of the documents with at least ``least_words`` words are drawn, rounded
    down; equal scores go to the smaller id.
    """
    gains = bucket_gains(
        _vector(bucket_counts(docs, buckets, width), buckets), _vector(bucket_counts(target, buckets, width), buckets)
    )
    weighed = document_weights(docs, gains, width)
    scored = stored(
        weighed.select(
            "*",
            (F.col("weight") + gumbel(F.col("doc_id"), seed)).cast("long").alias("score"),
            (F.col("n_words") >= least_words).alias("__able"),
            F.spark_partition_id().alias("__task"),
        )
    )
    drawn = percent * scored.filter("__able").count() // 100
    return _ranked(scored, drawn).select("doc_id", "n_features", "weight", "score", "rank")
