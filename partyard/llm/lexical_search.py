"""Ranked lexical search with terms partitioned over a pipeline of owners.

The documents are cut into shards of neighbouring rows; a shard lists, for every term
that some item may ask for, its documents and how often they hold it.  Every term has
one owner: owner 0 has the rarest terms, the last one the commonest.  The items travel
in bundles.  A bundle and a shard meet once at each owner, by a cogroup: the owner adds
the integer contributions of its terms to the accumulators the bundle carries for that
shard and sends it on; an accumulator is a pair of item and document with a term in
common so far.  Rare terms go first, so what is carried stays sparse; the owner of the
commonest terms, which fills most of the accumulators, is the last one and only sends
the best of each item to the final selection.

Sizes: a shard holds at most ``SHARD_ROWS`` documents and ``SHARD_BYTES`` of text (or one
longer text), a bundle about ``BUNDLE_TERMS`` terms and ``BUNDLE_ITEMS`` items, so one
group has a bounded table of accumulators and the number of groups grows with the data.
The owners are told by a table of at most 2^22 bytes over hashed terms, which also keeps
words out of the shards that no item has; words that meet in it do no harm, as terms are
compared by their 64-bit hash (two different terms of a corpus of 10^9 words and 10^5
asked ones meet in it with a probability of about 5e-6).  Every document is scored
exactly; no accumulator is dropped before an item's best are chosen.

Defined results: null and empty texts, and those without a term, match nothing and do
not count; items without a term find nothing.  Repeated documents are ranked each;
repeated items each have their own list.  Equal scores go to the smaller id, a null id
comes first.  Texts of any length are searched whole.  Other columns of the input are
not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from partyard.llm.byte_words import byte_words, map_batches, record_batch, slices, texts
from partyard.llm.common import column
from partyard.session import stored

TOP = 50
SHARD_ROWS = 4096
SHARD_BYTES = 16 << 20
BUNDLE_TERMS = 20_000
BUNDLE_ITEMS = 512
MOST_SLOTS = 1 << 22

#: An owner has the terms in at most this share of the documents; the last one the rest.
OWNERS = (1 / 256, 1 / 32, 1 / 8)

#: Weight of a match: w * ((10^9 * tf) div (1000 * tf + 20 * m)), where m is 50 percent
#: fixed and 50 percent the length relative to the mean one.
SCALE, SHARE, NORM, SLOPE = 1_000_000_000, 1000, 20, 50

_SHARD = """shard long, n_docs long, worded long, terms long, doc_ids array<long>, lengths binary,
            held binary, starts binary, members binary, times binary"""
_CARRIED = """bundle long, shard long, items binary, item_at binary, term binary, weight binary, owner binary,
              place binary, score binary"""
_FOUND = "item_no long, doc_id long, score long"


def _hashed(term: bytes) -> int:
    """Hash of a term as a signed number, as Spark's long holds it."""
    h = xxhash.xxh64_intdigest(term)
    return h - (1 << 64) if h >> 63 else h


class _Known(dict):
    """``known[term]``: its hash if the slots may hold it, else none; answers are remembered."""

    def __init__(self, slots: np.ndarray, most: int = 500_000) -> None:
        super().__init__()
        self.slots, self.mask, self.most = slots, len(slots) - 1, most

    def __missing__(self, term: bytes) -> int | None:
        if len(self) >= self.most:
            self.clear()
        h = _hashed(term)
        answer = self[term] = h if self.slots[h & self.mask] else None
        return answer


def _item_terms(items: DataFrame) -> DataFrame:
    """Each item's distinct terms by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [sorted({_hashed(w) for w in byte_words(t)}) for t in texts(part, "text")]
                numbers = np.repeat(part.column("item_no").to_numpy(), [len(f) for f in found])
                yield {"item_no": numbers, "term": [h for f in found for h in f]}

    return map_batches(items.select("item_no", "text"), "item_no long, term long", run)


def _slot_table(rows: DataFrame, size: int) -> np.ndarray:
    """The largest value of each slot, eight slots to a collected row: ``size / 8`` rows at most."""
    per_slot = rows.groupBy("slot").agg(F.max("value").alias("value"))
    packed = per_slot.groupBy((F.col("slot") / 8).cast("long").alias("at")).agg(
        F.sum(F.col("value") * F.pow(F.lit(256.0), F.col("slot") % 8).cast("decimal(20,0)")).alias("bytes")
    )
    out = np.zeros(size // 8, np.uint64)
    for row in packed.collect():
        out[row["at"]] = int(row["bytes"])
    return out.astype("<u8").view(np.uint8)


def _shards(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """One row per run of documents: their lengths and the postings of terms that may be asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        known = _Known(shared.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES, SHARD_ROWS):
                lengths, terms, members, times = [], [], [], []
                for k, text in enumerate(texts(part, "text")):
                    words = byte_words(text)
                    lengths.append(len(words))
                    asked = [(h, n) for w, n in Counter(words).items() if (h := known[w]) is not None]
                    terms += [h for h, _ in asked]
                    times += [n for _, n in asked]
                    members += [k] * len(asked)
                every = np.array(terms, np.int64)
                order = np.argsort(every, kind="stable")
                held, starts = np.unique(every[order], return_index=True)
                n = np.array(lengths, np.int64)
                yield {
                    "shard": [number],
                    "n_docs": [part.num_rows],
                    "worded": [int((n > 0).sum())],
                    "terms": [int(n.sum())],
                    "doc_ids": pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "lengths": [n.tobytes()],
                    "held": [held.tobytes()],
                    "starts": [np.append(starts, len(every)).astype(np.int64).tobytes()],
                    "members": [np.array(members, np.int32)[order].tobytes()],
                    "times": [np.array(times, np.int32)[order].tobytes()],
                }
                number += 1

    read = docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string"))
    return map_batches(read, _SHARD, run)


def _numbers(value: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _holders(shards: DataFrame) -> DataFrame:
    """Documents that hold a term, per shard; the caller adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for k in range(batch.num_rows):
                starts = _numbers(batch.column("starts")[k], np.int64)
                yield {"term": _numbers(batch.column("held")[k], np.int64), "n": np.diff(starts)}

    return map_batches(shards.select("held", "starts"), "term long, n long", run)


def _owned(shards: DataFrame, owners: np.ndarray, owner: int, last: bool) -> DataFrame:
    """The shards as one owner sees them: the postings of its terms only."""
    shared = shards.sparkSession.sparkContext.broadcast(owners)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                held, starts = (_numbers(batch.column(n)[k], np.int64) for n in ("held", "starts"))
                mine = table[held & (len(table) - 1)] == owner + 1
                places = np.repeat(mine, np.diff(starts))
                yield {
                    "shard": batch.column("shard").slice(k, 1),
                    "lengths": batch.column("lengths").slice(k, 1),
                    "held": [held[mine].tobytes()],
                    "starts": [np.concatenate([[0], np.cumsum(np.diff(starts)[mine])]).astype(np.int64).tobytes()],
                    "members": [_numbers(batch.column("members")[k], np.int32)[places].tobytes()],
                    "times": [_numbers(batch.column("times")[k], np.int32)[places].tobytes()],
                    "doc_ids": batch.column("doc_ids").slice(k, 1) if last else pa.array([None], pa.list_(pa.int64())),
                }

    schema = "shard long, lengths binary, held binary, starts binary, members binary, times binary, doc_ids array<long>"
    columns = ["shard", "lengths", "held", "starts", "members", "times", "doc_ids"]
    return map_batches(shards.select(*columns), schema, run)


def _bundles(entries: DataFrame) -> DataFrame:
    """One row per bundle: its items and, per term of an item, weight and owner."""
    columns = "bundle long, items binary, item_at binary, term binary, weight binary, owner binary"
    schema = to_arrow_schema(T._parse_datatype_string(columns), prefers_large_types=False)

    def pack(rows: pa.Table) -> pa.Table:
        every = rows.column("item_no").to_numpy()
        items, at = np.unique(every, return_inverse=True)
        out = {
            "bundle": [rows.column("bundle")[0].as_py()],
            "items": [items.astype(np.int64).tobytes()],
            "item_at": [at.astype(np.int32).tobytes()],
            "term": [rows.column("term").to_numpy().astype(np.int64).tobytes()],
            "weight": [rows.column("weight").to_numpy().astype(np.int64).tobytes()],
            "owner": [rows.column("owner").to_numpy().astype(np.int32).tobytes()],
        }
        return pa.Table.from_batches([record_batch(out, schema)])

    return entries.groupBy("bundle").applyInArrow(pack, columns)


def _visit(owner: int, last: bool, top: int, mean: tuple[int, int]) -> tuple[Callable[[pa.Table, pa.Table], pa.Table], str]:
    """What one owner does with one bundle and one shard."""
    columns = _FOUND if last else _CARRIED
    schema = to_arrow_schema(T._parse_datatype_string(columns), prefers_large_types=False)
    n_docs, n_terms = mean

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        carried = {name: left.column(name)[0] for name in left.column_names}
        shard = {name: right.column(name)[0] for name in right.column_names}
        items = _numbers(carried["items"], np.int64)
        lengths = _numbers(shard["lengths"], np.int64)
        sums = np.zeros((len(items), len(lengths)), np.int64)
        sums.reshape(-1)[_numbers(carried["place"], np.int64)] = _numbers(carried["score"], np.int64)
        held, starts = _numbers(shard["held"], np.int64), _numbers(shard["starts"], np.int64)
        members, times = _numbers(shard["members"], np.int32), _numbers(shard["times"], np.int32).astype(np.int64)
        norm = 100 - SLOPE + (SLOPE * lengths * n_docs) // max(n_terms, 1)
        parts = (SCALE * times) // (SHARE * times + NORM * norm[members])
        mine = np.flatnonzero(_numbers(carried["owner"], np.int32) == owner)
        terms = _numbers(carried["term"], np.int64)[mine]
        places = np.searchsorted(held, terms)
        there = places < len(held)
        there[there] = held[places[there]] == terms[there]
        weights, at = _numbers(carried["weight"], np.int64)[mine], _numbers(carried["item_at"], np.int32)[mine]
        for item, weight, place in zip(at[there].tolist(), weights[there].tolist(), places[there].tolist(), strict=True):
            span = slice(starts[place], starts[place + 1])
            sums[item, members[span]] += weight * parts[span]
        if last:
            return pa.Table.from_batches([record_batch(_best(items, sums, shard["doc_ids"].values, top), schema)])
        filled = np.flatnonzero(sums)
        out = {name: [value.as_py()] for name, value in carried.items()}
        out |= {"place": [filled.astype(np.int64).tobytes()], "score": [sums.reshape(-1)[filled].tobytes()]}
        return pa.Table.from_batches([record_batch(out, schema)])

    return visit, columns


def _best(items: np.ndarray, sums: np.ndarray, doc_ids: pa.Array, top: int) -> dict[str, object]:
    """The ``top`` documents of every item in one shard; ties to the smaller id, null first."""
    known = ~np.asarray(doc_ids.is_null())
    ids = doc_ids.fill_null(0).to_numpy()
    order = np.lexsort([ids, known])
    rows, columns = [], []
    for k in range(len(items)):
        scores = sums[k, order]
        found = np.flatnonzero(scores)
        if len(found) > top:
            edge = np.partition(scores[found], len(found) - top)[len(found) - top]
            found = found[scores[found] >= edge]
            found = found[np.argsort(-scores[found], kind="stable")[:top]]
        rows.append(np.full(len(found), k))
        columns.append(order[found])
    row, at = np.concatenate(rows), np.concatenate(columns)
    return {"item_no": items[row], "doc_id": doc_ids.take(pa.array(at)), "score": sums[row, at]}


def _each(n: int) -> Column:
    """One row per number below ``n``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP) -> DataFrame:
    """The ``top`` documents of every item by descending score: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = stored(
        items.select(column(items, "item_id", "long"), column(items, "text", "string")).withColumn(
            "item_no", F.monotonically_increasing_id()
        )
    )
    entries = stored(_item_terms(asked))
    n_entries, n_items, n_terms = entries.agg(
        F.count("*"), F.count_distinct("item_no"), F.count_distinct("term")
    ).first()
    size = 1 << min(max(12, (16 * n_terms).bit_length()), MOST_SLOTS.bit_length() - 1)
    slot = F.col("term").bitwiseAND(F.lit(size - 1)).alias("slot")
    shards = stored(_shards(docs, _slot_table(entries.select(slot, F.lit(1).alias("value")), size)))
    total = shards.agg(F.coalesce(F.sum("worded"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0)), F.count("*")).first()
    n_docs, n_words, n_shards = total

    counted = _holders(shards).groupBy("term").agg(F.sum("n").alias("df"))
    owner = sum((F.col("df") > int(share * n_docs)).cast("int") for share in OWNERS)
    known = stored(
        entries.select("term").distinct().join(counted, "term").select(
            "term",
            F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).alias("weight"),
            owner.alias("band"),
            slot,
        )
    )
    owners = _slot_table(known.select("slot", (F.col("band") + 1).alias("value")), size)
    bands = known.groupBy("slot").agg(F.max("band").alias("owner"))
    n_bundles = max(1, -(-n_entries // BUNDLE_TERMS), -(-n_items // BUNDLE_ITEMS))
    bundles = _bundles(
        entries.join(known.join(bands, "slot"), "term").select(
            F.pmod(F.xxhash64("item_no"), F.lit(n_bundles)).alias("bundle"), "item_no", "term", "weight", "owner"
        )
    )

    # Every bundle goes to every shard; a bundle is dealt out as often as a thousand shards need it.
    salts = 1 + n_shards // 1000
    met = shards.select("shard", _each(n_bundles).alias("bundle"), F.pmod(F.xxhash64("shard"), F.lit(salts)).alias("salt"))
    dealt = bundles.withColumn("salt", _each(salts))
    empty = F.lit(b"").alias("place"), F.lit(b"").alias("score")
    carried = met.join(dealt, ["bundle", "salt"]).select(
        "bundle", "shard", "items", "item_at", "term", "weight", "owner", *empty
    )
    for stage in range(len(OWNERS) + 1):
        last = stage == len(OWNERS)
        seen = _owned(shards, owners, stage, last).withColumn("bundle", _each(n_bundles))
        visit, columns = _visit(stage, last, top, (n_docs, n_words))
        carried = (
            carried.groupBy("shard", "bundle").cogroup(seen.groupBy("shard", "bundle")).applyInArrow(visit, columns)
        )
    order = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    best = carried.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    ids = asked.select("item_no", "item_id")
    return best.join(ids, "item_no").select("item_id", "rank", "doc_id", "score")
