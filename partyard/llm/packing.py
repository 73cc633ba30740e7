"""Variable-capacity best-fit packing of documents into training sequences.

Lengths are whole numbers up to the largest capacity, so the packing is decided on
their histogram: a few thousand rows, however many documents there are.  Bins that
hold the same contents are one group with a count, and best-fit decreasing places
all documents of a length group by group.  Where no open bin holds a document, one
opens with the permitted length that costs least per word of what the documents still to
come would fill it with, so every length gets the bins that suit it.  Packings with one
smallest bin length for all are made too, and the one of least total cost is kept; in
the end each bin shrinks to the smallest permitted length that holds its contents.

Documents longer than the largest capacity are cut into pieces, none of them lost.
Null and blank texts have no words: they return one row without a bin.  Repeated rows
are packed each.  Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partyard.llm.common import map_columns
from partyard.session import stored

CAPACITIES = (1024, 2048, 4096)
SALTS = 256


def sequence_cost(capacity: int) -> float:
    """Cost of one sequence: a linear part and attention's quadratic one."""
    return capacity + capacity * capacity / 16384


@dataclass
class Packing:
    """``placed``: size, first rank, bins, items per bin, first bin, offset in the bin.
    ``bins``: first bin, bins, capacity, words."""

    placed: np.ndarray
    bins: np.ndarray
    cost: float


def _cost_per_word(capacity: int, size: int, left: int, sizes: list[int], counts: dict, final: list[int]) -> float:
    """Cost per word of a bin opened for a size, filled with the largest of what is left."""
    room, n = capacity, min(left, capacity // size)
    while True:
        room -= n * size
        k = bisect_right(sizes, min(room, size - 1)) - 1
        if k < 0:
            break
        size = sizes[k]
        n = min(counts[size], room // size)
    used = capacity - room
    return sequence_cost(next(c for c in final if c >= used)) / used


def pack_histogram(
    counts: dict[int, int],
    capacities: Sequence[int] = CAPACITIES,
    smallest: int | None = None,
    jointly: bool = False,
) -> Packing:
    """Best-fit decreasing over (size, count).

    A document goes to the fullest bin that still holds it; where none does, a bin
    opens: the cheapest permitted one that holds it and is not below ``smallest``, or
    ``jointly`` the one of least cost per word it will hold, ties to the smaller one.
    Groups of equal bins are (room, first bin, bins, used); the order is by room and
    first bin, so ties go to the older bin.
    """
    capacities = sorted(capacities)
    floor = smallest or capacities[0]
    ascending = sorted(s for s in counts if s > 0)
    open_bins: list[tuple[int, int, int, int]] = []
    placed, next_bin = [], 0
    for size in reversed(ascending):
        left, rank = counts[size], 0
        fits = [c for c in capacities if c >= max(size, min(floor, capacities[-1]))]
        while left:
            k = bisect_left(open_bins, (size, -1, 0, 0))
            if k == len(open_bins):
                opening = (
                    min(fits, key=lambda c: _cost_per_word(c, size, left, ascending, counts, capacities))
                    if jointly
                    else min(fits, key=sequence_cost)
                )
                bins = -(-left // (opening // size))
                insort(open_bins, (opening, next_bin, bins, 0))
                next_bin += bins
                continue
            room, first, bins, used = open_bins.pop(k)
            each = room // size
            full = min(bins, left // each)
            if full:
                placed.append((size, rank, full, each, first, used))
                insort(open_bins, (room - each * size, first, full, used + each * size))
            rank, left = rank + full * each, left - full * each
            if full < bins:
                rest = 1 if left else 0  # fewer than ``each`` are left for one more bin
                if rest:
                    placed.append((size, rank, 1, left, first + full, used))
                    insort(open_bins, (room - left * size, first + full, 1, used + left * size))
                    rank, left = rank + left, 0
                if bins - full - rest:
                    insort(open_bins, (room, first + full + rest, bins - full - rest, used))
    final = sorted(
        (first, bins, next(c for c in capacities if c >= used), used)
        for _, first, bins, used in open_bins
        if used
    )
    return Packing(
        np.array(sorted(placed, key=lambda p: p[:2]), np.int64).reshape(-1, 6),
        np.array(final, np.int64).reshape(-1, 4),
        sum(n * sequence_cost(c) for _, n, c, _ in final),
    )


def best_packing(counts: dict[int, int], capacities: Sequence[int] = CAPACITIES) -> Packing:
    tried = [pack_histogram(counts, capacities, c) for c in capacities]
    tried.append(pack_histogram(counts, capacities, jointly=True))
    return min(tried, key=lambda p: p.cost)


def pack(docs: DataFrame, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """Bin of every piece of every document; ``docs`` has ``doc_id`` and ``size``.

    Returns doc_id, piece, first_word, n_words, bin_id, bin_capacity, bin_offset.
    """
    top = max(capacities)
    size = F.coalesce(F.col("size"), F.lit(0)).cast("long")
    last = F.greatest((size - 1) / top, F.lit(0)).cast("long")
    pieces = stored(
        docs.select("doc_id", size.alias("size"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
        .select(
            "doc_id",
            "piece",
            (F.col("piece") * top).alias("first_word"),
            F.least(F.col("size") - F.col("piece") * top, F.lit(top)).cast("long").alias("n_words"),
        )
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    )
    groups = pieces.filter("n_words > 0").groupBy("n_words", "salt").agg(F.count("*").alias("n"))
    counts = {r.n_words: r.n for r in groups.groupBy("n_words").agg(F.sum("n").alias("n")).collect()}
    return _assigned(pieces, groups, best_packing(counts, capacities))


def _assigned(pieces: DataFrame, groups: DataFrame, packing: Packing) -> DataFrame:
    """Number the pieces of each size, by salted parts of it, and look up their bins."""
    by_salt = Window.partitionBy("g_words").orderBy("g_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select(F.col("n_words").alias("g_words"), F.col("salt").alias("g_salt"), "n").select(
        "g_words", "g_salt", F.coalesce(F.sum("n").over(by_salt), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("n_words", "salt").orderBy("doc_id", "piece")
    ranked = (
        pieces.join(
            starts,
            (F.col("n_words") == F.col("g_words")) & (F.col("salt") == F.col("g_salt")),
            "left",
        )
        .withColumn("rank", F.col("start") + F.row_number().over(inside) - 1)
        .select("doc_id", "piece", "first_word", "n_words", "rank")
    )
    placed, bins = packing.placed, packing.bins

    def make():
        # Ranks of one size are contiguous in ``placed``: one key orders sizes and ranks.
        most = int(placed[:, 1].max()) + 1 if len(placed) else 1
        most = max(most, int((placed[:, 1] + placed[:, 2] * placed[:, 3]).max()) if len(placed) else 1)
        keys = placed[:, 0] * most + placed[:, 1]

        def work(rows):
            n = np.array(rows["n_words"], np.int64)
            out = {k: rows[k] for k in ("doc_id", "piece", "first_word", "n_words")}
            held = n > 0
            bin_id = np.zeros(len(n), np.int64)
            offset, capacity = bin_id.copy(), bin_id.copy()
            if held.any():
                rank = np.array([r or 0 for r in rows["rank"]], np.int64)[held]
                p = placed[np.searchsorted(keys, n[held] * most + rank, "right") - 1]
                turn, place = np.divmod(rank - p[:, 1], p[:, 3])
                bin_id[held] = p[:, 4] + turn
                offset[held] = p[:, 5] + place * n[held]
                capacity[held] = bins[np.searchsorted(bins[:, 0], bin_id[held], "right") - 1, 2]
            for name, values in (("bin_id", bin_id), ("bin_capacity", capacity), ("bin_offset", offset)):
                out[name] = [v if h else None for v, h in zip(values.tolist(), held.tolist(), strict=True)]
            return out

        return work

    return map_columns(
        ranked,
        "doc_id long, piece long, first_word long, n_words long, bin_id long, bin_capacity long,"
        " bin_offset long",
        make,
    )
