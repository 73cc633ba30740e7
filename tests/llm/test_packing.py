from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from partyard.llm import packing


def one_by_one(sizes, capacities, smallest):
    """Best-fit decreasing over single documents."""
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = min((k for k, (c, u) in enumerate(bins) if c - u >= s), key=lambda k: (bins[k][0] - bins[k][1], k), default=None)
        if fit is None:
            opening = min(
                (c for c in capacities if c >= max(s, smallest)), key=packing.sequence_cost
            )
            bins.append([opening, 0])
            fit = len(bins) - 1
        bins[fit][1] += s
    final = [next(c for c in sorted(capacities) if c >= u) for _, u in bins]
    return sum(map(packing.sequence_cost, final)), sorted(u for _, u in bins)


def test_histogram_packs_like_single_documents():
    rng = random.Random(4)
    for _ in range(120):
        capacities = (16, 32, 64)
        sizes = [rng.choice([rng.randint(1, 64), 5, 7]) for _ in range(rng.randint(0, 150))]
        for smallest in capacities:
            got = packing.pack_histogram(Counter(sizes), capacities, smallest)
            cost, used = one_by_one(sizes, capacities, smallest)
            assert got.cost == cost
            assert sorted(u for _, n, _, u in got.bins.tolist() for _ in range(n)) == used


def test_sizes_are_chosen_jointly():
    counts = {1000: 10, 400: 10}
    uniform = min(packing.pack_histogram(counts, smallest=c).cost for c in packing.CAPACITIES)
    best = packing.best_packing(counts)
    assert (uniform, best.cost) == (16128, 15488)
    assert {c for _, _, c, _ in best.bins.tolist()} == {1024, 2048}


def test_joint_packing_places_everything():
    rng = random.Random(9)
    gained = 0
    for _ in range(150):
        counts = Counter(rng.randint(1, 64) for _ in range(rng.randint(0, 120)))
        got = packing.pack_histogram(counts, (16, 32, 64), jointly=True)
        placed = Counter()
        for size, _, bins, each, _, _ in got.placed.tolist():
            placed[size] += bins * each
        assert placed == counts
        assert sum(n * used for _, n, _, used in got.bins.tolist()) == sum(s * n for s, n in counts.items())
        assert all(used <= capacity for _, _, capacity, used in got.bins.tolist())
        uniform = min(packing.pack_histogram(counts, (16, 32, 64), c).cost for c in (16, 32, 64))
        best = packing.best_packing(counts, (16, 32, 64)).cost
        assert best <= uniform
        gained += best < uniform
    assert gained


def check(rows, sizes, capacities):
    bins = defaultdict(list)
    words = Counter()
    for r in rows:
        if r.n_words:
            bins[r.bin_id].append((r.bin_offset, r.n_words, r.bin_capacity))
        words[r.doc_id] += r.n_words
    assert words == Counter(sizes)
    for held in bins.values():
        at = 0
        for offset, n, capacity in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity and capacity == next(c for c in sorted(capacities) if c >= at)


def test_pack(spark):
    rng = random.Random(8)
    sizes = {i: rng.choice([300, rng.randint(0, 200), 0, 999]) for i in range(2500)}
    docs = spark.createDataFrame(list(sizes.items()), "doc_id long, size long")
    rows = packing.pack(docs, (64, 128, 256)).collect()
    check(rows, sizes, (64, 128, 256))
    assert all(r.bin_id is None for r in rows if not r.n_words)
    assert sum(r.n_words for r in rows) / sum({r.bin_id: r.bin_capacity for r in rows if r.n_words}.values()) > 0.95


def test_odd_rows(spark, odd_docs, no_docs):
    sized = lambda d: d.select("doc_id", F.length("text").cast("long").alias("size"), F.lit(1).alias("piece"))
    out = packing.pack(sized(odd_docs)).collect()
    assert sum(r.n_words for r in out) == odd_docs.agg(F.sum(F.length("text"))).first()[0]
    assert packing.pack(sized(no_docs)).count() == 0
