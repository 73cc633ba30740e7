from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from partyard.llm import near_dedup as nd
from partyard.llm.components import components
from tests.llm.conftest import WORDS, prose


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(texts, limit=0.8):
    sets, root = [shingles(t or "") for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def drifting(n, seed):
    """A family of copies, each with a few words changed, some copied again."""
    rng = random.Random(seed)
    family = [prose(150, seed).split()]
    for _ in range(n - 1):
        words = list(rng.choice(family))
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        family.append(words)
    return [" ".join(w) for w in family]


def test_matches_brute_force(spark):
    texts = [prose(60, s) for s in range(30)] + drifting(90, 77) + drifting(40, 78) + ["short", "Short", "short text", None, "", " "]
    random.Random(1).shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in nd.near_duplicates(docs).collect()}
    assert [out[i].class_id for i in range(len(texts))] == classes(texts)
    assert [out[i].kept for i in range(len(texts))] == [i == c for i, c in enumerate(classes(texts))]


def test_large_buckets_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(nd, "CHUNK", 6)
    texts = drifting(160, 79)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.class_id for r in nd.near_duplicates(docs).collect()}
    assert [out[i] for i in range(len(texts))] == classes(texts)


def test_repeated_passages_do_not_hide_copies(spark):
    texts = []
    for seed in range(12):
        words = prose(300, 900 + seed).split()
        texts += [" ".join(words), " ".join(words[:90] * 200 + words[90:])]
    out = {r.doc_id: r.class_id for r in nd.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    expected = classes(texts)
    assert len(set(expected)) == 12
    assert [out[i] for i in range(len(texts))] == expected


def weighted(text):
    w = text.lower().split()
    found = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    return {k: 1 + math.log(n) for k, n in found.items()}


def probability_jaccard(x, y):
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in x.keys() & y.keys())


def test_probability_jaccard_is_exact():
    rng = np.random.RandomState(5)
    for _ in range(40):
        x = {k: rng.choice([1.0, 1.7, 5.0]) for k in range(40) if rng.rand() < 0.7}
        y = {k: rng.choice([1.0, 1.7, 9.0]) for k in range(40) if rng.rand() < 0.7}
        sides = [np.array(sorted(s), np.uint32) for s in (x, y)]
        heavy = [np.array([s[k] for k in sorted(s)]) for s in (x, y)]
        assert nd.probability_jaccard(*sides, *heavy) == pytest.approx(probability_jaccard(x, y))


@pytest.mark.parametrize("chunk", [256, 3])
def test_weights_link_what_is_said_often(spark, monkeypatch, chunk):
    """Texts that share a passage said many times and differ in a tail of their own."""
    monkeypatch.setattr(nd, "CHUNK", chunk)
    texts = []
    for group, times in enumerate((1, 2, 30, 60, 200)):
        shared = " ".join([prose(70, 300 + group)] * times)
        texts += [f"{shared} {prose(tail, 400 + 10 * group + k)}" for k, tail in enumerate((12, 25, 40, 60))]
    texts += [prose(90, s) for s in range(500, 510)]
    sets, heavy, near = [shingles(t) for t in texts], [weighted(t) for t in texts], {}
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] & sets[b]:
            plain = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            near[a, b] = plain, probability_jaccard(heavy[a], heavy[b])
    assert any(p < 0.75 and w >= 0.85 for p, w in near.values())
    least = list(range(len(texts)))
    for _ in texts:
        for (a, b), found in near.items():
            if max(found) >= 0.8:
                least[a] = least[b] = min(least[a], least[b])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.class_id for r in nd.near_duplicates(docs).collect()}
    assert [out[i] for i in range(len(texts))] == least


def test_dropping_moves_one_row_per_text_and_task(spark):
    from pyspark.sql import functions as F

    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, " \t\u00a0\u2003\x1c\x85").when(F.col("id") % 3 == 1, prose(60, 4)).otherwise("one").alias("text"),
    )
    left = nd.drop_near_duplicates(docs)
    assert left.count() == 1002
    assert "WindowGroupLimit" in left._jdf.queryExecution().executedPlan().toString()


def test_registers_estimate_probability_jaccard():
    rng = np.random.RandomState(3)
    weights = rng.gamma(1, 1, (2, 60)) + 0.05
    ids = nd.mix64(np.arange(1, 61, dtype=np.uint64))
    x, y = weights
    exact = sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in range(60)) for d in range(60))
    a, b = (nd.signature(ids, w, 6000) for w in weights)
    assert (a == b).mean() == pytest.approx(exact, abs=0.03)


def test_equal_weights_estimate_jaccard():
    ids = nd.mix64(np.arange(1, 301, dtype=np.uint64))
    a, b = nd.signature(ids[:200], np.ones(200), 6000), nd.signature(ids[50:], np.ones(250), 6000)
    assert (a == b).mean() == pytest.approx(150 / 300, abs=0.03)


def test_a_single_shingle_fills_all_registers():
    assert set(nd.signature(np.array([7], np.uint64), np.ones(1)).tolist()) == {7}


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + rng.randrange(1, 400)) for _ in range(600)] + [(5000, 5001), (7, 7)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(301))
    assert all(c == 1000 for n, c in out.items() if 1000 <= n < 1400)
    assert out[5001] == out[5000] == 5000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_drop_keeps_one_of_each(spark, odd_docs, clashing_docs, no_docs):
    left = nd.drop_near_duplicates(clashing_docs)
    assert left.columns == clashing_docs.columns
    ids = sorted((r.doc_id or -1) for r in left.collect())
    # Equal texts of 1, 1 and 6 leave one; the texts without words all stay.
    assert ids == [-1, -1, 1, 2, 3, 4, 5, 7, 8]
    assert nd.drop_near_duplicates(no_docs).count() == 0
    assert nd.near_duplicates(odd_docs).count() == odd_docs.count()


def test_hot_copies(spark):
    from pyspark.sql import functions as F

    text = prose(100, 5)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    out = nd.near_duplicates(docs)
    assert out.filter("class_id = 0").count() == 3000 and out.filter("kept").count() == 1
