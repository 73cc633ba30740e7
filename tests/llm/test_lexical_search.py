from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from partyard.llm import lexical_search as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def expected(docs, items, top=50):
    """Every item's ranking as the contract words it, one row after the other."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = Counter()
    for item, text in items:
        found = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for w in set(terms(text)) & c.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                m = 100 - 50 + (50 * n * n_docs) // total
                score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0:
                found.append((-score, i is not None, i or 0))
        for rank, (score, known, i) in enumerate(sorted(found)[:top], 1):
            out[item, rank, i if known else None, -score] += 1
    return out


def frames(spark, docs, items, parts=3):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.fixture(scope="module")
def corpus():
    """Words from the rarest to one in every document, ties and copies."""
    rng = random.Random(8)
    names = [f"W{k}" for k in range(120)] + ["Straße", "ÉTÉ"]
    docs = [
        (i, " ".join(["the", *(names[min(int(rng.expovariate(0.06)), 121)] for _ in range(rng.randint(0, 70)))]))
        for i in range(240)
    ]
    docs += [(1000 + i, docs[5][1]) for i in range(60)]
    items = [(k, " ".join(rng.choice(names) for _ in range(rng.randint(1, 25)))) for k in range(15)]
    items += [(90, "the"), (91, "nowhere-to-be-found"), (92, docs[5][1].upper())]
    return docs, items


def test_search(spark, corpus):
    docs, items = corpus
    assert Counter(map(tuple, ls.search(*frames(spark, docs, items)).collect())) == expected(docs, items)


def test_small_shards_and_bundles(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(ls, "BUNDLE_ITEMS", 4)
    monkeypatch.setattr(ls, "BUNDLE_TERMS", 40)
    out = ls.search(*frames(spark, docs, items, 29), top=7)
    assert Counter(map(tuple, out.collect())) == expected(docs, items, 7)


def test_slots_that_words_share(spark, corpus, monkeypatch):
    """With few slots all words meet in some; owners change, results do not."""
    docs, items = corpus
    monkeypatch.setattr(ls, "MOST_SLOTS", 16)
    assert Counter(map(tuple, ls.search(*frames(spark, docs, items)).collect())) == expected(docs, items)


def test_odd_rows(spark, odd_docs, odd_rows, clashing_docs, no_docs):
    rows = [r[:2] for r in odd_rows]
    asked = [(1, "amber1 birch2 one"), (1, "amber1 birch2 one"), (2, None), (None, "One"), (3, ""), (4, "x" * 200_000)]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumns(
        {n: F.lit("x") for n in ("rank", "score", "item_no", "term", "bundle", "shard")}
    )
    want = expected(rows, asked)
    assert Counter(map(tuple, ls.search(odd_docs, items).collect())) == want
    assert Counter(map(tuple, ls.search(clashing_docs, items).collect())) == want
    assert ls.search(no_docs, items).count() == 0
    assert ls.search(odd_docs, items.limit(0)).count() == 0


def test_shards_are_bounded(spark):
    docs = spark.range(10_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    found = ls._shards(docs, __import__("numpy").ones(16, "uint8"))
    rows = found.select("shard", "n_docs", "terms").collect()
    assert max(r.n_docs for r in rows) <= ls.SHARD_ROWS and sum(r.terms for r in rows) == 20_000
    assert len({r.shard for r in rows}) == len(rows)
