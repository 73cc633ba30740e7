from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from partyard.llm import target_resampling as tr

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text, width=2):
    found = words(text)
    return [" ".join(found[i : i + n]) for n in range(1, width + 1) for i in range(len(found) - n + 1)]


def expected(docs, target, percent=25, least=20, buckets=10_000, seed=7):
    """One row per document as the contract words it."""

    def place(feature):
        return zlib.crc32(feature.encode()) % buckets

    raw, wanted = (Counter(place(f) for t in texts for f in features(t)) for texts in ([t for _, t in docs], target))
    total, aim = sum(raw.values()), sum(wanted.values())
    gain = {
        b: math.floor(1000 * math.log((wanted[b] + 1) * (total + buckets) / ((raw[b] + 1) * (aim + buckets)))) for b in raw
    }
    rows = []
    for i, t in docs:
        own = features(t)
        weight = sum(gain[place(f)] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(own), weight, weight + noise, len(words(t)) >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = percent * len(able) // 100
    ranks = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return Counter((*r[:4], ranks.get(id(r))) for r in rows)


def got(docs, target, **options):
    return Counter(map(tuple, tr.resample(docs, target, **options).collect()))


def test_checksums():
    rng = random.Random(3)
    found = [rng.randbytes(rng.choice([0, 1, 2, 3, 7, 8, 31, 400, tr.LONG, tr.LONG + 1, 3000])) for _ in range(500)]
    assert tr.checksums(found).tolist() == [zlib.crc32(f) for f in found]
    assert tr.checksums([]).tolist() == []


def test_features_of_any_width():
    texts = ["One two, two ONE", None, "", "Été à 9", "x", "a b c d e a b c"]
    for width in (1, 2, 3, 4):
        found = tr.Features([t and t.encode() for t in texts], 97, width)
        assert found.n_features().tolist() == [len(features(t, width)) for t in texts]
        gains = np.arange(97) - 40
        want = [sum(int(gains[zlib.crc32(f.encode()) % 97]) for f in features(t, width)) for t in texts]
        assert found.sums(gains).tolist() == want


def test_resampling(spark):
    rng = random.Random(4)
    names = [f"w{k}" for k in range(60)] + ["Straße", "ÉTÉ", "Zoo"]
    rows = [(i, " ".join(rng.choice(names) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    target = [" ".join(rng.choice(names[:20]) for _ in range(50)) for _ in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    aim = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    assert got(docs, aim) == expected(rows, target)
    assert got(docs, aim, percent=100, least_words=0) == expected(rows, target, percent=100, least=0)


def test_odd_rows(spark, odd_docs, odd_rows, clashing_docs, no_docs):
    target = spark.createDataFrame([(1, "amber1 birch2"), (2, None)], "item_id long, text string")
    rows = [r[:2] for r in odd_rows]
    assert got(odd_docs, target, percent=80) == expected(rows, ["amber1 birch2", None], percent=80)
    assert got(clashing_docs, target, percent=80) == expected(rows, ["amber1 birch2", None], percent=80)
    assert got(odd_docs, target.limit(0)) == expected(rows, [])
    assert got(no_docs, target) == Counter()


def test_repeated_ids_share_no_rank(spark):
    """A hot id: all its rows have one score, and every rank is given once."""
    text = " ".join(f"w{k}" for k in range(25))
    docs = spark.range(400).select(
        F.when(F.col("id") < 300, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.lit(text).alias("text")
    )
    out = tr.resample(docs.repartition(8), docs.limit(0), percent=90).collect()
    ranks = sorted(r["rank"] for r in out if r["rank"] is not None)
    assert ranks == list(range(1, 361))
    assert len(out) == 400
