from __future__ import annotations

import random

import numpy as np

from partyard.llm import quality_classifier as q
from tests.llm.conftest import prose


def corpus(n, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        kind = i % 5
        text = prose(rng.randint(40, 200), 1000 + i)
        if kind == 3:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if kind == 4:
            words = text.split()
            for k in range(0, len(words), 12):
                words[k] = "scoundrel"
            text = " ".join(words)
        docs.append((i, text))
        if i % 2 == 0 or i % 5 == 4:
            labels.append((i, int(kind != 3), int(kind == 4)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(3000)
    seen = {i for i, *_ in labels}
    out = q.classify(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    rows = out.collect()
    assert len(rows) == 3000
    held = [r for r in rows if r.doc_id not in seen]
    good = [r.kept for r in held if r.doc_id % 5 < 3]
    bad = [r.kept for r in held if r.doc_id % 5 == 3]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.02
    toxic = [r.kept for r in rows if r.doc_id % 5 == 4]
    assert np.mean(toxic) < 0.05


def test_kth_largest(spark):
    rng = np.random.RandomState(1)
    values = np.concatenate([rng.standard_normal(500) * 10.0 ** rng.randint(-9, 9, 500), [0.0, -0.0, 1.0, 1.0, -np.inf]])
    bits = q.sortable(values)
    assert (np.diff(bits[np.argsort(values, kind="stable")]) >= 0).all()
    table = spark.createDataFrame([(int(b),) for b in bits], "bits long")
    for k in (1, 2, 100, 250, len(bits)):
        assert q.kth_largest(table, k) == sorted(bits.tolist(), reverse=True)[k - 1]


def test_best_cut():
    assert 2 < q.best_cut(np.array([1.0, 2, 3, 4]), np.array([False, False, True, True])) < 3
    assert q.best_cut(np.array([]), np.array([], bool)) == -np.inf
    assert q.best_cut(np.array([1.0, 2]), np.array([True, True])) == -np.inf
    assert q.best_cut(np.array([1.0, 1, 1]), np.array([True, False, True])) == -np.inf


def test_gumbel_noise_draws_by_importance():
    table = np.zeros(q.FEATURES * q.BUCKETS, np.float32)
    score = q.Scorer(table)
    keys = np.array([score(i, "one text")[1] for i in range(20_000)])
    assert abs(keys.mean() - 0.5772) < 0.03 and abs(keys.std() - np.pi / 6**0.5) < 0.03


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, None, 0), (None, 1, 0), (6, 0, 1)], none.schema)
    for labels in (none, odd):
        model = q.Classifier(clashing_docs, labels)
        rows = model.verdicts().collect()
        assert len(rows) == odd_docs.count()
        assert not any(r.kept for r in rows if not r.n_words)
        assert model.keep(clashing_docs).count() == sum(r.kept for r in rows)
        assert model.keep(clashing_docs).columns == clashing_docs.columns
    assert all(r.kept for r in q.classify(odd_docs, none).collect() if r.n_words)
    assert q.classify(no_docs, odd).count() == 0


def test_few_labels_do_not_reject_everything(spark):
    docs = spark.createDataFrame([(i, prose(40, i)) for i in range(40)], "doc_id long, text string")
    for good in (1, 2, 4):  # whichever labels are held out, some text stays
        labels = [(i, int(i < good), 0) for i in range(12)]
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert q.Classifier(docs, table).keep(docs).count() > 0
    absent = [(1, 0, 0)] + [(i, 1, 0) for i in range(1000, 1006)]
    table = spark.createDataFrame(absent, "doc_id long, quality int, toxic int")
    assert q.Classifier(docs, table).keep(docs).count() == 40
