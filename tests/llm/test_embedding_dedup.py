from __future__ import annotations

import numpy as np

from partyard.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    usable = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[k] = np.array(v)
    near = {k: set() for k in range(len(rows))}
    for a in usable:
        for b in usable:
            x, y = usable[a], usable[b]
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    near[a].add(b)
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[s][0] for s in seen if rows[s][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[k][0], len(near[k]), component, rows[k][0] == component))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    rng = np.random.RandomState(0)
    rows, bases = [], rng.standard_normal((40, 64))
    for i in range(400):
        v = bases[rng.randint(40)] + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.16])
        rows.append((i, v.tolist(), int(rng.randint(3))))
    rows += [(400 + i, bases[0].tolist(), 1) for i in range(30)] + [(7, bases[0].tolist(), 1)]
    rows += [(440, None, 1), (441, [], 1), (442, [0.0] * 64, 1), (443, [None] + [1.0] * 63, 1)]
    rows += [(444, [float("nan")] * 64, 1), (445, [float("inf")] * 64, 1), (446, bases[0].tolist(), None)]
    rows += [(None, bases[1].tolist(), 2), (447, (bases[0] * 1e300).tolist(), 1), (448, bases[0][:32].tolist(), 1)]
    out = ed.embedding_links(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, out), key=str) == brute([(i, [x / 1e300 for x in v] if i == 447 else v, c) for i, v, c in rows])


def test_large_buckets_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(ed, "CHUNK", 7)
    rng = np.random.RandomState(1)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * 0.08).tolist(), 0) for i in range(150)]
    out = ed.embedding_links(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, out), key=str) == brute(rows)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.RandomState(2)
    turn = ed.rotation(64)
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, 3000, 64)))
    zx, zy = x @ turn.T, y @ turn.T
    size = zx.shape[1]
    factor = np.abs(zx).sum(axis=1) / np.sqrt(size)
    error = (np.sign(zx) * zy).sum(axis=1) / np.sqrt(size) / factor - (x * y).sum(axis=1)
    assert abs(error.mean()) < 0.004
    assert (np.abs(error) < ed.error_bound(factor, size)).all()


def test_empty(spark):
    assert ed.embedding_links(spark.createDataFrame([], SCHEMA)).count() == 0
