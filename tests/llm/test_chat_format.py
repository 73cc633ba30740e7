from __future__ import annotations

import itertools
import random

import numpy as np

from partyard.llm import chat_format as cf
from tests.llm.conftest import prose

SCHEMA = "conv_id long, turn long, role string, text string"


def chats(n, seed=0, marked=False):
    rng = random.Random(seed)
    names = {"user": "Human", "assistant": "Assistant", "system": "System"}
    rows = []
    for c in range(n):
        roles = (["system"] if rng.random() < 0.3 else []) + ["user", "assistant"] * rng.randint(1, 4)
        for t, role in enumerate(roles):
            text = prose({"system": 4, "user": 12, "assistant": 70}[role], c * 50 + t)
            rows.append((c, t, role, f"{names[role]}: {text}" if marked else text + ("?" if role == "user" else ".")))
    return rows


def test_held_out_roles(spark):
    rows = chats(300)
    hidden = [(c, t, r if c < 200 else None, x) for c, t, r, x in rows]
    out = {(r.conv_id, r.turn): r.role for r in cf.format_chats(spark.createDataFrame(hidden, SCHEMA)).collect()}
    held = [(out[c, t], r) for c, t, r, _ in rows if c >= 200]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_markers_split_a_transcript(spark):
    text = "System: be kind\nUser: hi there\nand more\nAssistant: hello\nUser: bye"
    out = cf.format_chats(spark.createDataFrame([(1, 0, None, text)], SCHEMA)).orderBy("segment").collect()
    assert [(r.role, r.content) for r in out] == [
        ("system", "be kind"), ("user", "hi there\nand more"), ("assistant", "hello"), ("user", "bye"),
    ]
    assert out[1].rendered == "<|im_start|>user\nhi there\nand more<|im_end|>\n"


def test_viterbi_is_the_best_path():
    rng = np.random.RandomState(0)
    model = cf.Model({}, {}, {})
    for _ in range(40):
        steps = model.steps(np.array([cf.observe("x" * rng.randint(0, 50))[0] for _ in range(4)]))
        steps[:, :, : cf.S] += rng.standard_normal((4, cf.N, cf.S))
        paths = itertools.product(range(cf.S), repeat=4)
        score = lambda p: sum(s[a, b] for s, a, b in zip(steps, (cf.S, *p), p, strict=False))
        best = max(paths, key=score)
        assert tuple(cf.viterbi(steps, None, None)) == best
        assert np.isclose(cf.product(steps)[cf.S].max(), score(best))


def test_blocks_decode_like_one_chain(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, t, ["user", "assistant"][t % 2], prose(rng.choice([3, 30]), t)) for t in range(120)]
    rows += [(2, t, None, prose(rng.choice([3, 30]), 500 + t)) for t in range(70)]
    docs = spark.createDataFrame(rows, SCHEMA)
    results = []
    for block in (1000, 4):
        monkeypatch.setattr(cf, "BLOCK", block)
        results.append(sorted((r.conv_id, r.turn, r.segment, r.role) for r in cf.format_chats(docs).collect()))
    assert results[0] == results[1] and len(results[0]) == 190


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", ""), (3, None, "Human", "x"), (3, 0, "robot", None), (3, 0, "user", "x"),
        (3, 0, "user", "x"), (4, -5, "assistant", "\n\n"), (5, 10**12, "user", "late"), (6, 1, "user", "y\n" * 50_000),
    ]
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' block", "'x' codes", "'x' segment", "'x' text_key")
    out = cf.format_chats(extra).collect()
    assert {(r.conv_id, r.turn) for r in out} == {(None, 0), (None, 1), (3, 0), (4, -5), (5, 10**12), (6, 1)}
    assert sum(r.conv_id == 3 for r in out) == 2
    assert cf.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_are_counted_and_train(spark):
    rows = [(None, None, "user", "Hello")] * 3 + [(None, None, "tool", "Hello"), (1, 0, None, "yes"), (1, 0, None, "yes")]
    out = cf.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.conv_id, r.turn, r.content, r.copies) for r in out} == {(None, 0, "Hello", 4), (1, 0, "yes", 2)}


def test_no_block_holds_more_than_its_rows(spark, monkeypatch):
    rows = [(None, None, "user", prose(5, i)) for i in range(400)] + [(1, 7, None, prose(40, i)) for i in range(300)]
    rows += [(c, t, "assistant", prose(9, c * 10 + t)) for c in range(2, 40) for t in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    groups, results = [], []
    runs = cf.map_runs

    def watched(df, keys, order, schema, make):
        groups.append(df.groupBy(*keys).count().agg({"count": "max"}).first()[0])
        return runs(df, keys, order, schema, make)

    monkeypatch.setattr(cf, "map_runs", watched)
    for block in (8, 1000):
        monkeypatch.setattr(cf, "BLOCK", block)
        results.append(sorted((r.conv_id or 0, r.turn, r.content, r.role) for r in cf.format_chats(docs).collect()))
        assert max(groups) <= block
        groups.clear()
    assert results[0] == results[1] and len(results[0]) == len(rows)
