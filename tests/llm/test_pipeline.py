from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as cp
from partyard.llm import pii
from partyard.session import stored
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_near_dedup import classes, drifting
from tests.llm.test_packing import check
from tests.llm.test_quality_classifier import corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, odd_rows):
    path = str(tmp_path_factory.mktemp("sf"))
    docs, labels = corpus(2400)
    rows = [(i, t, "en", "abc"[i % 3], len(t)) for i, t in docs]
    rows += [(10_000 + i, t, "en", "a", len(t)) for i, t in enumerate(drifting(25, 3))]
    rows += [(20_000, prose(90, 4) + " mail jo.do@ex.org now", "en", "b", 1)]
    spark.createDataFrame(rows + odd_rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for _, stage in cp.STAGES:
        tables.append(stored(stage(spark, tables[-1], folder)))
    raw, good, single, clean, mixed, packed = (t.collect() for t in tables)
    assert all(t.columns == columns for t in tables[:-1])

    # Clean documents stay, bad ones go.
    kept = {r.doc_id for r in good}
    clean_ids = {i for i in range(2400) if i % 5 < 3}
    assert len(clean_ids - kept) <= 30
    assert len({i for i in range(2400) if i % 5 == 3} & kept) <= 24

    # One document of each class, by brute force.
    texts = [r.text for r in sorted(good, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text))]
    assert len(single) == len(set(classes(texts)))

    # Texts without personal data, everything else unchanged.
    before = {(r.doc_id, r.source): r.text for r in single}
    for r in clean:
        assert not pii.find_entities(r.text)
        assert r.text == before[r.doc_id, r.source] or r.doc_id == 20_000
        assert r.n_chars == len(r.text)

    # Whole documents, no more than three times each.
    times = Counter((r.doc_id, r.text) for r in mixed)
    assert set(times) <= {(r.doc_id, r.text) for r in clean} and max(times.values()) <= 3

    words: Counter = Counter()
    for r in mixed:
        words[r.doc_id] += len(r.text.split())
    check(packed, words, (1024, 2048, 4096))


def test_stages_take_empty_tables(spark, folder, no_docs):
    docs = no_docs
    for _, stage in cp.STAGES:
        docs = stored(stage(spark, docs, folder))
        assert docs.count() == 0
