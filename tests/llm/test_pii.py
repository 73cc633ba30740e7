from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from partyard.llm import bloom, pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append((kind, *m.span()))
    return spans


def test_spans_match_the_patterns():
    rng = random.Random(3)
    pieces = ["a.b@c.de", "x@y", "@", "1.2.3.4", "300.1.1.1", "001.2.3.4.5", "4111111111111111", "4111 1111-1111 1111",
              "+1 (555) 123-4567", "+49", " ", "-", ".", "_", "é", "7", "word", "\n", "a@b.c_d@e.f", "12", "😀"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        assert pii.find_entities(text) == brute(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 400_000 + "@", "1" * 400_000, "1." * 200_000, "+1" + "(" * 300_000, "a@" * 200_000):
        pii.find_entities(text)


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_a_telling_word_is_found_everywhere(spark):
    filler = [f"ordinary prose number{i} about nothing special at all" for i in range(400)]
    near = [f"letter{i} from Zanzibarov wrote jo@ex.org today indeed" for i in range(4)]
    texts = [*filler, *near, "and Zanzibarov came along without an address", "plain words here"]
    out = {r.doc_id: r for r in pii.find_personal_data(table(spark, texts)).collect()}
    hit = out[404].disclosed
    assert [(s.start, s.end, s.action) for s in hit] == [(4, 14, "generalise")]
    assert out[0].disclosed is None and out[405].disclosed is None
    assert {texts[400][s.start : s.end] for s in out[400].disclosed} >= {"Zanzibarov"}


def test_far_and_short_words_disclose_too(spark):
    filler = [f"ordinary prose number{i} about nothing special at all" for i in range(400)]
    gap = "about nothing special at all " * 20
    texts = [*filler, *(f"Li writes, zx_99 page{i}\n{gap}\nmail jo@ex.org" for i in range(11)), "Li was zx_99"]
    texts += ["zx_99 is beside jo@ex.org"] * 3
    out = {r.doc_id: r for r in pii.find_personal_data(table(spark, texts)).collect()}
    assert [(s.start, s.end, s.action) for s in out[411].disclosed] == [(0, 2, "generalise"), (7, 12, "generalise")]
    assert {texts[400][s.start : s.end] for s in out[400].disclosed} >= {"Li", "writes", "zx_99"}
    assert out[0].disclosed is None


def test_copies_prove_nothing(spark):
    texts = ["Zanzibarov wrote jo@ex.org today"] * 6 + [f"other{i} text goes here" for i in range(30)]
    out = pii.find_personal_data(table(spark, texts)).collect()
    assert all(r.disclosed is None for r in out) and len(out) == 36


def disclosing(texts, alpha, support):
    """Brute force: every entity with every word."""
    n = sum(t is not None for t in texts)
    df_term, df_entity, co, held, together = Counter(), Counter(), Counter(), defaultdict(set), defaultdict(set)
    for text in filter(None, texts):
        spans = pii.find_entities(text)
        entities, terms = {(k, text[s:e].lower()) for k, s, e in spans}, pii.terms_of(text, spans)
        df_term.update(terms)
        df_entity.update(entities)
        for e in entities:
            held[e].add(text)
            for t in terms:
                co[e, t] += 1
                together[e, t].add(text)
    actions = defaultdict(set)
    for (e, t), both in co.items():
        content = math.log2(n / df_entity[e])
        if len(together[e, t]) >= support and content > 0:
            if math.log2(both * n / (df_term[t] * df_entity[e])) >= content / alpha:
                actions[t].add(both == df_term[t])
    return {t: "remove" if True in a else "generalise" for t, a in actions.items()}


@pytest.mark.parametrize("alpha", [0.8, 1.0, 1.1, 2.0])
def test_disclosing_words_match_brute_force(spark, alpha):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    texts = [None, "", "jo@ex.org", "jo@ex.org"]
    for i in range(400):
        found = rng.sample(words, rng.randint(1, 12))
        if rng.random() < 0.4:
            found += [f"u{k}@ex.org" for k in rng.sample(range(6), rng.randint(1, 3))]
        texts += [" ".join(found)] * (rng.randint(2, 9) if rng.random() < 0.1 else 1)
    for k in range(6):  # words of one entity, some of them elsewhere too
        texts += [f"only{k} mostly{k} beside{i} u{k}@ex.org" for i in range(k + 1)] + [f"mostly{k} alone"] * (k % 3)
    raw = table(spark, texts).selectExpr("doc_id", "text", "md5(text) AS key")
    got = {r.term: r.action for r in pii.disclosing_terms(raw.repartition(3), alpha).collect()}
    assert got == disclosing(texts, alpha, pii.SUPPORT)
    assert bool(got) == (alpha >= 1)


def counted(monkeypatch):
    """All tables of counts that tasks make."""
    made, kept = pii.map_columns, []

    def remember(*args):
        out = made(*args)
        if out.columns == ["term", "n"]:
            kept.append(out)
        return out

    monkeypatch.setattr(pii, "map_columns", remember)
    return kept


def test_a_task_counts_a_word_once(spark, monkeypatch):
    texts = [f"anna berta clara mail u@ex.org page{i}" for i in range(5)] + ["anna berta clara"] * 6000
    raw = table(spark, texts).selectExpr("doc_id", "text", "md5(text) AS key").coalesce(1)
    kept = counted(monkeypatch)
    wanted = bloom.build(spark.createDataFrame([("anna",), ("berta",)], "term string"), pii.F.col("term"))
    out = {r.term: r.df_term for r in pii._frequencies(raw, wanted).collect()}
    assert out == {"anna": 6005, "berta": 6005}
    assert kept[0].count() == 2


def test_full_counts_are_given_out(monkeypatch):
    monkeypatch.setattr(pii, "FLUSH", 2)
    count = pii.Counts(b"\xff" * (1 << bloom.BITS - 3), pii._words_of_texts)
    assert count({"text": ["anna", None, ""]}) is None
    assert count({"text": ["anna", "berta"]}) == {"term": ["anna", "berta"], "n": [2, 1]}
    assert count.rest() is None and count({"text": ["clara"]}) is None
    assert count.rest() == {"term": ["clara"], "n": [1]}


def test_words_common_beside_entities_are_not_counted_over_the_corpus(spark, monkeypatch):
    texts = [f"common zanzibarov u@ex.org page{i}" for i in range(4)]
    texts += [f"common letter{i} other{i}@ex.org" for i in range(300)] + ["common zanzibarov"] + ["plain text"] * 700
    raw = table(spark, texts).selectExpr("doc_id", "text", "md5(text) AS key").coalesce(1)
    kept = counted(monkeypatch)
    got = {r.term: r.action for r in pii.disclosing_terms(raw).collect()}
    assert got == disclosing(texts, pii.ALPHA, pii.SUPPORT) == {"zanzibarov": "generalise"}
    assert [r.term for r in kept[-1].collect()] == ["zanzibarov"]


def test_query_columns(spark, odd_docs):
    docs = table(spark, ["mail a.b@c.de and 1.2.3.4", "", None]).unionByName(odd_docs.select("doc_id", "text"))
    out = pii.find_personal_data(docs).withColumn("spans", pii.spans_text())
    assert out.count() == docs.count()
    row = out.filter("n_email = 1").first()
    assert row.spans == "email:5:13,ip:18:25"
    assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()


def test_sanitise(spark, clashing_docs, no_docs):
    docs = table(spark, ["mail a.b@c.de, +1 (555) 123-4567.", "é 1.2.3.4 é", None, "clean"])
    got = [r.text for r in pii.sanitise(docs).orderBy("doc_id").collect()]
    assert got == ["mail <EMAIL>, <PHONE>.", "é <IP> é", None, "clean"]
    assert pii.sanitise(clashing_docs).columns == clashing_docs.columns
    assert sorted(map(str, pii.sanitise(clashing_docs).collect())) == sorted(map(str, clashing_docs.collect()))
    assert pii.sanitise(no_docs).count() == 0
