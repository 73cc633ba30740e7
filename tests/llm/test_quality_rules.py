from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from partyard.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in q.SYMBOLS for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures(spark, odd_docs):
    texts = ["a b c a b c a", "x\ny\nx\n\n \n x\nx", "a a a a", "p q r s p q r", "é#ü $$ 😀 |", None, "\x0b\x1c b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.unionByName(odd_docs.select("doc_id", "text"))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = q.measured(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert tuple(row[c] for c in columns) == brute(row.text)


def test_order_does_not_change_the_verdict(odd_docs):
    rules = q.default_rules()
    results = []
    for order in (rules, rules[::-1]):
        out = q.quality_rules(odd_docs, rules=order).withColumn("kept", F.col("rejected_by").isNull())
        results.append(sorted(map(str, out.drop("rejected_by").collect())))
    assert results[0] == results[1]


def test_cascade_asks_the_best_rule_first(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.lit(5).alias("n"))
    none, every = q.Rule("none", F.col("n") > 9), q.Rule("every", F.col("n") < 9)
    assert [r.name for r in q.ordered_rules(docs, [none, every])] == ["every", "none"]
    assert q.cascade(docs, [none, every]).select("rejected_by").distinct().first()[0] == "every"


def test_no_python_in_the_plan(odd_docs):
    plan = q.quality_rules(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_and_clashing(no_docs, clashing_docs, odd_docs):
    assert q.quality_rules(no_docs).count() == 0
    assert q.quality_rules(clashing_docs).count() == odd_docs.count()
