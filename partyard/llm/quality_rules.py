"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Every rule rejects documents on its own.  Their order does not change the verdict,
only the work: a sample tells what each rule costs and how much it rejects, and the
cascade asks the rule with most rejections per second first.  A document that one
rule rejects is not shown to the later ones.

Nulls and texts without words count as having no word, so they fail the length
rule.  Repeated rows are judged each on its own; columns other than the id and the
text are not read, so their names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyard.llm.common import SOLID, column, words
from partyard.session import settle

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """A named test; ``rejects`` is true for a document that has to go."""

    name: str
    rejects: Column


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word, symbol, line and repetition counts of every text.

    Words in repeated three-word windows are found by sorting the window hashes of a
    text (64 bits) beside their places: equal neighbours are repeats.  It costs
    n log n of the text's words and needs no shuffle.
    """
    text = F.col("text")
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(column(docs, text_col, "string"), F.lit("")).alias("text")
    )
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(SOLID))
    counted = base.select(
        "doc_id",
        "text",
        words(text).alias("words"),
        lines.alias("lines"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    n_words = F.size("words")
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(n_words - 2, F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("hash"), i.alias("at")
        ),
    )
    ordered = counted.select(
        "doc_id",
        "text",
        "word_chars",
        "n_symbols",
        n_words.cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(windows).alias("windows"),
    )
    repeated = F.filter(
        "windows",
        lambda x, i: (F.get("windows", i + 1)["hash"] == x["hash"])
        | ((i > 0) & (F.get("windows", F.greatest(i - 1, F.lit(0)))["hash"] == x["hash"])),
    )
    starts = ordered.withColumn("starts", F.transform(repeated, lambda x: x["at"])).drop("windows")
    covered = F.concat(
        "starts", F.transform("starts", lambda at: at + 1), F.transform("starts", lambda at: at + 2)
    )
    return starts.select(
        "doc_id",
        "text",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
    )


def default_rules() -> list[Rule]:
    """Rules on the columns of ``measured`` and, for the last two, on the text."""
    text, n_words = F.col("text"), F.col("n_words")
    capitals = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))
    letters = F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))
    return [
        Rule("short", n_words < 50),
        Rule("repeats", 100 * F.col("n_repeat_words") > 50 * n_words),
        Rule("word_length", (F.col("word_chars") < 2 * n_words) | (F.col("word_chars") > 20 * n_words)),
        Rule("symbols", 10 * F.col("n_symbols") > n_words),
        Rule("dup_lines", 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        Rule("capitals", 2 * capitals > F.col("word_chars")),
        Rule("letters", 2 * letters < F.col("word_chars")),
    ]


def ordered_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = 1000, seed: int = 7) -> list[Rule]:
    """The rules by rejections per second on a sample, most first.

    The sample (about ``sample_rows`` rows, drawn evenly from the whole table) is
    stored once; every rule runs over it twice and its faster time counts, less what
    a pass over the sample costs without a rule.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = settle(docs.sample(min(1.0, sample_rows / total), seed))

    def seconds(test: Column) -> tuple[float, int]:
        times, hits = [], 0
        for _ in range(2):
            start = time.perf_counter()
            hits = sample.agg(F.count_if(test).alias("n")).first()["n"]
            times.append(time.perf_counter() - start)
        return min(times), hits

    empty, _ = seconds(F.lit(False) & (F.length("text") < 0))
    rates = []
    for rule in rules:
        took, hits = seconds(rule.rejects)
        rates.append(hits / max(took - empty, 1e-3))
    return [r for _, r in sorted(zip(rates, rules, strict=True), key=lambda x: -x[0])]


def cascade(docs: DataFrame, rules: list[Rule], into: str = "rejected_by") -> DataFrame:
    """The first rule, in the given order, that rejects; null for a kept document."""
    verdict = None
    for rule in rules:
        test = F.coalesce(rule.rejects, F.lit(False))
        verdict = F.when(test, rule.name) if verdict is None else verdict.when(test, rule.name)
    return docs.withColumn(into, verdict if verdict is not None else F.lit(None).cast("string"))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: list[Rule] | None = None,
    sample_rows: int = 1000,
) -> DataFrame:
    """Measures and verdict of every document; ``rejected_by`` is null where it is kept."""
    rules = default_rules() if rules is None else rules
    raw = docs.select(F.col(id_col).alias("doc_id"), column(docs, text_col, "string").alias("text"))
    total = raw.count()
    part = raw.sample(min(1.0, sample_rows / total), 7) if total else raw
    order = ordered_rules(measured(part), rules, sample_rows) if total else rules
    return cascade(measured(raw), order).drop("text")


__all__ = ["Rule", "cascade", "default_rules", "measured", "ordered_rules", "quality_rules"]
