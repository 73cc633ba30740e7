"""Personal data: patterns find it, corpus co-occurrence finds the words that give it away.

Entities are found by pattern: e-mail and IP addresses, card and telephone numbers.
The words of every text that holds an entity, however far from it, are its context,
collected over the whole corpus.  A word discloses an entity when seeing it tells (nearly) as much as the entity itself:
pointwise mutual information at least the entity's information content / ``alpha``,
    log2(co * N / (df_word * df_entity)) >= log2(N / df_entity) / alpha,
with all counts over all documents, and the word together with the entity in at least
``support`` different texts, so copies of one text prove nothing.  Such words are
found wherever they occur, also in documents without the entity: a word never seen
without its entity is removed, any other is generalised.

A word is a run of letters, digits and underscores outside of entities, of any length.
Counts of words are gathered only for words that may matter: a Bloom filter of fixed
size lets them through and an exact join decides.  As a word is with an entity no more
often than it is in texts with such entities, nor than the entity is there, it can be in
so many documents at most.  Words that are in more, of the documents with entities alone,
are not counted over the corpus; words that are in more of the corpus are left out before
entities and words are paired.  Nulls and empty texts have no entity.  Texts
are read whole; repeated rows give repeated results; columns other than id and text are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyard.llm import bloom
from partyard.llm.common import Columns, column, map_columns
from partyard.session import stored

KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
# A match cannot start inside a run of digits that it could have started before.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"\w+")

ALPHA = 1.1
SUPPORT = 3
FLUSH = 100_000  # words whose counts a task holds

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def find_emails(text: str) -> list[Span]:
    """Leftmost matches: a match is fixed by its @, its start by the run before it."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
            end = domain.end()
        at = text.find("@", max(end, at + 1))
    return found


def _octet(digits: str) -> bool:
    return len(digits := digits.lstrip("0")) < 4 and int(digits or 0) <= 255


def find_entities(text: str) -> list[Span]:
    """All base spans by kind, then start; places in code points, end exclusive."""
    found = find_emails(text) if "@" in text else []
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_octet, m.groups()))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append(("phone", *m.span()))
    return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _blank(text: str, spans: list[Span]) -> str:
    """The text with its entities blanked out, so that they are no words themselves."""
    pieces, at = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if e > at:
            pieces += [text[at:s], " " * (e - max(s, at))]
            at = e
    return "".join([*pieces, text[at:]])


def terms_of(text: str, spans: list[Span]) -> set[str]:
    """Distinct lower-case words of a text outside of its entities."""
    return {w.lower() for w in set(TERM.findall(_blank(text, spans) if spans else text))}


def _holders(raw: DataFrame) -> DataFrame:
    """Entities and distinct words of every document that has an entity."""

    def make():
        def work(rows):
            out = {"key": [], "entities": [], "terms": []}
            for key, text in zip(rows["key"], rows["text"], strict=True):
                spans = find_entities(text or "")
                if spans:
                    out["key"].append(key)
                    out["entities"].append(sorted({f"{k}:{text[s:e].lower()}" for k, s, e in spans}))
                    out["terms"].append("\n".join(sorted(terms_of(text, spans))))
            return out if out["key"] else None

        return work

    return map_columns(raw, "key string, entities array<string>, terms string", make)


def _narrowed(texts: DataFrame, wanted: bytes) -> DataFrame:
    """Texts with only the words that the filter lets through."""

    def make():
        passed = bloom.Passed(wanted)

        def work(rows):
            terms = [[t for t in found.split("\n") if passed[t]] for found in rows["terms"]]
            return {"key": rows["key"], "terms": terms}

        return work

    return map_columns(texts, "key string, terms array<string>", make).filter(F.size("terms") > 0)


class Counts:
    """Documents per word over a whole task, given out when there are many words and at the end."""

    def __init__(self, wanted: bytes, words: Callable[[Columns], Iterable[Iterable[str]]]) -> None:
        self.passed, self.words = bloom.Passed(wanted), words
        self.counts: Counter = Counter()

    def __call__(self, rows: Columns) -> Columns | None:
        passed = self.passed
        for found in self.words(rows):
            self.counts.update([w for w in found if passed[w]])
        return self.rest() if len(self.counts) >= FLUSH else None

    def rest(self) -> Columns | None:
        counts, self.counts = self.counts, Counter()
        return {"term": list(counts), "n": list(counts.values())} if counts else None


def _words_of_texts(rows: Columns) -> Iterable[Iterable[str]]:
    return (terms_of(text, find_entities(text)) for text in rows["text"] if text)


def _words_of_holders(rows: Columns) -> Iterable[Iterable[str]]:
    return (terms.split("\n") for terms in rows["terms"])


def _frequencies(
    docs: DataFrame, wanted: bytes, words: Callable[[Columns], Iterable[Iterable[str]]] = _words_of_texts
) -> DataFrame:
    """Documents per word, for words the filter lets through."""
    counts = map_columns(docs, "term string, n long", lambda: Counts(wanted, words), "rest")
    return counts.groupBy("term").agg(F.sum("n").alias("df_term"))


def _usable(held: Column, most: int, n: float, alpha: float) -> Column:
    """The most documents that a word may be in and disclose an entity.

    It is with none in more than its ``held`` documents, no entity is in more than ``most``.
    (With ``alpha`` below 1 no word discloses anything.)
    """
    co = F.least(held, F.lit(most)).cast("double")
    return co * F.pow(F.lit(n) / co, F.lit(1 - 1 / alpha)) * (1 + 1e-9)


def disclosing_terms(raw: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """Words that disclose an entity: term, action (``remove`` or ``generalise``)."""
    holders = stored(_holders(raw))
    # Rows of one text have the same entities, so each entity counts the text's copies.
    mentions = holders.select("key", F.explode("entities").alias("entity")).groupBy("entity", "key").agg(
        F.count("*").alias("n")
    )
    entities = stored(
        mentions.groupBy("entity")
        .agg(F.sum("n").alias("df_entity"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= support)
        .drop("texts")
    )
    mentions = stored(mentions.join(entities.select("entity"), "entity"))
    held = mentions.groupBy("key").agg(F.max("n").alias("copies"))
    texts = stored(holders.select("key", "terms").dropDuplicates(["key"]).join(held, "key"))
    listed_terms = texts.select("copies", F.explode(F.split("terms", "\n")).alias("term")).filter("term <> ''")
    shared = listed_terms.groupBy("term").agg(F.count("*").alias("texts"), F.sum("copies").alias("held"))
    n = float(max(raw.filter("text IS NOT NULL").count(), 1))
    most = entities.agg(F.max("df_entity")).first()[0] or 0
    usable = _usable(F.col("held"), most, n, alpha).alias("usable")
    shared = stored(shared.filter(F.col("texts") >= support).select("term", usable))
    among = _frequencies(holders, bloom.build(shared, F.col("term")), _words_of_holders)
    wanted = stored(shared.join(among, "term").filter("df_term <= usable").drop("df_term"))
    known = _frequencies(raw, bloom.build(wanted, F.col("term")))
    known = stored(known.join(wanted, "term").filter("df_term <= usable").drop("usable"))
    narrowed = _narrowed(texts.drop("copies"), bloom.build(known, F.col("term")))
    together = (
        mentions.join(narrowed, "key")
        .select("entity", "n", F.explode("terms").alias("term"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("co"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= support)
    )
    n = F.lit(n)
    judged = (
        together.join(entities, "entity")
        .join(known, "term")
        .withColumn("pmi", F.log2(F.col("co") * n / (F.col("df_term").cast("double") * F.col("df_entity"))))
        .withColumn("content", F.log2(n / F.col("df_entity")))
        .filter((F.col("pmi") >= F.col("content") / alpha) & (F.col("content") > 0))
    )
    removed = F.max(F.col("co") == F.col("df_term"))
    return judged.groupBy("term").agg(F.when(removed, "remove").otherwise("generalise").alias("action"))


FOUND = (
    "doc_id long, key string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
    " base array<struct<kind:string,start:long,end:long>>,"
    " maybe array<struct<term:string,start:long,end:long>>"
)


def _found(raw: DataFrame, terms: bytes) -> DataFrame:
    def make():
        passed = bloom.Passed(terms)

        def one(text: str):
            base = find_entities(text)
            maybe = []
            plain = _blank(text, base) if base else text
            if any(passed[w.lower()] for w in set(TERM.findall(plain))):
                maybe = [
                    {"term": w, "start": m.start(), "end": m.end()}
                    for m in TERM.finditer(plain)
                    if passed[w := m[0].lower()]
                ]
            return base, maybe

        def work(rows):
            done = [one(t or "") for t in rows["text"]]
            out = {"doc_id": rows["doc_id"], "key": rows["key"], "maybe": [m for _, m in done]}
            for kind in KINDS:
                out[f"n_{kind}"] = [sum(k == kind for k, _, _ in b) for b, _ in done]
            out["base_sha256"] = [hashlib.sha256(listed(b).encode()).hexdigest() for b, _ in done]
            out["base"] = [[{"kind": k, "start": s, "end": e} for k, s, e in b] for b, _ in done]
            return out

        return work

    return map_columns(raw, FOUND, make)


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    alpha: float = ALPHA,
    support: int = SUPPORT,
) -> DataFrame:
    """Base spans and disclosing words of every document.

    Returns doc_id, key (digest of the text), the counts and digest of the base spans,
    ``base`` and ``disclosed`` (arrays of spans; the latter with its action).
    """
    text = column(docs, text_col, "string")
    raw = docs.select(F.col(id_col).cast("long").alias("doc_id"), text, F.md5(text).alias("key"))
    raw = raw.withColumnRenamed(text_col, "text")
    terms = stored(disclosing_terms(raw, alpha, support))
    found = stored(_found(raw, bloom.build(terms, F.col("term"))))
    candidates = (
        found.filter(F.size("maybe") > 0)
        .select("key", F.explode("maybe").alias("m"))
        .select("key", "m.term", "m.start", "m.end")
        .distinct()
    )
    spans = (
        candidates.join(terms, "term")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "action"))).alias("disclosed"))
    )
    return found.drop("maybe").join(spans, "key", "left")


def spans_text(base: str = "base", disclosed: str = "disclosed"):
    """All spans as text: kind:start:end, by kind, then start."""
    own = F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    more = F.transform(
        F.coalesce(F.col(disclosed), F.array()),
        lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(F.concat(own, more), ",")


def rewrite(text: str, base: list[Span], disclosed: list[tuple[int, int, str]]) -> str:
    """Entities become their labels, disclosing words go or become ``<TERM>``."""
    spans = [(s, e, LABELS[k]) for k, s, e in base]
    spans += [(s, e, "" if action == "remove" else "<TERM>") for s, e, action in disclosed]
    pieces, at = [], 0
    for start, end, label in sorted(spans):
        if start >= at:
            pieces += [text[at:start], label]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns kept, with personal data out of their texts."""
    kind = docs.schema
    found = find_personal_data(docs, id_col, text_col)
    changed = (
        found.filter((F.size("base") > 0) | F.col("disclosed").isNotNull())
        .select(F.col("key").alias("__key"), F.col("base").alias("__base"), F.col("disclosed").alias("__disclosed"))
        .dropDuplicates(["__key"])
    )
    joined = docs.join(changed, F.md5(docs[text_col]) == F.col("__key"), "left")
    new_text = F.pandas_udf(_rewritten, "string")
    text = F.when(F.col("__key").isNull(), F.col(text_col)).otherwise(
        new_text(F.col(text_col), F.to_json("__base"), F.to_json(F.coalesce("__disclosed", F.array())))
    )
    return joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in kind.names))


def _rewritten(text, base, disclosed):
    import json

    import pandas as pd

    out = []
    for t, b, d in zip(text, base, disclosed, strict=True):
        if t is None or not b:
            out.append(t)
            continue
        spans = [(x["kind"], x["start"], x["end"]) for x in json.loads(b)]
        words = [(x["start"], x["end"], x["action"]) for x in json.loads(d or "[]")]
        out.append(rewrite(t, spans, words))
    return pd.Series(out, dtype="object")
