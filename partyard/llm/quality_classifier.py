"""Quality by importance resampling: target over raw n-gram models, Gumbel top-k.

Two hashed n-gram models are counted: one over all documents (raw), one over labelled
good documents (target).  A document's importance is the sum of log(target / raw) over
its n-grams, divided by the root of its length, so that long texts do not win by
length alone.  Features are words as they stand, words in lower case without outer
punctuation, and pairs of the latter, each with hash buckets of its own.  Buckets in
which target and raw counts differ by less than ``Z`` standard errors say nothing and
count 0: rare words would else drown the rest.

The k documents with the largest importance / ``TEMPERATURE`` + Gumbel noise are kept,
which draws k documents without replacement by importance.  k is the number of
documents above the importance that parts labelled good from other documents best,
measured on labelled documents that the models have not seen.

The target model and k are fitted on at most ``FIT_ROWS`` labelled documents, chosen
by a hash of their ids; raw counts cover all documents and the decision every one.
Null and blank texts are rejected.  Without usable labels every other text is kept.
Ties at the last place are all kept.  Repeated rows get the same noise and verdict.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyard.llm.common import column, map_columns, slices
from partyard.session import stored

BUCKET_BITS = 19
BUCKETS = 1 << BUCKET_BITS
FEATURES = 3
BLOCK = 4096
FIT_ROWS = 25_000
CALIBRATION_SHARE = 5  # one labelled row in so many sets k instead of feeding the model
PRIOR = 1.0
Z = 3.5
TEMPERATURE = 0.05
SEED = 11
FLUSH = 1_000_000
REMEMBERED = 100_000  # words whose buckets a task keeps
TRIM = ".,;:!?\"'()[]{}"


class Hashed(dict):
    """Two bucket numbers per word, packed into one integer and remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        plain = word.strip(TRIM).lower()
        low = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
        high = xxhash.xxh64_intdigest(plain.encode("utf-8", "surrogatepass"), 1) & (BUCKETS - 1)
        packed = self[word] = low | high << BUCKET_BITS
        return packed

    def features(self, text: str) -> np.ndarray:
        """Bucket numbers of all features of a text, feature k from k * BUCKETS on."""
        found = text.split()
        packed = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        plain = packed >> BUCKET_BITS
        pairs = ((plain[:-1] * 0x9E3779B1 + plain[1:] * 0x85EBCA77) >> 7) & (BUCKETS - 1)
        return np.concatenate([packed & (BUCKETS - 1), plain + BUCKETS, pairs + 2 * BUCKETS])


class Counter:
    """Counts one task's features in full arrays and gives their blocks at the end."""

    def __init__(self, good: frozenset[int]) -> None:
        self.good, self.hashed = good, Hashed()
        self.raw = np.zeros(FEATURES * BUCKETS, np.int32)
        self.target = np.zeros(FEATURES * BUCKETS, np.int32)
        self.waiting: list[np.ndarray] = []

    def _flush(self) -> None:
        if self.waiting:
            self.raw += np.bincount(np.concatenate(self.waiting), minlength=len(self.raw)).astype(np.int32)
            self.waiting = []

    def __call__(self, rows: dict) -> None:
        held = 0
        for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
            if not text:
                continue
            found = self.hashed.features(text)
            self.waiting.append(found)
            held += len(found)
            if doc_id in self.good:
                np.add.at(self.target, found, 1)
            if held >= FLUSH:
                self._flush()
                held = 0
        self._flush()

    def blocks(self) -> dict:
        raw, target = self.raw.reshape(-1, BLOCK), self.target.reshape(-1, BLOCK)
        used = np.flatnonzero(raw.any(axis=1)).tolist()
        return {
            "block": used,
            "raw": [raw[b].astype(np.int64).tobytes() for b in used],
            "target": [target[b].astype(np.int64).tobytes() for b in used],
        }


class Summer:
    """Adds up the blocks of one partition: as many as the model has, at most."""

    def __init__(self) -> None:
        self.sums: dict[int, np.ndarray] = {}

    def __call__(self, rows: dict) -> None:
        for block, raw, target in zip(rows["block"], rows["raw"], rows["target"], strict=True):
            both = np.stack([np.frombuffer(raw, np.int64), np.frombuffer(target, np.int64)])
            self.sums[block] = self.sums[block] + both if block in self.sums else both

    def blocks(self) -> dict:
        used = sorted(self.sums)
        return {
            "block": used,
            "raw": [self.sums[b][0].tobytes() for b in used],
            "target": [self.sums[b][1].tobytes() for b in used],
        }


COUNTS = "block long, raw binary, target binary"


def log_ratios(raw: DataFrame, good: frozenset[int]) -> np.ndarray:
    """log(target / raw) per bucket; a table of fixed size."""
    parts = map_columns(raw, COUNTS, lambda: Counter(good), "blocks")
    sums = map_columns(parts.repartition(32, "block"), COUNTS, Summer, "blocks")
    raw_counts = np.zeros(FEATURES * BUCKETS, np.float64)
    target = np.zeros(FEATURES * BUCKETS, np.float64)
    for row in sums.toLocalIterator():
        at = slice(row.block * BLOCK, (row.block + 1) * BLOCK)
        raw_counts[at] = np.frombuffer(row.raw, np.int64)
        target[at] = np.frombuffer(row.target, np.int64)
    out = np.zeros(FEATURES * BUCKETS, np.float32)
    for k in range(FEATURES):
        at = slice(k * BUCKETS, (k + 1) * BUCKETS)
        expected = raw_counts[at] * (target[at].sum() / max(raw_counts[at].sum(), 1))
        ratio = np.log((target[at] + PRIOR) / (expected + PRIOR))
        out[at] = np.where(np.abs(target[at] - expected) > Z * np.sqrt(expected + 1), ratio, 0)
    return out


class Scorer:
    def __init__(self, table: np.ndarray) -> None:
        self.table, self.hashed = table, Hashed()

    def __call__(self, doc_id: int | str | None, text: str | None) -> tuple[float, float]:
        """Importance and noisy key; minus infinity for a text without words."""
        if not text or not text.strip():
            return -np.inf, -np.inf
        found = self.hashed.features(text)
        score = float(self.table[found].sum(dtype=np.float64) / np.sqrt((len(found) + 1) // FEATURES))
        u = (xxhash.xxh64_intdigest(f"{SEED}:{doc_id}") + 0.5) / 2.0**64
        return score, score / TEMPERATURE - float(np.log(-np.log(u)))


def sortable(keys: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the given doubles."""
    bits = (keys + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def kth_largest(scored: DataFrame, k: int) -> int:
    """The k-th largest ``bits``, found by 16 bits at a time on histograms."""
    low = -(1 << 63)
    for shift in (48, 32, 16, 0):
        place = F.shiftright("bits", shift)
        width = 1 << min(shift + 16, 63)
        span = scored if shift == 48 else scored.filter(F.col("bits").between(low, low + width - 1))
        counts = sorted(span.groupBy(place.alias("place")).count().collect(), reverse=True)
        for row in counts:
            if k <= row["count"]:
                low = row.place << shift
                break
            k -= row["count"]
    return low


def best_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """Importance that parts good from other labelled documents with least mean error."""
    if good.all() or not good.any():  # nothing to part, or no labels at all
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum()
    caught = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    gain = caught - lost
    gain[1:-1][s[1:] == s[:-1]] = -1  # a cut lies between different scores
    at = int(np.argmax(gain))
    if at == 0:
        return -np.inf
    return float((s[at - 1] + s[at]) / 2) if at < len(s) else np.inf


class Classifier:
    """Fitted model and cut; ``keep`` filters a table, ``scored`` holds every document."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.id_col, self.text_col = id_col, text_col
        raw = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), column(docs, text_col, "string").alias("text")
        )
        chosen = (
            labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
            .groupBy("doc_id")
            .agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(FIT_ROWS)
            .collect()
        )
        # Each class gives its own share, so that neither is missing by chance.
        classes = {good: [r.doc_id for r in chosen if bool(r.good) is good] for good in (True, False)}
        held = {i: good for good, ids in classes.items() for i in ids[::CALIBRATION_SHARE]}
        fit = frozenset(classes[True]) - held.keys()
        self.table = log_ratios(raw, fit) if fit else np.zeros(FEATURES * BUCKETS, np.float32)
        self.scored = stored(self._scores(raw))
        self.cut = self._calibrated(held) if fit else -np.inf
        chosen_count = self.scored.filter(F.col("score") >= F.lit(float(self.cut))).filter("n_words > 0").count()
        self.least = kth_largest(self.scored, chosen_count) if chosen_count else (1 << 63) - 1

    def _scores(self, raw: DataFrame) -> DataFrame:
        table = self.table

        def make():
            score = Scorer(table)

            def work(rows):
                both = [score(i, t) for i, t in zip(rows["doc_id"], rows["text"], strict=True)]
                keys = np.array([k for _, k in both])
                return {
                    "doc_id": rows["doc_id"],
                    "n_words": [len(t.split()) if t else 0 for t in rows["text"]],
                    "score": [s for s, _ in both],
                    "bits": sortable(keys).tolist(),
                }

            return work

        return map_columns(raw, "doc_id long, n_words long, score double, bits long", make)

    def _calibrated(self, held: dict[int, bool]) -> float:
        ids = self.scored.sparkSession.createDataFrame(
            [(i, g) for i, g in sorted(held.items())], "doc_id long, good boolean"
        )
        rows = (
            self.scored.join(ids, "doc_id")
            .filter("n_words > 0")
            .groupBy("doc_id", "good")
            .agg(F.min("score").alias("score"))
            .orderBy("doc_id")
            .collect()
        )
        return best_cut(np.array([r.score for r in rows]), np.array([r.good for r in rows], bool))

    def verdicts(self) -> DataFrame:
        """doc_id, n_words, score, kept: one row per document."""
        kept = (F.col("bits") >= F.lit(self.least)) & (F.col("n_words") > 0)
        return self.scored.select("doc_id", "n_words", "score", kept.alias("kept"))

    def keep(self, docs: DataFrame) -> DataFrame:
        """The documents that stay, all columns; scores are made anew, nothing is joined."""
        table, least = self.table, self.least

        def kept(batches):
            score = Scorer(table)
            for ids, texts in batches:
                keys = [score(i, t)[1] for rows in slices(ids, texts) for i, t in zip(*rows, strict=True)]
                yield pa.array(sortable(np.array(keys, np.float64)) >= least)

        test = F.arrow_udf(kept, "boolean", F.ArrowUDFType.SCALAR_ITER)
        text = F.col(self.text_col)
        ids = F.col(self.id_col).cast("long").cast("string")  # as text: nulls would turn numbers into doubles
        return docs.filter(test(ids, text) & text.rlike(r"\S"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return Classifier(docs, labels, id_col, text_col).verdicts()


__all__ = ["Classifier", "best_cut", "classify", "kth_largest", "log_ratios", "sortable"]
