"""Near duplicates by ProbMinHash signatures, banding and exact verification.

A text is the weighted set of its word shingles (five lower-case blank-separated
words; a shorter text is one shingle); a shingle said c times weighs 1 + ln(c).
ProbMinHash gives it a signature: every shingle is a Poisson process whose rate is its
weight, each arrival falls on a random register, and a register keeps the shingle that
arrived first.  A shingle is dropped as soon as its next arrival is later than all
registers' first ones.  Two registers agree with the probability Jaccard similarity.
A second signature gives all shingles the weight 1; its registers agree with the
Jaccard similarity of the distinct shingles.  Both are the same for a text that repeats
no shingle, which then has one.

Two texts are linked where either similarity is at least 0.8: copies whose passages are
repeated differently agree as sets, copies that share most of what they say, weighed
by how often they say it, agree as weighted sets.

Equal texts are one node.  Nodes that agree in a band of either signature share a
bucket; each is compared with the bucket's first node, so this work grows with the
members and not with their pairs.  What it leaves is done exactly: in buckets that
still hold more than one component, members of different components are compared where
they lie, in chunks of bounded size, and only links come out.  Candidates whose
signatures tell that they are too far apart in both ways are dropped, all others are
verified by both similarities, computed from the shingles and their counts.  Classes
are the connected components.

A pair of similarity 0.8 shares no band with probability 7e-6 and falls short of the
signatures' floor with probability 6e-9.  Null texts and texts
without words belong to no other document and are kept.  The class id is the smallest
document id in the class; ids may be null or repeated, texts decide.  Other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partyard.llm.common import column, map_columns, map_runs
from partyard.llm.components import components
from partyard.session import stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 5
REGISTERS = BANDS * ROWS
#: Standard errors by which a signature may fall short before a pair is dropped unseen.
CONFIDENCE = 5.5

#: Nodes of a bucket that are compared as one block.
CHUNK = 256

#: What separates words: a text of nothing else has none (fixed values).
BLANK = r"\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash per word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def shingles(self, text: str) -> np.ndarray:
        """Hash of every shingle, in text order; none for a text without words."""
        found = text.lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.__getitem__, found), np.uint64, len(found))
        width = min(SHINGLE, len(h))
        out = np.full(len(h) - width + 1, np.uint64(width))
        for k in range(width):
            out = mix64(out * _GOLDEN + h[k : len(h) - width + 1 + k])
        return out


def signature(hashes: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """For each register the element whose Poisson process reaches it first.

    Arrivals of all live elements are made in blocks, a block holding several arrivals
    of each when few are live; elements beyond the last register's time are finished.
    """
    first = np.full(registers, np.inf)
    winner = np.zeros(registers, np.uint64)
    live, now, count = np.arange(len(hashes)), np.zeros(len(hashes)), np.zeros(len(hashes), np.uint64)
    while len(live):
        block = max(1, 512 // len(live))
        turn = count[:, None] + np.arange(1, block + 1, dtype=np.uint64)
        x = mix64(hashes[live][:, None] + turn * _GOLDEN)
        u = ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        at = now[:, None] + np.cumsum(-np.log(u) / weights[live][:, None], axis=1)
        register = (mix64(x ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(registers)).astype(np.int64)
        times, places = at.ravel(), register.ravel()
        who = np.repeat(hashes[live], block)
        better = np.flatnonzero(times < first[places])
        better = better[np.argsort(-times[better], kind="stable")]  # the earliest is written last
        first[places[better]], winner[places[better]] = times[better], who[better]
        now, count = at[:, -1], count + np.uint64(block)
        going = now < first.max()
        live, now, count = live[going], now[going], count[going]
    return winner


def weights(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def bands(winner: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band; bands never share a bucket."""
    rows = winner.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN
    for k in range(ROWS):
        out = mix64(out + rows[:, k])
    return out.view(np.int64)


def _signed(raw: DataFrame) -> DataFrame:
    def make():
        words = WordHashes()

        def work(rows):
            out = {"doc_id": rows["doc_id"], "key": rows["key"], "n": [], "bands": [], "sketch": []}
            for text in rows["text"]:
                found, counts = np.unique(words.shingles(text or ""), return_counts=True)
                winners = [signature(found, np.ones(len(found)))] if len(found) else []
                if len(found) and counts.max() > 1:
                    winners.append(signature(found, weights(counts)))
                out["bands"].append([b for w in winners for b in bands(w).tolist()])
                out["sketch"].append(b"".join(w.astype(np.uint8).tobytes() for w in winners))
                out["n"].append(len(found))
            return out

        return work

    return map_columns(raw, "doc_id long, key binary, n long, bands array<long>, sketch binary", make)


def _sets(texts: DataFrame) -> DataFrame:
    """Sorted distinct shingles of each text, 32 bits each, and which come how often."""

    def make():
        words = WordHashes()

        def work(rows):
            out = {"node": rows["node"], "shingles": [], "repeats": []}
            for t in rows["text"]:
                short = (words.shingles(t or "") >> np.uint64(32)).astype(np.uint32)
                found, counts = np.unique(short, return_counts=True)
                often = np.flatnonzero(counts > 1)
                out["shingles"].append(found.tobytes())
                out["repeats"].append(np.concatenate([often, counts[often]]).astype(np.uint32).tobytes())
            return out

        return work

    return map_columns(texts, "node long, shingles binary, repeats binary", make)


def _floor() -> int:
    """Equal sketch bytes below which a pair is too far apart."""
    spread = (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5
    return int(REGISTERS * (SIMILARITY - CONFIDENCE * spread - 0.02))


def probability_jaccard(x: np.ndarray, y: np.ndarray, x_weight: np.ndarray, y_weight: np.ndarray) -> float:
    """Probability Jaccard similarity of two sorted weighted sets.

    It is the sum, over common elements d, of 1 / sum over e of max(x_e / x_d, y_e / y_d).
    The first quotient is the larger one where x_e / y_e is above x_d / y_d, so one sort
    by that ratio and running sums give all inner sums.
    """
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    order = np.argsort(x_weight[i] / y_weight[j], kind="stable")
    a, b = x_weight[i][order], y_weight[j][order]
    above = x_weight.sum() - np.cumsum(a)
    below = y_weight.sum() - b.sum() + np.cumsum(b)
    return float((1 / (above / a + below / b)).sum())


class Shingles:
    """The weighted set of one text."""

    __slots__ = ("found", "repeats")

    def __init__(self, found: bytes, repeats: bytes) -> None:
        self.found, self.repeats = np.frombuffer(found, np.uint32), repeats

    def weight(self) -> np.ndarray:
        out = np.ones(len(self.found))
        places, counts = np.frombuffer(self.repeats, np.uint32).reshape(2, -1)
        out[places] = weights(counts)
        return out

    def similar(self, other: Shingles) -> bool:
        """Either similarity is at least 4/5."""
        x, y = self.found, other.found
        both = len(x) + len(y) - len(np.union1d(x, y))
        if 5 * both >= 4 * (len(x) + len(y) - both):
            return True
        if not (self.repeats or other.repeats):
            return False
        return probability_jaccard(x, y, self.weight(), other.weight()) >= SIMILARITY - 1e-12


def _sketches(sketch: list[bytes]) -> np.ndarray:
    """Sketches of distinct and of weighted shingles, by text."""
    both = (x if len(x) > REGISTERS else x + x for x in sketch)
    return np.frombuffer(b"".join(both), np.uint8).reshape(-1, 2, REGISTERS)


def _likely(pairs: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches allow either similarity."""
    floor = _floor()

    def make():
        def work(rows):
            equal = (_sketches(rows["sketch_a"]) == _sketches(rows["sketch_b"])).sum(axis=2) >= floor
            keep = np.flatnonzero((equal[:, 0] & np.array(rows["sized"])) | (equal[:, 1] & np.array(rows["weighed"])))
            return {"a": [rows["a"][k] for k in keep], "b": [rows["b"][k] for k in keep]}

        return work

    sized = F.least("n_a", "n_b").cast("double") >= F.lit(SIMILARITY - 1e-9) * F.greatest("n_a", "n_b")
    weighed = F.greatest(F.octet_length("sketch_a"), F.octet_length("sketch_b")) > REGISTERS
    asked = pairs.select("a", "b", "sketch_a", "sketch_b", sized.alias("sized"), weighed.alias("weighed"))
    return map_columns(asked.filter("sized OR weighed"), "a long, b long", make)


def _verified(pairs: DataFrame) -> DataFrame:
    def make():
        def work(rows):
            left = map(Shingles, rows["set_a"], rows["repeats_a"])
            right = map(Shingles, rows["set_b"], rows["repeats_b"])
            sides = zip(rows["a"], rows["b"], left, right, strict=True)
            kept = [(a, b) for a, b, x, y in sides if x.similar(y)]
            return {"a": [a for a, _ in kept], "b": [b for _, b in kept]}

        return work

    return map_columns(pairs, "a long, b long", make)


def _crossing_links(run: dict) -> dict | None:
    """Links between components within one pair of chunks of a bucket.

    A pair that meets in several bands counts in the first of them.
    """
    n = len(run["node"])
    component = np.array(run["component"])
    if (component == component[0]).all():
        return None
    node, own = np.array(run["node"]), np.array(run["own"])
    bucket = np.array([x if len(x) > BANDS else x + x for x in run["bands"]], np.int64).reshape(n, 2, BANDS)
    band = int(np.argmax((bucket[0] == run["bucket"][0]).any(axis=0)))
    earlier = bucket[:, :, :band]
    sketch = _sketches(run["sketch"])
    repeating = np.array([len(x) > REGISTERS for x in run["sketch"]])
    sets = [Shingles(x, y) for x, y in zip(run["shingles"], run["repeats"], strict=True)]
    size = np.array([len(x.found) for x in sets])
    within, floor = run["low"][0] == run["high"][0], _floor()
    out = {"a": [], "b": []}
    for i in range(n - 1):
        later = slice(i + 1, n)
        near = (component[later] != component[i]) & (within | (own[later] != own[i]))
        at = np.flatnonzero(near) + i + 1
        sized = at[5 * np.minimum(size[at], size[i]) >= 4 * np.maximum(size[at], size[i])]
        sized = sized[(sketch[sized, 0] == sketch[i, 0]).sum(axis=1) >= floor]
        weighed = at if repeating[i] else at[repeating[at]]
        weighed = weighed[(sketch[weighed, 1] == sketch[i, 1]).sum(axis=1) >= floor]
        at = np.union1d(sized, weighed)
        if not len(at):
            continue
        met = (earlier[at, :, None, :] == earlier[i][None, None]).any(axis=(1, 2, 3))
        for j in at[~met]:
            if sets[i].similar(sets[j]):
                out["a"].append(int(node[i]))
                out["b"].append(int(node[j]))
    return out


class Dedup:
    """The steps of one run; every table that several steps read is stored once."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        text = column(docs, text_col, "string")
        self.raw = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("key")
        )
        self.signed = stored(_signed(self.raw))
        self.nodes = stored(
            self.signed.filter("n > 0")
            .dropDuplicates(["key"])
            .select(F.monotonically_increasing_id().alias("node"), "key", "n", "bands", "sketch")
        )
        self.entries = stored(self._entries())
        self.sets = stored(self._candidate_sets())

    def _entries(self) -> DataFrame:
        """Members of every bucket that has more than one."""
        rows = self.nodes.select("node", F.explode(F.array_distinct("bands")).alias("bucket"))
        shared = (
            rows.groupBy("bucket")
            .agg(F.min("node").alias("first"), F.max("node").alias("last"))
            .filter("first < last")
        )
        return rows.join(shared.drop("last"), "bucket")

    def _candidate_sets(self) -> DataFrame:
        """Shingle sets of the nodes that share a bucket, from one copy of their texts."""
        wanted = self.entries.select("node").distinct().join(self.nodes.select("node", "key"), "node")
        source = self.signed.groupBy("key").agg(F.min("doc_id").alias("source_id"))
        chosen = wanted.join(source, "key").select("node", "key", "source_id")
        same = (self.raw["key"] == chosen["key"]) & self.raw["doc_id"].eqNullSafe(chosen["source_id"])
        texts = self.raw.join(chosen, same).select("node", "text")
        return _sets(texts).dropDuplicates(["node"])

    def _links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a < b) that are similar enough."""
        known = self.nodes.select("node", "n", "sketch")
        a = known.select(*(F.col(c).alias(x) for c, x in (("node", "a"), ("n", "n_a"), ("sketch", "sketch_a"))))
        b = known.select(*(F.col(c).alias(x) for c, x in (("node", "b"), ("n", "n_b"), ("sketch", "sketch_b"))))
        likely = stored(_likely(pairs.join(a, "a").join(b, "b")))
        left, right = (
            self.sets.select(
                F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"), F.col("repeats").alias(f"repeats_{x}")
            )
            for x in "ab"
        )
        return stored(_verified(likely.join(left, "a").join(right, "b")))

    def _split_buckets(self, links: DataFrame) -> DataFrame:
        """Entries, with their component, of the buckets that hold more than one."""
        found = components(links)
        named = (
            self.entries.join(found, "node", "left")
            .withColumn("component", F.coalesce("component", "node"))
            .select("bucket", "node", "component")
        )
        mixed = (
            named.groupBy("bucket")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .filter("low < high")
        )
        return stored(named.join(mixed.select("bucket"), "bucket"))

    def _crossing(self, split: DataFrame) -> DataFrame:
        """Links between components inside split buckets: the exact way for what is left.

        A large bucket is cut into chunks, and each pair of chunks is a task's work of
        its own; pairs are compared where they lie and only links come out.
        """
        sizes = split.groupBy("bucket").agg(F.count("*").alias("size"))
        chunks = F.ceil(F.col("size") / CHUNK).cast("long")
        blocks = (
            split.join(sizes, "bucket")
            .withColumn("chunks", chunks)
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")))
            .join(self.nodes.select("node", "sketch", "bands"), "node")
            .join(self.sets, "node")
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
            .withColumn("low", F.least("own", "other"))
            .withColumn("high", F.greatest("own", "other"))
            .drop("other", "size", "chunks")
        )
        return stored(
            map_runs(blocks, ["bucket", "low", "high"], ["node"], "a long, b long", lambda: _crossing_links)
        )

    def links(self) -> DataFrame:
        pairs = self.entries.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
        links = self._links(pairs.distinct())
        return links.unionByName(self._crossing(self._split_buckets(links)))

    def classes(self) -> DataFrame:
        """doc_id, key, n_shingles, class_id and kept of every document.

        ``kept`` marks the row of the class's smallest id; null ids come last, then the
        smallest text digest decides.  Texts without words are kept.
        """
        found = components(self.links())
        named = self.nodes.select("node", "key").join(found, "node", "left")
        named = named.select("key", F.coalesce("component", "node").alias("component"))
        rows = self.signed.select("doc_id", "key", "n").join(named, "key", "left")
        place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
        best = rows.filter("n > 0").groupBy("component").agg(F.min(place).alias("best"))
        return rows.join(best, "component", "left").select(
            "doc_id",
            "key",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("best.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
            (
                (F.col("n") == 0)
                | (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("key") == F.col("best.key")))
            ).alias("kept"),
        )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return Dedup(docs, id_col, text_col).classes().drop("key")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every class, all columns; texts without words stay as they are.

    Of equal texts a task sends one on, so a text many rows hold is no hot key; rows
    without words meet no other row.
    """
    kept = Dedup(docs, id_col, text_col).classes().filter("kept AND n_shingles > 0")
    keys = kept.select(F.col("key").alias("__key")).distinct()
    worded = F.coalesce(F.col(text_col).rlike(f"[^{BLANK}]"), F.lit(False))
    first = Window.partitionBy("__key").orderBy(F.col(id_col).asc_nulls_last())
    chosen = (
        docs.filter(worded)
        .withColumn("__key", F.unhex(F.md5(F.col(text_col))))
        .withColumn("__turn", F.row_number().over(first))
        .filter("__turn = 1")
        .join(keys, "__key", "left_semi")
        .select(*docs.columns)
    )
    return chosen.unionByName(docs.filter(~worded))
