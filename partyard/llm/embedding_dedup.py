"""Near-equal embeddings by randomly rotated binary codes with correction factors.

A unit vector is padded, turned by a fixed random rotation and stored as its signs
plus one factor: the inner product of the vector with its own code.  Code times
another turned vector, divided by the factor, estimates the inner product without
bias; its error has a known spread, so a bound tells which pairs cannot reach the
wanted cosine.  Only the others are computed again, in double precision.

Candidates agree in a band of the code.  At a cosine of 0.98 a pair shares none of the
``BANDS`` bands of ``BAND_BITS`` signs with probability 1e-8, and the bound errs with
about 1e-9 (``SIGMAS``).  Equal vectors of one label are one node with a count; they
never form pairs.  A bucket of more than ``CHUNK`` nodes is cut into chunks and each
pair of chunks is a task's work of its own.  A pair counts in its first common band.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows
without a label link with nothing.  Vectors of different length are never compared.
Repeated rows are vectors of their own; ids may be null.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyard.llm.common import map_columns, map_runs
from partyard.llm.components import components
from partyard.session import stored

COSINE = 0.98
BAND_BITS, BANDS = 14, 36
CODE_BITS = 512
SIGMAS = 6.0
CHUNK = 512
SEED = 23


def rotation(dim: int) -> np.ndarray:
    """First ``dim`` columns of a random rotation of the code's space."""
    size = code_size(dim)
    q, r = np.linalg.qr(np.random.RandomState(SEED).standard_normal((size, size)))
    return (q * np.sign(np.diag(r)))[:, :dim]


def code_size(dim: int) -> int:
    return max(CODE_BITS, -(-dim // 64) * 64)


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length 1, in doubles; None if it has no direction."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def error_bound(factor: np.ndarray, size: int) -> np.ndarray:
    """Half-width of the confidence interval of an estimate made with a code."""
    return np.sqrt(np.maximum(1 - factor**2, 0)) / factor * SIGMAS / np.sqrt(size - 1)


def _keyed(rows: DataFrame) -> DataFrame:
    """vec_id, label, key: equal keys mean equal label and equal values."""

    def make():
        def work(cols):
            keys = []
            for label, values in zip(cols["label"], cols["embedding"], strict=True):
                if label is None or unit(values) is None:
                    keys.append(None)
                else:
                    x = np.array(values, np.float64) + 0.0
                    keys.append(hashlib.md5(f"{label}:".encode() + x.tobytes()).digest())
            return {"vec_id": cols["vec_id"], "key": keys, "label": cols["label"], "embedding": cols["embedding"]}

        return work

    return map_columns(rows, "vec_id long, key binary, label string, embedding array<double>", make)


def _coded(nodes: DataFrame) -> DataFrame:
    """Unit vector, code, factor and buckets of every node."""

    def make():
        turns: dict[int, np.ndarray] = {}

        def work(cols):
            out = {"node": cols["node"], "copies": cols["copies"], "first_id": cols["first_id"], "key": cols["key"]}
            out |= {"unit": [], "code": [], "factor": [], "buckets": []}
            for label, values in zip(cols["label"], cols["embedding"], strict=True):
                x = unit(values)
                if len(x) not in turns:
                    turns[len(x)] = rotation(len(x))
                z = turns[len(x)] @ x
                signs = z >= 0
                out["unit"].append(x.tobytes())
                out["code"].append(np.packbits(signs).tobytes())
                out["factor"].append(float(np.abs(z).sum() / np.sqrt(len(z))))
                bits = signs[: BAND_BITS * BANDS].reshape(BANDS, BAND_BITS)
                out["buckets"].append(
                    [f"{label}:{len(x)}:{k}:{b}" for k, b in enumerate((bits @ (1 << np.arange(BAND_BITS))).tolist())]
                )
            return out

        return work

    return map_columns(
        nodes,
        "node long, copies long, first_id long, key binary, unit binary, code binary, factor double,"
        " buckets array<string>",
        make,
    ).withColumn("buckets", F.transform("buckets", lambda b: F.xxhash64(b)))


def _links(coded: DataFrame) -> DataFrame:
    """Linked pairs of nodes, each once."""
    entries = coded.select("node", F.posexplode("buckets").alias("band", "bucket"))
    shared = entries.groupBy("band", "bucket").agg(F.count("*").alias("size")).filter("size > 1")
    chunks = F.ceil(F.col("size") / CHUNK).cast("long")
    own = F.pmod(F.xxhash64("node"), chunks)
    blocks = (
        entries.join(shared, ["band", "bucket"])
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select(
            "band",
            "bucket",
            "node",
            "own",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
        )
        .join(coded.select("node", "unit", "code", "factor"), "node")
    )

    def make():
        turns: dict[int, np.ndarray] = {}

        def work(run):
            n = len(run["node"])
            if n < 2:
                return None
            band, low, high = run["band"][0], run["low"][0], run["high"][0]
            units = np.frombuffer(b"".join(run["unit"]), np.float64).reshape(n, -1)
            dim = units.shape[1]
            if dim not in turns:
                turns[dim] = rotation(dim)
            packed = np.frombuffer(b"".join(run["code"]), np.uint8).reshape(n, -1)
            bits = np.unpackbits(packed, axis=1)
            factor, own, node = np.array(run["factor"]), np.array(run["own"]), np.array(run["node"])
            # Estimate of <x_i, x_j> by the code of i and the turned vector of j.
            signs = bits.astype(np.float32) * 2 - 1
            turned = (units @ turns[dim].T).astype(np.float32)
            estimate = (signs @ turned.T) / (np.sqrt(bits.shape[1]) * factor[:, None])
            near = estimate + error_bound(factor, bits.shape[1])[:, None] >= COSINE
            near &= node[:, None] < node[None, :]
            if low != high:  # pairs inside a chunk belong to the chunk's own block
                near &= own[:, None] != own[None, :]
            i, j = np.nonzero(near)
            exact = np.einsum("kd,kd->k", units[i], units[j]) >= COSINE
            i, j = i[exact], j[exact]
            words = bits[:, : BAND_BITS * BANDS].reshape(n, BANDS, BAND_BITS)[:, :band]
            first = np.ones(len(i), bool)
            for k in range(0, len(i), 4096):
                at = slice(k, k + 4096)
                first[at] = ~(words[i[at]] == words[j[at]]).all(axis=2).any(axis=1)
            return {"a": node[i[first]].tolist(), "b": node[j[first]].tolist()}

        return work

    return map_runs(blocks, ["band", "bucket", "low", "high"], ["node"], "a long, b long", make)


def embedding_links(rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``rows``."""
    raw = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    keyed = _keyed(raw)
    groups = (
        keyed.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("vec_id").alias("first_id"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    coded = stored(_coded(stored(groups)))
    links = stored(_links(coded))
    sizes = coded.select(F.col("node").alias("b"), "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(sizes, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("linked"))
    named = (
        coded.select("node", "key", "copies", "first_id")
        .join(components(links), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(counts, "node", "left")
    )
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = named.join(ids, "component").select(
        "key", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = keyed.select("vec_id", "key").join(found, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
