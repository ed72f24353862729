"""Embedding near-duplicates by randomised-rotation binary codes (operator 6).

Vectors are compared only within a label.  Per vector the index stores one sign
bit per rotated dimension and two correction factors (the residual's length and
its inner product with the code).  For a query the factors turn the code into an
unbiased estimate of the inner product with a confidence bound; pairs whose
upper bound stays below the threshold are discarded, every other pair is
recomputed exactly in double precision.  So no pair below the threshold links.

* Equal vectors form one class first (weight = number of copies).
* Candidate cells: about sqrt(n) centroids, fitted on at most ``SAMPLE`` vectors
  (smallest hashes of the id).  A vector's home is its best centroid; it is also
  listed in every cell whose cosine is within ``MARGIN`` of the home's.  Every
  vector is indexed.  A pair is found in the home cell of either side.
* A cell's home rows and listed rows are cut into blocks by hash, and each pair
  of blocks is one small product in one task, so a hot cell is spread.  A task
  emits counts per vector and a spanning forest, never the pairs.

Recall against brute force is measured in the tests and given in the README.

Defined results: rows with a null label or a vector that is null, empty, zero or
holds null or non-finite components link with nothing and keep their own id as
component.  Vectors of different lengths link with nothing.  A null id is never
linked and comes back with a null component and ``kept`` false.  Repeated rows
come back repeatedly and count as links of each other.  Only the three columns
named are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import components, materialize, runs

THRESHOLD = 0.93
SAMPLE = 20_000          # vectors that the centroids are fitted on, at most
MAX_CELLS = 4096
ROUNDS = 6               # of spherical k-means
MARGIN = 0.1             # in cosine: listed in cells this close to the home cell
BLOCK = 1024             # rows of a block
SIGMAS = 4.0             # width of the confidence bound
SEED = 20240


def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit_rows(vectors: list) -> np.ndarray:
    """Vectors over their norms, in double precision.  They are scaled by a power of two first, which is exact, so
    neither huge nor tiny components over- or underflow in the squares."""
    x = np.stack(vectors).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centroids by spherical k-means on unit vectors."""
    rng = np.random.default_rng(SEED)
    at = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        best = (sample @ at.T).argmax(axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, best, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        at = np.where(size > 0, sums / np.maximum(size, 1e-30), at)
    return at


def encode(units: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """Rotated residual directions, sign bits, residual lengths and code factors of unit vectors."""
    rest = units - centre
    r = np.linalg.norm(rest, axis=1)
    o = (rest / np.maximum(r, 1e-30)[:, None]) @ turn.T
    factor = np.abs(o).sum(axis=1) / math.sqrt(units.shape[1])
    return o, o >= 0, r, factor


def estimate(o_q, r_q, bits, r, factor, dots_q, dots, centre_sq):
    """Unbiased cosine estimates (queries x coded vectors) and the half width of their confidence bounds."""
    dim = o_q.shape[1]
    signs = (bits.astype(np.float32) * 2 - 1) / math.sqrt(dim)
    raw = (o_q.astype(np.float32) @ signs.T) / np.maximum(factor, 1e-6)[None, :]
    scale = r_q[:, None] * r[None, :]
    cos = scale * raw + dots_q[:, None] + dots[None, :] - centre_sq
    spread = np.sqrt(np.maximum(1 - factor ** 2, 0)) / np.maximum(factor, 1e-6) / math.sqrt(max(dim - 1, 1))
    return cos, SIGMAS * scale * spread[None, :] + 1e-5


def _indexed(raw: DataFrame) -> str:
    kind = {f.name: f.dataType.simpleString() for f in raw.schema.fields}
    return (f"id long, label {kind['label']}, weight long, home int, cells array<int>, vec {kind['vec']}, "
            "code binary, r double, factor double")


def _index(models):
    def run(frames):
        for frame in frames:
            dims = frame["vec"].map(len)
            for dim, part in frame.groupby(dims):
                u = unit_rows(part["vec"].to_list())
                at, centre = models.value.get(dim, (np.eye(1, dim), np.zeros(dim)))
                cos = u @ at.T
                _, bits, r, factor = encode(u, centre, rotation(dim))
                yield pd.DataFrame({
                    "id": part["id"].to_numpy(), "label": part["label"].to_numpy(), "weight": part["weight"].to_numpy(),
                    "home": cos.argmax(axis=1).astype(np.int32),
                    "cells": [np.flatnonzero(c >= c.max() - MARGIN).astype(np.int32) for c in cos],
                    "vec": part["vec"].to_numpy(), "code": [b.tobytes() for b in np.packbits(bits, axis=1)],
                    "r": r, "factor": factor})
    return run


def _compare(q: pd.DataFrame, m: pd.DataFrame, centre: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix: which (query, member) pairs link."""
    dim = len(q["vec"].iloc[0])
    x, y = unit_rows(q["vec"].to_list()), unit_rows(m["vec"].to_list())
    o, _, r_q, _ = encode(x, centre, rotation(dim))
    bits = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in m["code"]]), axis=1, count=dim)
    cos, width = estimate(o, r_q, bits, m["r"].to_numpy(), m["factor"].to_numpy(), x @ centre, y @ centre,
                          float(centre @ centre))
    open_ = cos + width >= threshold
    open_ &= q["id"].to_numpy()[:, None] != m["id"].to_numpy()[None, :]
    i, j = np.nonzero(open_)
    linked = np.zeros(open_.shape, bool)
    for lo in range(0, len(i), 1 << 16):
        a, b = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
        linked[a, b] = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
    return linked


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a bipartite link matrix."""
    out, todo_l, todo_r = [], linked.any(axis=1), linked.any(axis=0)
    for root in np.flatnonzero(todo_l):
        if not todo_l[root]:
            continue
        front = np.array([root])
        todo_l[root] = False
        while len(front):
            reach = np.flatnonzero(linked[front].any(axis=0) & todo_r)
            todo_r[reach] = False
            out += [(int(left[root]), int(right[k])) for k in reach]
            front = np.flatnonzero(linked[:, reach].any(axis=1) & todo_l)
            todo_l[front] = False
            out += [(int(left[root]), int(left[k])) for k in front]
    return out


def _products(models, threshold):
    def run(frames):
        for block in runs(frames, ["label", "dim", "cell", "bi", "bj"]):
            query = block["query"].to_numpy(bool)
            q, m = block[query], block[~query]
            if not len(q) or not len(m):
                continue
            _, centre = models.value.get(len(q["vec"].iloc[0]), (None, np.zeros(len(q["vec"].iloc[0]))))
            linked = _compare(q, m, centre, threshold)
            if not linked.any():
                continue
            wq, wm = q["weight"].to_numpy(), m["weight"].to_numpy()
            counts = dict(zip(q["id"], linked @ wm))
            # a member whose home cell does not list the query finds no link there: it is credited here
            homes = m["home"].to_numpy()
            for k, cells in enumerate(q["cells"]):
                for j in np.flatnonzero(linked[k] & ~np.isin(homes, cells)):
                    who = m["id"].iloc[j]
                    counts[who] = counts.get(who, 0) + int(wq[k])
            edges = _forest(linked, q["id"].to_numpy(), m["id"].to_numpy())
            rows = [(k, int(v), None, None) for k, v in counts.items() if v] + [(None, 0, a, b) for a, b in edges]
            out = pd.DataFrame(rows, columns=["id", "links", "a", "b"])
            yield out.astype({"id": "Int64", "a": "Int64", "b": "Int64", "links": "int64"})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: ``id_col``, n_links, component_id, kept."""
    spark = vectors.sparkSession
    single = vectors.schema[vec_col].dataType.simpleString() == "array<float>"
    raw = vectors.select(vectors[id_col].cast("long").alias("id"),
                         vectors[vec_col].cast("array<float>" if single else "array<double>").alias("vec"),
                         vectors[label_col].alias("label"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fit_for = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
               & F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda v: v != 0))
    keyed = raw.withColumn("fits", F.coalesce(fit_for, F.lit(False))) \
        .withColumn("k1", F.xxhash64("label", "vec")).withColumn("k2", F.xxhash64(F.lit(SEED), "vec"))
    classes = materialize(keyed.where("fits").groupBy("label", "k1", "k2")
                          .agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.first("vec").alias("vec")),
                          "embedding-classes")
    n = classes.count()
    cells = max(1, min(MAX_CELLS, math.isqrt(n)))
    # vectors with the smallest hashes; the bound on the hash keeps all but about twice the sample out of the sort
    bound = -(1 << 63) + min((1 << 64) - 1, (1 << 64) * 2 * SAMPLE // max(1, n))
    sample = (classes.where(F.xxhash64("id") <= F.lit(bound)).select("id", "vec").orderBy(F.xxhash64("id"), "id")
              .limit(SAMPLE).toPandas()["vec"])
    fitted = {}
    for dim, part in sample.groupby(sample.map(len)):
        x = unit_rows(part.to_list())
        fitted[int(dim)] = (fit_cells(x, cells), x.mean(axis=0))
    models = spark.sparkContext.broadcast(fitted)     # MAX_CELLS centroids per length at most
    index = materialize(classes.select("id", "label", "weight", "vec").mapInPandas(_index(models), _indexed(raw))
                        .withColumn("dim", F.size("vec")), "embedding-index")

    listed = index.withColumn("cell", F.explode("cells"))
    load = (listed.groupBy("label", "dim", "cell")
            .agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("member_blocks"),
                 F.ceil(F.sum((F.col("home") == F.col("cell")).cast("long")) / F.lit(BLOCK)).cast("int").alias("query_blocks"))
            .where("query_blocks > 0"))
    block = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    at = ["label", "dim", "cell"]
    columns = ["id", "weight", "home", "cells", "vec", "code", "r", "factor", *at]
    members = (listed.join(load, at).select(*columns, F.lit(False).alias("query"), every(F.col("query_blocks")).alias("bi"),
                                            block(F.col("member_blocks")).alias("bj")))
    homes = index.withColumn("cell", F.col("home"))
    queries = (homes.join(load, at).select(*columns, F.lit(True).alias("query"), block(F.col("query_blocks")).alias("bi"),
                                           every(F.col("member_blocks")).alias("bj")))
    keys = [*at, "bi", "bj"]
    found = materialize(members.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys)
                        .mapInPandas(_products(models, threshold), "id long, links long, a long, b long"),
                        "embedding-links")
    links = found.where("id is not null").groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.where("a is not null").select("a", "b"), "embedding-components") \
        .withColumnRenamed("id", "c_id")
    named = (classes.select("label", "k1", "k2", "id", "weight").join(links, "id", "left")
             .join(joined, F.col("id") == F.col("c_id"), "left")
             .select("label", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"),
                     F.coalesce("component", "id").alias("c"), F.lit(True).alias("fits")))
    return (keyed.select("id", "label", "k1", "k2", "fits").join(named, ["label", "k1", "k2", "fits"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("c", "id").alias("component_id"),
                    F.coalesce(F.coalesce("c", "id") == F.col("id"), F.lit(False)).alias("kept")))
