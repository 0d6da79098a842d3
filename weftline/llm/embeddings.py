"""Embedding near-duplicates by randomly rotated binary codes.

Equal vectors are one class. All classes of a label are compared with each
other: a label that fits into one tile whole, a larger one as pairs of tiles,
so every pair meets once. In a pair of tiles each vector is taken relative to the centroid, rotated at
random and kept as one bit per dimension with two stored factors: its length
and its inner product with its own code. The code gives an unbiased estimate
of an inner product and the second factor its confidence bound. A pair whose
upper bound stays below the threshold is done; all others are recomputed in
double precision, and only that decides. Tasks return counts of links and a
spanning forest, never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import components, cut

THRESHOLD = 0.98
#: Vectors of a label in one tile, at most in expectation.
TILE = 4096
#: Standard errors of the bound on an estimate: a link is passed over with a chance of 3e-7.
SIGMAS = 5.0
BLOCK = 512


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.Generator(np.random.Philox(key=[seed, 1 << 32])).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Binary codes of unit vectors relative to their centroid, with stored factors."""

    def __init__(self, unit: np.ndarray, seed: int):
        dim = unit.shape[1]
        self.centroid = unit.mean(axis=0)
        rest = unit - self.centroid
        self.length = np.linalg.norm(rest, axis=1)
        self.turned = (rest / np.maximum(self.length, 1e-300)[:, None]) @ rotation(dim, seed).T
        self.bits = np.packbits(self.turned > 0, axis=1)
        self.fit = np.abs(self.turned).sum(axis=1) / math.sqrt(dim)  # inner product of a vector with its code
        self.lean = rest @ self.centroid
        self.base = float(self.centroid @ self.centroid)
        self.error = np.sqrt(np.maximum(0.0, 1 - self.fit**2) / np.maximum(self.fit**2, 1e-12) / max(1, dim - 1))

    def upper(self, rows: slice, columns: slice, sigmas: float) -> np.ndarray:
        """Upper bounds of the cosines of rows with columns, from the columns' codes."""
        dim = self.turned.shape[1]
        signs = np.unpackbits(self.bits[columns], axis=1, count=dim).astype(np.float32) * 2 - 1
        inner = (self.turned[rows].astype(np.float32) @ signs.T) / math.sqrt(dim) / np.maximum(self.fit[columns], 1e-12)
        bound = np.minimum(1.0, inner + sigmas * self.error[columns] + 1e-5)
        return self.base + self.lean[rows, None] + self.lean[None, columns] + self.length[rows, None] * self.length[None, columns] * bound


def linked(vectors: np.ndarray, threshold: float, sigmas: float, seed: int, left: np.ndarray | None = None, other: np.ndarray | None = None):
    """Blocks (i, j) of positions i < j with cosine >= threshold; with left, only pairs of a left and a right one."""
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    codes = Codes(vectors / norm[:, None], seed)
    n = len(vectors)
    for lo in range(0, n, BLOCK):
        rows = slice(lo, min(n, lo + BLOCK))
        for at in range(lo, n, 4 * BLOCK):
            columns = slice(at, min(n, at + 4 * BLOCK))
            i, j = np.nonzero(codes.upper(rows, columns, sigmas) >= threshold)
            i, j = i + lo, j + at
            ok = i < j
            if left is not None:
                ok &= left[i] != left[j]
            i, j = i[ok], j[ok]
            for k in range(0, len(i), 1 << 17):
                a, b = i[k : k + (1 << 17)], j[k : k + (1 << 17)]
                good = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norm[a] * norm[b]) >= threshold
                yield a[good], b[good]


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, tile: int = TILE, sigmas: float = SIGMAS, seed: int = 42) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row.

    Rows are compared when their labels are equal and not null and their
    vectors have the same length, at every size of a label. A vector that is
    null, empty, zero or holds null or non-finite components links with
    nothing: 0 links and itself as its component. Rows are vectors of their
    own, whatever their ids: repeated rows are linked by their equal vectors,
    an id that repeats with other vectors or labels has a result for each.
    component_id is the smallest id that is not null, null where there is
    none; kept compares null ids as equal. Other columns are left out; an
    empty table gives no rows. Vectors of any length are taken whole.
    """
    x = F.col("v")
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(x, lambda e: e != 0)
    good = F.coalesce(F.col("label").isNotNull() & finite, F.lit(False))
    # Magnitudes near the ends of a double would over- or underflow when squared; a power of two takes them out exactly.
    largest = F.array_max(F.transform(x, F.abs))
    scaled = F.when((largest > 1e100) | (largest < 1e-100), F.transform(x, lambda e: e / largest)).otherwise(x)
    rows = rows.withColumn("good", good)
    lone = rows.where(~F.col("good")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    valid = rows.where("good").select("id", "label", F.transform(scaled, lambda e: F.when(e == 0, F.lit(0.0)).otherwise(e)).alias("v"))
    # A class is a vector of a label; its number, fixed by the checkpoint, stands for it from here on.
    counted = valid.groupBy("label", "v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("m"))
    classes = cut(counted.select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("c")))
    keys = ["label", "dim"]
    sizes = classes.groupBy(*keys).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / tile)).cast("int").alias("tiles"))
    spread = classes.join(sizes.withColumnsRenamed({"label": "l2", "dim": "d2"}).hint("merge"), (F.col("label") == F.col("l2")) & (F.col("dim") == F.col("d2"))).drop("l2", "d2")
    own = F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int")
    spread = spread.withColumn("own", own).withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    spread = spread.select(*keys, "c", "m", "v", "own", F.least("own", "u").alias("lo"), F.greatest("own", "u").alias("hi"))

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        tiled = key[2] != key[3]
        v = np.stack(part["v"].to_numpy()).astype(np.float64)
        m = part["m"].to_numpy()
        count, labels = np.zeros(len(v), np.int64), np.arange(len(v))
        for a, b in linked(v, threshold, sigmas, seed, part["own"].to_numpy() if tiled else None):
            np.add.at(count, a, m[b])
            np.add.at(count, b, m[a])
            _unite(labels, a, b)
        some = np.flatnonzero(count > 0)
        ids = part["c"].to_numpy()
        return pd.DataFrame({"c": ids[some], "links": count[some], "root": ids[labels[some]]})

    found = cut(spread.groupBy(*keys, "lo", "hi").applyInPandas(compare, "c long, links long, root long"))
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("c").alias("a"), F.col("root").alias("b")))
    per_class = classes.join(links.hint("merge"), "c", "left").join(roots.withColumnRenamed("node", "c").hint("merge"), "c", "left")
    per_class = per_class.select("label", "v", "least", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "c").alias("root"))
    least = per_class.groupBy(F.col("root").alias("r2")).agg(F.min("least").alias("component_id"))
    per_class = per_class.join(least.hint("merge"), F.col("root") == F.col("r2")).select(F.col("label").alias("l2"), F.col("v").alias("v2"), "n_links", "component_id")
    back = valid.join(per_class.hint("merge"), (F.col("label") == F.col("l2")) & (F.col("v") == F.col("v2")))
    out = back.select("id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    return out.unionByName(lone).withColumnRenamed("id", vec_id)
