"""Centroid clustering of embeddings by partial-distance search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize
from .vectors import blocks, totals, whole_numbers

#: Dimensions that are added between two looks at what is left.
STEP = 8


def nearest(x: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x its nearest centroid (of equally near ones, the smaller number) and their squared distance.

    Squared differences are added in the given order of dimensions, STEP at a time. The centroid nearest in the first ones is finished first; any other is abandoned once its part is strictly above the best so far, and survivors finish all dimensions, so ties are seen.
    """
    x, c = x[:, order], centroids[:, order]
    head = np.stack([((x[:, :STEP] - each[:STEP]) ** 2).sum(1) for each in c], axis=1)
    guess = head.argmin(1)
    which, best = guess.copy(), head[np.arange(len(x)), guess] + ((x[:, STEP:] - c[guess, STEP:]) ** 2).sum(1)
    for k in range(len(c)):
        rows = np.flatnonzero((guess != k) & (head[:, k] <= best))
        part = head[rows, k]
        for at in range(STEP, x.shape[1], STEP):
            part = part + ((x[rows, at : at + STEP] - c[k, at : at + STEP]) ** 2).sum(1)
            alive = part <= best[rows]
            rows, part = rows[alive], part[alive]
        better = (part < best[rows]) | ((part == best[rows]) & (k < which[rows]))
        best[rows[better]], which[rows[better]] = part[better], k
    return which, best


def by_variance(x: DataFrame, dim: int) -> np.ndarray:
    """Dimensions by falling variance, from all rows. It orders the work only; results do not hang on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, np.zeros(dim), np.zeros(dim)
        for _, rows in blocks(batches, dim):
            n, total, squares = n + len(rows), total + rows.sum(0), squares + (rows.astype(float) ** 2).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(2 * dim + 1), pa.int32()), pa.array([*total, *squares, n], pa.float64())], names=["entry", "value"])

    found = totals(x.mapInArrow(run, "entry int, value double"), "double")
    n = found.get(2 * dim) or 1
    spread = np.array([(found.get(dim + i) or 0) / n - ((found.get(i) or 0) / n) ** 2 for i in range(dim)])
    return np.argsort(-spread, kind="stable")


def first_centroids(x: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the least hashes of seed:vec_id; of equal ones (repeated ids) the lesser vector first; null ids after all others."""
    by = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("vec_id").cast("string")), 256)
    rows = x.orderBy(F.col("vec_id").isNull(), by, "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def moved(x: DataFrame, centroids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """One round: every vector to its nearest centroid, then every centroid that has some to the floor of their mean, exactly. Each task sends one row of sums a centroid and dimension."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dim + 1), np.int64)
        for _, rows in blocks(batches, dim):
            which, _ = nearest(rows, centroids, order)
            for j in np.unique(which):
                mine = rows[which == j]
                sums[j, :dim] += mine.sum(0)
                sums[j, dim] += len(mine)
        yield pa.RecordBatch.from_arrays([pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel(), pa.int64())], names=["entry", "value"])

    found = totals(x.mapInArrow(run, "entry int, value long"), "decimal(38,0)")
    out = centroids.copy()
    for j in range(k):
        n = int(found.get(j * (dim + 1) + dim) or 0)
        if n:
            out[j] = [int(found[j * (dim + 1) + i]) // n for i in range(dim)]
    return out


def fit(x: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Centroids after so many rounds over all rows of (vec_id, x), and the order of dimensions to search in. Fewer vectors than k give as many centroids as there are vectors; k by dim numbers are all that the driver holds."""
    order = by_variance(x, dim)
    centroids = first_centroids(x, k, seed).reshape(-1, dim)
    for _ in range(rounds if len(centroids) else 0):
        new = moved(x, centroids, order)
        if np.array_equal(new, centroids):  # further rounds would change nothing
            break
        centroids = new
    return centroids, order


def assign(x: DataFrame, centroids: np.ndarray, order: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every row."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in blocks(batches, dim):
            which, best = nearest(rows, centroids, order)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(which, pa.int32()), pa.array(best, pa.int64())], names=["vec_id", "cluster", "distance"])

    return x.mapInArrow(run, f"vec_id {x.schema['vec_id'].dataType.simpleString()}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector of (vec_id, embedding).

    Vectors that are null, hold nulls or non-finite entries or have another length are left out (see whole_numbers); repeated rows and ids count and are returned each; equally near centroids give the smaller number; a centroid that no vector is nearest to stays where it is; an empty table gives no row. Other columns are not read.
    The vectors are written once, as whole numbers, into the shared folder, and every round reads that table: a lost executor costs its tasks only. The table is deleted at the end; what is returned reads the vectors given.
    """
    x = materialize(whole_numbers(vectors, dim), "whole-numbers")
    centroids, order = fit(x, k, rounds, seed, dim)
    # a row for each centroid: of a size that the caller sets
    sums = {r["cluster"]: int(r["total"]) for r in assign(x, centroids, order).groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    discard(x)
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(i, total, sum(sums.values()), prints[i]) for i, total in sorted(sums.items())]
    named = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assign(whole_numbers(vectors, dim), centroids, order).join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
