"""Whitening of embeddings: principal components by a randomised range finder, with exact whole-number deviations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize
from .vectors import blocks, totals, whole_numbers

#: Residuals of components and least variances, as shares of the largest eigenvalue: what doubles can tell apart.
PRECISION = 64 * float(np.finfo(float).eps)


@dataclass(frozen=True)
class Centre:
    """Where the rows lie: their number, and exact sums, least and greatest value of each dimension."""

    n: int
    sums: tuple[int, ...]
    low: tuple[int, ...]
    high: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles; the whole part is taken off exactly, so one rounding is all."""
        floors = [s // self.n for s in self.sums]
        return (x - np.array(floors)).astype(float) - np.array([(s - self.n * f) / self.n for s, f in zip(self.sums, floors, strict=True)])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n x - S)^2 of each row, exact at any size."""
        widest = self.n * (1 + max(b - a for a, b in zip(self.low, self.high, strict=True)))
        kind = np.int64 if widest**2 * len(self.sums) < 1 << 63 and self.n * max(map(abs, (*self.low, *self.high))) < 1 << 62 else object
        off = self.n * x.astype(kind) - np.array(self.sums, dtype=kind)
        return [int(v) for v in (off * off).sum(1)]


@dataclass(frozen=True)
class Whitening:
    """Components (columns, dim by count), their eigenvalues by falling size, the covariance's trace, and whether the range finder had to be expanded to all dimensions."""

    centre: Centre
    components: np.ndarray
    values: np.ndarray
    trace: float
    expanded: bool = False
    identity_error: float | None = None

    @property
    def usable(self) -> np.ndarray:
        """Components along which the rows vary at all."""
        return self.values > PRECISION * max(self.values.max(initial=0.0), 0.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections over the root of the eigenvalue; NaN where nothing varies."""
        root = np.sqrt(np.where(self.usable, self.values, np.nan))
        return self.centre.centred(x) @ self.components / root


def centre_of(x: DataFrame, dim: int) -> Centre | None:
    """Number of rows, exact sums and ends; None for an empty table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, np.zeros(dim, np.int64), None, None
        for _, rows in blocks(batches, dim):
            n, sums = n + len(rows), sums + rows.sum(0)
            low = rows.min(0) if low is None else np.minimum(low, rows.min(0))
            high = rows.max(0) if high is None else np.maximum(high, rows.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), *[pa.array(v, pa.int64()) for v in ([n] * dim, sums, low, high)]], names=["entry", "n", "total", "low", "high"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = x.mapInArrow(run, "entry int, n long, total long, low long, high long").groupBy("entry").agg(wide("n"), wide("total"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("entry").collect()
    return Centre(int(found[0]["n"]), *[tuple(int(r[c]) for r in found) for c in ("total", "low", "high")]) if found else None


def covariance_times(x: DataFrame, centre: Centre, basis: np.ndarray) -> tuple[np.ndarray, float]:
    """The covariance of all rows, centred before multiplying, times a basis, and its trace: one pass, in which every task sends one matrix of the basis' shape."""
    dim, wide = basis.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, trace = np.zeros((dim, wide)), 0.0
        for _, rows in blocks(batches, dim):
            y = centre.centred(rows)
            total, trace = total + y.T @ (y @ basis), trace + float((y * y).sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size + 1), pa.int32()), pa.array([*total.ravel(), trace], pa.float64())], names=["entry", "value"])

    found = totals(x.mapInArrow(run, "entry int, value double"), "double")
    out = np.array([found[i] for i in range(dim * wide)]).reshape(dim, wide) / centre.n
    return out, found[dim * wide] / centre.n


def fit(x: DataFrame, dim: int = 64, count: int = 8, oversampling: int = 8, passes: int = 3, seed: int = 12) -> Whitening | None:
    """The leading components of the rows of (vec_id, x), from all of them; None for an empty table.

    A random basis of count + oversampling directions is multiplied by the covariance and made orthonormal again, pass by pass. Each pass also gives Rayleigh-Ritz pairs and their residuals; once these are as small as doubles allow, the pairs are taken. If they are not after so many passes, the basis is completed to all dimensions, where the pairs are exact up to rounding. The driver holds dim by dim numbers at most.
    """
    centre = centre_of(x, dim)
    if centre is None:
        return None
    rng = np.random.default_rng(seed)
    orthonormal = lambda m: np.linalg.qr(m)[0]
    basis = orthonormal(rng.standard_normal((dim, min(dim, count + oversampling))))
    for turn in range(passes + 1):
        if turn == passes:
            basis = orthonormal(np.hstack([basis, rng.standard_normal((dim, dim - basis.shape[1]))]))
        product, trace = covariance_times(x, centre, basis)
        small = basis.T @ product
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        vectors = basis @ turned
        left = np.linalg.norm(product @ turned - vectors * values, axis=0)[:count]
        full = basis.shape[1] == dim
        if full or (left <= PRECISION * max(values[0], 0.0)).all():
            break
        basis = orthonormal(product)
    return Whitening(centre, vectors[:, :count], np.maximum(values[:count], 0.0), trace, expanded=full)


def checked(x: DataFrame, model: Whitening) -> Whitening:
    """The model with its identity_error: the largest absolute entry of the whitened rows' covariance, centred before multiplying, minus the identity; of components along which rows vary, None if there are none."""
    dim, keep = model.components.shape[0], np.flatnonzero(model.usable)
    k = len(keep)
    if not k:
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for _, rows in blocks(batches, dim):
            w = model.whitened(rows)[:, keep]
            sums, products = sums + w.sum(0), products + w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k + k), pa.int32()), pa.array([*products.ravel(), *sums], pa.float64())], names=["entry", "value"])

    found = totals(x.mapInArrow(run, "entry int, value double"), "double")
    mean = np.array([found[k * k + i] for i in range(k)]) / model.centre.n
    spread = np.array([found[i] for i in range(k * k)]).reshape(k, k) / model.centre.n - np.outer(mean, mean)
    return replace(model, identity_error=float(np.abs(spread - np.eye(k)).max()))


def transform(x: DataFrame, model: Whitening) -> DataFrame:
    """A row for each row of x and component: vec_id, component (from 1), n, deviation (decimal), whitened, explained and identity_error. Where no row varies along a component, whitened is null; where none varies at all, explained too."""
    dim, count = model.components.shape
    shares = [float(v / model.trace) if model.trace > 0 else None for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in blocks(batches, dim):
            m = len(rows)
            each = np.repeat(np.arange(m), count)
            deviation = pa.array([Decimal(v) for v in model.centre.deviations(rows)], pa.decimal128(38, 0))
            columns = [part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1), m), pa.int32()), pa.array(np.full(m * count, model.centre.n), pa.int64()), deviation.take(pa.array(each)), pa.array(model.whitened(rows).ravel(), pa.float64(), from_pandas=True), pa.array(shares * m, pa.float64()), pa.array([model.identity_error] * (m * count), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, f"vec_id {x.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, dim: int = 64, count: int = 8, shift: int = 100_000) -> DataFrame:
    """Whitened components of every usable vector of (vec_id, embedding), as transform() gives them.

    Null vectors, those with null or non-finite entries and those of another length than dim are left out; repeated rows and null ids count and are returned each; an empty table gives no row. Other columns are not read. All passes read one table of whole numbers in the shared folder, which is deleted at the end; what is returned reads the vectors given.
    """
    x = materialize(whole_numbers(vectors, dim, shift=shift), "whole-numbers")
    model = fit(x, dim, count)
    if model is None:
        flat = Centre(1, (0,) * dim, (0,) * dim, (0,) * dim)
        return transform(x, Whitening(flat, np.zeros((dim, count)), np.zeros(count), 0.0))
    model = checked(x, model)
    discard(x)
    return transform(whole_numbers(vectors, dim, shift=shift), model)
