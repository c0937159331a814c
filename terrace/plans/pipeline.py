"""The whole run: prepare zones, compute, validate, save; resumable by chunks."""

from __future__ import annotations

import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, Observation, functions as F

from ..config import Grid, Settings
from ..functions.geometry import reproject
from ..operators import checkpoint as steps, preparing, repairing, zonal


def _watched(df: DataFrame, step: str, watch: dict[str, Observation] | None) -> DataFrame:
    """Counts the rows that pass here, in whatever job runs the plan."""
    if watch is None:
        return df
    watch[step] = Observation(f"{step}-{uuid.uuid4().hex}")
    return df.observe(watch[step], F.count(F.lit(1)).alias("n"))


def passed(watch: dict[str, Observation]) -> list[tuple[str, int, int]]:
    """(step, rows, rows that it removed) of a preparation that has been watched and has run."""
    n = [(step, seen.get["n"]) for step, seen in watch.items()]
    return [(step, rows, (n[i - 1][1] if i else rows) - rows) for i, (step, rows) in enumerate(n)]


def prepare(parcels: DataFrame, grid: Grid, least_area: float = 0.0, degrees: bool = False, watch: dict[str, Observation] | None = None) -> DataFrame:
    """Zones, reprojected if their points are degrees, repaired, with a geometry that meets the raster (and has the area), numbered in the order of their file where they have their places (see vector.parquet), else by k (or, without such a column, by a hash of their id). watch: a dict to be filled with counters of each step, which the jobs that run anyway fill in passing (see passed())."""
    preparing.require(parcels, "PARCEL_LID", "rings")
    rows = parcels.withColumn("rings", reproject(F.col("rings"))) if degrees else parcels
    rows = rows.withColumn("zone", F.col("PARCEL_LID")) if "zone" not in rows.columns else rows
    placed = {"file", "row_index"} <= set(rows.columns)
    rows = rows.withColumn("k", F.xxhash64("PARCEL_LID")) if "k" not in rows.columns and not placed else rows
    rows = _watched(repairing.repair(_watched(rows, "read", watch)), "repaired", watch)
    rows = preparing.clip(rows, grid.origin_x, grid.origin_y, grid.origin_x + grid.width * grid.cell, grid.origin_y + grid.height * grid.cell)
    rows = _watched(rows, "clipped", watch)
    rows = _watched(preparing.filter_by_area(rows, least_area), "large enough", watch) if least_area > 0 else rows
    rows = rows.drop("min_x", "min_y", "max_x", "max_y")
    return preparing.numbered_as_read(rows) if placed else preparing.numbered(rows, "k")


def run(parcels: DataFrame, px: DataFrame, grid: Grid, method: str = "subpixel", least_area: float = 0.0, checkpoint: str | None = None, settings: Settings | None = None) -> DataFrame:
    """Validated results. With a checkpoint folder: zones are prepared there once, and groups of chunks computed and committed one after another; a run that broke off goes on where it was (see operators/checkpoint.py)."""
    settings = settings or Settings()
    zones = lambda: preparing.count_chunks(prepare(parcels, grid, least_area), settings.chunk_size)
    compute = lambda z: zonal.validate(zonal.zonal(z, px, grid, method), settings)
    if checkpoint is None:
        return compute(zones())
    known = {"method": method, "least_area": least_area, "chunk_size": settings.chunk_size, "min_valid_pixels": settings.min_valid_pixels, "grid": asdict(grid)}
    return steps.run(steps.Folder(parcels.sparkSession, checkpoint), zones, compute, known, settings.chunks_a_commit)


def summary(parcels: DataFrame, checkpoint: str) -> DataFrame:
    """Groups, zones, seconds, zones a second and method of a run with a checkpoint folder, as far as it is committed."""
    return zonal.processing_summary(steps.progress(steps.Folder(parcels.sparkSession, checkpoint)))
