"""Summaries of results: distributions, acre-weighted shares, size buckets, error metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..config import CLASSES, PERCENTS, SIZE_EDGES, SQUARE_METRES_AN_ACRE, Grid

#: Raw cover codes to classes, as the raster comparison has them.
REMAP = {
    1: "DEVELOPED", 2: "AGRICULTURE", 3: "RANGELAND_PASTURE", 4: "FOREST", 5: "OTHER", 6: "OTHER", 7: "OTHER", 8: "DEVELOPED",
    9: "FOREST", 10: "RANGELAND_PASTURE", 11: "AGRICULTURE", 12: "AGRICULTURE", 13: "OTHER", 14: "OTHER", 15: "OTHER",
}


def bucket(acreage: Column, edges: tuple[float, ...] = SIZE_EDGES) -> Column:
    """Number of the bucket (low, high] from 1; null at or below the first edge."""
    out = None
    for i, (low, high) in enumerate(zip(edges, (*edges[1:], None), strict=True), 1):
        hit = (acreage > low) if high is None else (acreage > low) & (acreage <= high)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


def majority_distribution(rows: DataFrame) -> DataFrame:
    """Zones of each majority and their share; the total is taken over the few counts, so zones are computed once."""
    counts = rows.where(F.col("majority_land_use").isNotNull()).groupBy("majority_land_use").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("majority_land_use", "n", F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 6).alias("pct"))


def average_proportions(rows: DataFrame) -> DataFrame:
    return rows.agg(*[F.round(F.avg(p), 6).alias(p) for p in PERCENTS])


def pixel_statistics(rows: DataFrame) -> DataFrame:
    return rows.agg(F.round(F.sum("total_pixels"), 4).alias("pixels"), F.round(F.avg("total_pixels"), 6).alias("mean_pixels"), F.count_if(F.col("valid_pixels") == 0).alias("n_without"))


def validation_statistics(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if("is_valid").alias("n_valid"), F.count_if(~F.col("is_valid")).alias("n_invalid"), F.round(F.avg(F.col("is_valid").cast("double")) * 100, 6).alias("valid_pct"))


def acre_weighted(rows: DataFrame) -> DataFrame:
    """For each class its acres, its share of all acreage, its mean share of parcels, and the quotient of the two."""
    one = rows.agg(F.sum("CAL_ACREAGE").alias("total"), *[F.sum(F.col("CAL_ACREAGE") * F.col(p) / 100).alias(f"a_{p}") for p in PERCENTS], *[F.avg(p).alias(f"m_{p}") for p in PERCENTS])
    each = F.array(*[F.struct(F.lit(n).alias("class"), F.col(f"a_{p}").alias("acres"), F.col(f"m_{p}").alias("mean")) for n, p in zip(CLASSES.values(), PERCENTS, strict=True)])
    rows = one.select("total", F.explode(each).alias("c"))
    share = F.try_divide(F.col("c.acres"), F.col("total")) * 100
    return rows.select("c.class", F.round("c.acres", 4).alias("acres"), F.round(share, 6).alias("acre_pct"), F.round("c.mean", 6).alias("parcel_pct"), F.round(share - F.col("c.mean"), 6).alias("diff"), F.round(F.try_divide(F.col("c.mean"), share), 6).alias("bias"))


def size_buckets(rows: DataFrame) -> DataFrame:
    total = rows.agg(F.sum("CAL_ACREAGE").alias("total"))
    grouped = rows.withColumn("bucket", bucket(F.col("CAL_ACREAGE"))).where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("CAL_ACREAGE").alias("acres"), F.sum(F.col("CAL_ACREAGE") * F.col("developed_pct") / 100).alias("dev"))
    return grouped.crossJoin(F.broadcast(total)).select("bucket", "n", F.round("acres", 4).alias("acres"), F.round(F.col("acres") / F.col("n"), 6).alias("mean_acres"), F.round(F.col("acres") / F.col("total") * 100, 6).alias("acre_pct"), F.round(F.when(F.col("acres") > 0, F.col("dev") / F.col("acres") * 100).otherwise(0.0), 6).alias("developed_pct"))


def histogram(px: DataFrame) -> DataFrame:
    return px.groupBy("val").agg(F.count(F.lit(1)).alias("n"))


def class_acres(px: DataFrame, names: dict[int, str], grid: Grid) -> DataFrame:
    """Cells, acres and share of cells with data for each class name; other values fall away, see unmapped()."""
    name = F.coalesce(*[F.when(F.col("val") == k, v) for k, v in names.items()])
    counts = histogram(px.where("val <> 0")).select(name.alias("class"), "n").where("class is not null").groupBy("class").agg(F.sum("n").alias("cells"))
    total = counts.agg(F.sum("cells").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("class", "cells", F.round(F.col("cells") * grid.pixel_area / SQUARE_METRES_AN_ACRE, 4).alias("acres"), F.round(F.col("cells") * 100 / F.col("total"), 6).alias("pct"))


def unmapped(px: DataFrame, names: dict[int, str]) -> DataFrame:
    """Values above 0 that have no class name, with their cells."""
    return histogram(px.where((F.col("val") > 0) & ~F.col("val").isin(list(names))))


def error_metrics(rows: DataFrame, truth: str, estimate: str) -> DataFrame:
    """Mean and root mean square error, largest, mean, median, deviation, least and most, and correlation."""
    e = F.col(estimate) - F.col(truth)
    both = (F.col(truth) > 0) & (F.col(estimate) > 0)
    return rows.where(F.col(truth).isNotNull() & F.col(estimate).isNotNull()).agg(
        F.round(F.avg(F.abs(e)), 6).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"), F.round(F.max(F.abs(e)), 6).alias("max_error"), F.round(F.avg(e), 6).alias("mean_error"),
        F.round(F.median(e), 6).alias("median_error"), F.round(F.stddev_samp(e), 6).alias("std_error"), F.round(F.min(e), 6).alias("least_error"), F.round(F.corr(F.when(both, F.col(truth)), F.when(both, F.col(estimate))), 6).alias("correlation"),
    )


def tolerance_buckets(rows: DataFrame, pct: str) -> DataFrame:
    known = rows.where(F.col(pct).isNotNull() & ~F.isnan(pct))
    size = F.abs(F.col(pct))
    return known.agg(*[F.count_if(size <= t).alias(f"within_{t}") for t in (5, 10, 25)], F.count_if(size > 25).alias("over_25"))


def describe(rows: DataFrame, column: str) -> DataFrame:
    at = lambda p: F.round(F.percentile(column, F.lit(p)), 6)
    return rows.agg(F.count(column).alias("n"), F.round(F.avg(column), 6).alias("mean"), F.round(F.stddev_samp(column), 6).alias("std"), F.round(F.min(column), 6).alias("least"), at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"), F.round(F.max(column), 6).alias("most"))


def coverage(zones: DataFrame, px: DataFrame, grid: Grid) -> DataFrame:
    """One row: raster_acres of cells with a class, parcel_acres (sum of CAL_ACREAGE), coverage_pct of the second in the first, and n, the number of zones; without such cells the share is null."""
    acres = px.where(F.col("val").isin(*CLASSES)).agg((F.count(F.lit(1)) * grid.pixel_area / SQUARE_METRES_AN_ACRE).alias("r"))
    whole = zones.agg(F.sum("CAL_ACREAGE").alias("p"), F.count(F.lit(1)).alias("n"))
    return acres.crossJoin(whole).select(F.round("r", 4).alias("raster_acres"), F.round("p", 4).alias("parcel_acres"), F.round(F.try_divide("p", "r") * 100, 6).alias("coverage_pct"), "n")
