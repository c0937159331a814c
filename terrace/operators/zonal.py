"""Zonal statistics: shares of classes, majority, pixel counts and acres for every zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import CLASSES, PERCENTS, PROPORTION_TOLERANCE, SQUARE_METRES_AN_ACRE, TIER_ELSE, TIERS, Grid, Settings
from ..functions.geometry import acres
from .coverage import cover, touched
from .tiles import met


def resolution(acreage: Column) -> Column:
    """Sub-cells a side, by acreage; NULL and NaN get the last tier."""
    known = acreage.isNotNull() & ~F.isnan(acreage)
    out = F.lit(TIER_ELSE)
    for limit, n in reversed(TIERS):
        out = F.when(known & (acreage < limit), n).otherwise(out)
    return out


def class_name(value: Column) -> Column:
    out = F.concat(F.lit("CLASS_"), value.cast("string"))
    for k, name in CLASSES.items():
        out = F.when(value == k, name).otherwise(out)
    return out


def class_hits(covered: DataFrame, px: DataFrame, zones: DataFrame, grid: Grid) -> DataFrame:
    """zone, val, hits: covered cells met with the raster's tiles; no-data cells fall away. The raster may be tiles or a row for each cell, which are tiled first."""
    return met(covered, px, zones, grid, "hits").groupBy("zone", "val").agg(F.sum("hits").alias("hits"))


def summary(parcels: DataFrame, hits: DataFrame, scale: Column, grid: Grid, mapped_only: bool) -> DataFrame:
    """A row for every zone of parcels, also those without a cell (NO_DATA).

    mapped_only: values outside the class table count for acres alone; else they are in the total and may be the majority. Of equal counts the class of least value wins, classes before other values.
    """
    mapped = F.col("val").isin(*CLASSES)
    counted = hits.withColumn("counts", mapped if mapped_only else F.lit(True))
    order = F.struct("hits", mapped.cast("int").alias("m"), (-F.col("val")).alias("v"))
    grouped = counted.groupBy("zone").agg(
        F.sum("hits").alias("all_hits"),
        F.sum(F.when(F.col("counts"), F.col("hits"))).alias("total"),
        F.max_by("val", F.when(F.col("counts"), order)).alias("top"),
        *[F.sum(F.when(F.col("val") == k, F.col("hits")).otherwise(0)).alias(f"h{k}") for k in CLASSES],
    )
    rows = parcels.join(grouped, "zone", "left")
    some = F.coalesce(F.col("total") > 0, F.lit(False))
    pct = {p: F.when(some, F.col(f"h{k}") / F.col("total") * 100).otherwise(0.0) for k, p in zip(CLASSES, PERCENTS, strict=True)}
    pixels = F.when(some, F.col("total") / scale).otherwise(0.0)
    acres = F.coalesce(F.col("all_hits") / scale * grid.pixel_area / SQUARE_METRES_AN_ACRE, F.lit(0.0))
    return rows.withColumns(pct | {"majority_land_use": F.when(some, class_name(F.col("top"))).otherwise("NO_DATA"), "total_pixels": pixels, "valid_pixels": pixels, "calculated_acres": acres}).drop("all_hits", "total", "top", *[f"h{k}" for k in CLASSES])


def acre_difference(rows: DataFrame) -> DataFrame:
    """acre_diff and acre_diff_pct where pixels were found; a zero acreage gives an infinite percentage of the difference's sign. Without acreages both are null."""
    if "CAL_ACREAGE" not in rows.columns:
        return rows.withColumns({c: F.lit(None).cast("double") for c in ("acre_diff", "acre_diff_pct")})
    found = F.col("calculated_acres") > 0
    diff = F.col("calculated_acres") - F.col("CAL_ACREAGE")
    share = F.when(F.col("CAL_ACREAGE") == 0, F.lit(float("inf")) * F.signum(diff)).otherwise(F.try_divide(diff, F.col("CAL_ACREAGE")) * 100)
    return rows.withColumns({"acre_diff": F.when(found, diff), "acre_diff_pct": F.when(found, share)})


def zonal(parcels: DataFrame, px: DataFrame, grid: Grid, method: str = "subpixel") -> DataFrame:
    """parcels: zone (unique), rings, and CAL_ACREAGE; where that column is missing, the geometry's acres set the resolution. Methods: subpixel (resolution by acreage), center, standard (all cells touched)."""
    plain = parcels.drop("rings")
    if method == "subpixel":
        sized = parcels.withColumn("n", resolution(F.col("CAL_ACREAGE") if "CAL_ACREAGE" in parcels.columns else acres(F.col("rings"))).cast("long"))
        hits = class_hits(cover(sized, grid, F.col("n")), px, parcels, grid)
        rows = summary(sized.drop("rings"), hits, F.col("n") * F.col("n"), grid, mapped_only=False)
        return acre_difference(rows).withColumnRenamed("n", "subpixel_resolution")
    if method not in ("center", "standard"):
        raise ValueError(f"unknown method: {method}")
    covered = cover(parcels, grid, F.lit(1)) if method == "center" else touched(parcels, grid).withColumn("hits", F.lit(1).cast("long"))
    rows = summary(plain, class_hits(covered, px, parcels, grid), F.lit(1), grid, mapped_only=True)
    return rows.withColumns({"acre_diff": F.lit(None).cast("double"), "acre_diff_pct": F.lit(None).cast("double"), "subpixel_resolution": F.lit(None).cast("long")})


def fixed_acres(parcels: DataFrame, grid: Grid, n: int) -> DataFrame:
    """Covered cells at n by n, whatever their class: zone, pixels, acres."""
    found = cover(parcels, grid, F.lit(n)).groupBy("zone").agg(F.sum("hits").alias("hits"))
    pixels = F.coalesce(F.col("hits"), F.lit(0)) / (n * n)
    return parcels.select("zone").join(found, "zone", "left").select("zone", pixels.alias("pixels"), (pixels * grid.pixel_area / SQUARE_METRES_AN_ACRE).alias("acres"))


def weighted_count(parcels: DataFrame, px: DataFrame, grid: Grid) -> DataFrame:
    """Touched and centre counts of cells with data, mixed: 0.8 for the centre count below one cell's acreage, 0.5 below two, else 0.2."""
    both = met(touched(parcels, grid), px, parcels, grid, "centre").groupBy("zone").agg(F.count(F.lit(1)).alias("touched"), F.count_if("centre").alias("centre"))
    cell = grid.pixel_area / SQUARE_METRES_AN_ACRE
    acreage = F.coalesce(F.col("CAL_ACREAGE"), F.lit(1.0))
    w = F.when(acreage < cell, 0.8).when(acreage < 2 * cell, 0.5).otherwise(0.2)
    rows = parcels.drop("rings").join(both, "zone", "left").na.fill(0, ["touched", "centre"])
    return rows.select("zone", "touched", "centre", (F.col("touched") * (1 - w) + F.col("centre") * w).alias("weighted"))


def validate(rows: DataFrame, settings: Settings | None = None) -> DataFrame:
    """proportion_sum and is_valid."""
    least = (settings or Settings()).min_valid_pixels
    total = sum((F.col(p) for p in PERCENTS[1:]), F.col(PERCENTS[0]))
    off = (F.abs(total - 100) > PROPORTION_TOLERANCE) & (F.col("valid_pixels") > 0)
    return rows.withColumns({"proportion_sum": total, "is_valid": ~off & ~(F.col("valid_pixels") < least)})


def processing_summary(stats: DataFrame) -> DataFrame:
    """Of rows a chunk (n_parcels, seconds, method): chunks, zones, seconds, zones a second and the most frequent method; no row for no chunk."""
    return stats.agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("n_parcels").alias("total_parcels"), F.round(F.sum("seconds"), 6).alias("total_seconds"), F.round(F.try_divide(F.sum("n_parcels"), F.sum("seconds")), 6).alias("parcels_a_second"), F.mode("method", True).alias("primary_method")).where("n_chunks > 0")
