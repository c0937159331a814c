"""Writing results: Parquet, GeoJSON lines, CSV, summary JSON."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import PERCENTS, Settings
from ..functions import wkb
from ..functions.geometry import parts

FORMATS = ("parquet", "geojson", "csv")


def save(rows: DataFrame, folder: str, fmt: str | None = None, settings: Settings | None = None) -> str:
    """Writes in a format (that of the settings, where none is given) into a folder named by time and format; returns its path. Parquet: rings as well-known binary in a column geometry. GeoJSON: one feature a line. Both write a multipolygon where rings make several parts (see geometry.parts). CSV: without geometry."""
    fmt = fmt or (settings or Settings()).output_format
    if fmt not in FORMATS:
        raise ValueError(f"unknown format: {fmt}")
    path = f"{folder}/zone_results_{datetime.now(UTC):%Y%m%d_%H%M%S_%f}.{fmt}"
    plain = rows.drop("rings", "geometry")
    if fmt == "parquet":
        shaped = rows.withColumn("geometry", wkb.encode(F.col("rings"))).drop("rings") if "rings" in rows.columns else rows
        shaped.write.option("compression", (settings or Settings()).compression).parquet(path)
    elif fmt == "csv":
        plain.write.option("header", True).csv(path)
    else:
        ring = lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.array(p["x"], p["y"]))
        polygon = lambda rs: F.transform(rs, ring)
        shape = lambda kind, value: F.to_json(F.struct(F.lit(kind).alias("type"), value.alias("coordinates")))
        # a generator of one row, so that parts are found once
        held = rows.select(*plain.columns, F.inline(F.array(F.struct(parts(F.col("rings")).alias("__parts")))))
        geometry = F.when(F.col("__parts").isNull(), "null").when(F.size("__parts") == 1, shape("Polygon", polygon(F.get("__parts", F.lit(0))))).otherwise(shape("MultiPolygon", F.transform("__parts", polygon)))
        feature = F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), F.to_json(F.struct(*plain.columns)), F.lit("}"))
        held.select(feature.alias("value")).write.text(path)
    return path


def summary(rows: DataFrame) -> dict:
    """Counts and means of validated results, as numbers."""
    # a row for each class, from which the whole follows: one job over rows
    sums = [F.sum(p).alias(p) for p in PERCENTS]
    each = rows.groupBy("majority_land_use").agg(F.count(F.lit(1)).alias("n"), F.sum("total_pixels").alias("pixels"), F.count_if(F.col("valid_pixels") == 0).alias("n_without"), F.count_if("is_valid").alias("n_valid"), *sums).collect()
    total = {k: sum(r[k] or 0 for r in each) for k in ("n", "pixels", "n_without", "n_valid", *PERCENTS)}
    n, share = total["n"], lambda x, of: round(x / of, 6) if of else None
    named = sum(r["n"] for r in each if r["majority_land_use"] is not None)
    return {
        "made": datetime.now(UTC).isoformat(),
        "parcels": n,
        "distribution": {r["majority_land_use"]: {"n": r["n"], "pct": share(100 * r["n"], named)} for r in each if r["majority_land_use"] is not None},
        "average": {p: share(total[p], n) for p in PERCENTS},
        "pixels": round(total["pixels"], 4),
        "mean_pixels": share(total["pixels"], n),
        "n_without": total["n_without"],
        "n_valid": total["n_valid"],
        "n_invalid": n - total["n_valid"],
        "valid_pct": share(100 * total["n_valid"], n),
    }


def report(found: dict, seconds: float | None = None) -> str:
    time = [f"Seconds: {seconds:.1f}", f"Parcels a second: {found['parcels'] / seconds:.1f}"] if seconds else []
    lines = [f"Parcels: {found['parcels']}", *time, f"Valid: {found['n_valid']} ({found['valid_pct']} %)", "", "Majority class:"]
    lines += [f"  {name}: {x['n']} ({x['pct']} %)" for name, x in sorted(found["distribution"].items(), key=lambda x: -x[1]["n"])]
    return "\n".join([*lines, "", "Mean share:", *[f"  {k}: {v} %" for k, v in found["average"].items()]])


def as_json(found: dict) -> str:
    return json.dumps(found, indent=2)


def clean_checkpoint(spark: SparkSession, folder: str) -> bool:
    """Deletes a checkpoint folder; was there one?"""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def save_table(rows: DataFrame, folder: str, name: str) -> str:
    """An analysis result as CSV with a header; returns its path."""
    path = f"{folder}/{name}.csv"
    rows.write.mode("overwrite").option("header", True).csv(path)
    return path
