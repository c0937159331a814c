"""Zones from files: Parquet with well-known binary, and GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Settings
from ..functions import wkb
from ..functions.geometry import RINGS
from ..operators.preparing import require, sample

REQUIRED = ("PARCEL_LID", "CAL_ACREAGE", "geometry")
FEATURES = "features array<struct<geometry: struct<type: string, coordinates: string>, properties: map<string, string>>>"


def points(ring: Column) -> Column:
    """[[x, y], ...] as points, without the closing one."""
    made = F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    closed = (F.size(made) > 1) & (F.element_at(made, 1) == F.element_at(made, -1))
    return F.when(closed, F.slice(made, F.lit(1), F.size(made) - 1)).otherwise(made)


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None, places: bool = False) -> DataFrame:
    """Columns asked for, and the required ones that the file has; geometry (well-known binary) becomes rings. places: with the file and row_index of each row, for numbered_as_read()."""
    df = spark.read.parquet(path)
    if places:
        df = df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index"))
        columns = columns and [*columns, "file", "row_index"]
    if columns is not None:
        df = df.select(*dict.fromkeys([*columns, *[c for c in REQUIRED if c in df.columns]]))
    return wkb.decode(df) if "geometry" in df.columns else df


def geojson(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A row for each feature of collections (one a file) and of files of a feature a line. Properties become columns: id and acreage, and those asked for, as strings. Shapes other than polygons have null rings."""
    whole = spark.read.schema(FEATURES).option("multiLine", True).json(path).where("features is not null").select(F.explode("features").alias("f"))
    lines = spark.read.schema("type string, geometry struct<type: string, coordinates: string>, properties map<string, string>").json(path).where("type = 'Feature'").select(F.struct("geometry", "properties").alias("f"))
    rows = whole.unionByName(lines)
    shape = F.col("f.geometry.coordinates")
    one = F.from_json(shape, "array<array<array<double>>>")
    many = F.flatten(F.from_json(shape, "array<array<array<array<double>>>>"))
    found = F.when(F.col("f.geometry.type") == "Polygon", one).when(F.col("f.geometry.type") == "MultiPolygon", many)
    names = dict.fromkeys(["PARCEL_LID", "CAL_ACREAGE", *(columns or [])])
    values = [F.col("f.properties")[n].try_cast("double" if n == "CAL_ACREAGE" else "string").alias(n) for n in names]
    return rows.select(*values, F.transform(found, points).cast(RINGS).alias("rings"))


def load(spark: SparkSession, path: str, columns: list[str] | None = None, sample_size: int | None = None, settings: Settings | None = None) -> DataFrame:
    """Zones by the suffix of their path; raises where the id column is missing. Acreages that are no number are null. sample_size: so many rows, the same each time."""
    suffix = path.rstrip("/").rpartition(".")[2].lower()
    readers = {"parquet": parquet, "geojson": geojson, "json": geojson}
    if suffix not in readers:
        raise ValueError(f"unknown format: {suffix}")
    rows = require(readers[suffix](spark, path, columns), "PARCEL_LID")
    if "CAL_ACREAGE" in rows.columns:
        rows = rows.withColumn("CAL_ACREAGE", F.nanvl(F.col("CAL_ACREAGE").cast("double"), F.lit(None).cast("double")))
    return sample(rows, sample_size, "PARCEL_LID", (settings or Settings()).sample_seed) if sample_size else rows


def newest(spark: SparkSession, folder: str, start: str = "zone_results_") -> str | None:
    """The result that was written last into a folder; None if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    found = [(f.getModificationTime(), f.getPath().toString()) for f in files.listStatus(path) if f.getPath().getName().startswith(start)]
    return max(found)[1] if found else None
