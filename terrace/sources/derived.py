"""Zones, raster and boundaries derived from the plain tables, for queries and tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import SQUARE_METRES_AN_ACRE, Grid
from ..functions.geometry import RINGS, point

WIDTH = 120
SIDES = (12, 50, 110, 170, 350, 500)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grid_of(spark: SparkSession, sf_dir: str) -> Grid:
    return Grid(WIDTH, -(-table(spark, sf_dir, "orders").count() // WIDTH))


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row, col, val: a cell for each order."""
    key = F.col("o_orderkey")
    val = F.when((F.col("o_orderstatus") == "P") & (key % 5 == 0), 0).when(key % 97 == 0, 6).otherwise(F.substring("o_orderpriority", 1, 1).cast("int"))
    return table(spark, sf_dir, "orders").select(F.floor(key / WIDTH).alias("row"), (key % WIDTH).alias("col"), val.alias("val"))


def parcels(spark: SparkSession, sf_dir: str, grid: Grid) -> DataFrame:
    """k, PARCEL_LID (also as zone), CAL_ACREAGE, rings: squares, triangles, L shapes and squares with a hole."""
    k = F.col("p_partkey")
    w = F.get(F.array(*[F.lit(s) for s in SIDES]), (k % 6).cast("int"))
    x0 = k * 37 % 120 * 30 + k % 30
    y0 = k * 61 % grid.height * 30 + k * 7 % 30
    rows = table(spark, sf_dir, "part").select(k.alias("k"), w.alias("w"), x0.alias("x0"), y0.alias("y0"), (F.floor(k / 6) % 4).alias("shape"))
    at = lambda dx, dy: point(F.col("x0") + dx, F.col("y0") + dy)
    W, h, q = F.col("w"), F.floor(F.col("w") / 2), F.floor(F.col("w") / 4)
    square = F.array(at(0, 0), at(W, 0), at(W, W), at(0, W))
    hole = F.array(at(q, q), at(h, q), at(h, h), at(q, h))
    shapes = {0: F.array(square), 1: F.array(F.array(at(0, 0), at(W, 0), at(0, W))), 2: F.array(F.array(at(0, 0), at(W, 0), at(W, h), at(h, h), at(h, W), at(0, W))), 3: F.array(square, hole)}
    rings = F.coalesce(*[F.when(F.col("shape") == i, s.cast(RINGS)) for i, s in shapes.items()])
    rows = rows.withColumn("rings", rings)
    sizes = {0: W * W, 1: W * W / 2, 2: W * h + (W - h) * h, 3: W * W - (h - q) * (h - q)}
    known = F.coalesce(*[F.when(F.col("shape") == i, a.cast("double")) for i, a in sizes.items()]) / SQUARE_METRES_AN_ACRE * (1 + (F.col("k") % 21 - 10) / 1000)
    acreage = F.when(F.col("k") % 50 == 0, None).when(F.col("k") % 53 == 1, 0.0).otherwise(known)
    lid = F.concat(F.lit("P"), F.lpad(F.col("k").cast("string"), 8, "0"))
    return rows.select("k", lid.alias("PARCEL_LID"), lid.alias("zone"), acreage.alias("CAL_ACREAGE"), "rings")


def counties(spark: SparkSession, sf_dir: str, grid: Grid) -> DataFrame:
    k = F.col("n_nationkey")
    i, j, step = k % 5, F.floor(k / 5), grid.height * 6
    return table(spark, sf_dir, "nation").select(F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("STATEFP"), F.col("n_name").alias("NAME"), *[c.cast("double").alias(n) for n, c in (("c_min_x", i * 720), ("c_min_y", j * step), ("c_max_x", (i + 1) * 720), ("c_max_y", (j + 1) * step))])


def districts(spark: SparkSession, sf_dir: str, grid: Grid) -> DataFrame:
    """STATEFP, NAME and rings: in the boxes of counties, in turn, the box, an L of it, and it with a hole."""
    rows = counties(spark, sf_dir, grid).join(table(spark, sf_dir, "nation").select(F.col("n_name").alias("NAME"), F.col("n_nationkey").alias("turn")), "NAME")
    x, y, w, h = F.col("c_min_x"), F.col("c_min_y"), F.col("c_max_x") - F.col("c_min_x"), F.col("c_max_y") - F.col("c_min_y")
    at = lambda a, b: point(x + w * a / 6, y + h * b / 6)
    whole = F.array(at(0, 0), at(6, 0), at(6, 6), at(0, 6))
    bent = F.array(at(0, 0), at(6, 0), at(6, 3), at(3, 3), at(3, 6), at(0, 6))
    hole = F.array(at(2, 2), at(4, 2), at(4, 4), at(2, 4))
    return rows.select("STATEFP", "NAME", F.when(F.col("turn") % 3 == 0, F.array(whole)).when(F.col("turn") % 3 == 1, F.array(bent)).otherwise(F.array(whole, hole)).cast(RINGS).alias("rings"))
