"""Zone preparation: validity, filters, clipping, chunks, samples, joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Grid, Settings
from ..functions.geometry import area, meets_box, near_box, with_bounds
from . import repairing


def require(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def validity(df: DataFrame) -> DataFrame:
    """n_null, n_empty, n_invalid (see repairing.invalid) and n_valid of zones with rings: one row."""
    rows = df.select(F.monotonically_increasing_id().alias("key"), "rings")
    bad = repairing.invalid(rows).distinct().agg(F.count(F.lit(1)).alias("n_invalid"))
    null, empty = F.col("rings").isNull(), F.coalesce(F.size("rings") == 0, F.lit(False))
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(null).alias("n_null"), F.count_if(empty).alias("n_empty"))
    return counts.crossJoin(bad).select("n_null", "n_empty", "n_invalid", (F.col("n") - F.col("n_null") - F.col("n_empty") - F.col("n_invalid")).alias("n_valid"))


def drop_empty(df: DataFrame) -> DataFrame:
    return df.where(F.col("rings").isNotNull() & (F.size("rings") > 0))


def clip(df: DataFrame, min_x: float, min_y: float, max_x: float, max_y: float, buffer: float = 0.0) -> DataFrame:
    """Rows whose polygon meets the box, or comes within buffer of it: bounds first, then the exact test. Geometries stay whole."""
    near = with_bounds(df).where((F.col("max_x") >= min_x - buffer) & (F.col("min_x") <= max_x + buffer) & (F.col("max_y") >= min_y - buffer) & (F.col("min_y") <= max_y + buffer))
    box = (min_x, min_y, max_x, max_y)
    return near.where(near_box(F.col("rings"), *box, buffer) if buffer > 0 else meets_box(F.col("rings"), *box))


def statistics(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: validity counts of the zones before preparation, and how many there were, are left and were removed."""
    n = before.agg(F.count(F.lit(1)).alias("n_before")).crossJoin(after.agg(F.count(F.lit(1)).alias("n_after")))
    return validity(before).crossJoin(n).withColumn("n_removed", F.col("n_before") - F.col("n_after"))


def filter_by_area(df: DataFrame, least: float, most: float | None = None) -> DataFrame:
    """Adds area_m2; both ends count; no or zero most: no upper end."""
    rows = df.withColumn("area_m2", area(F.col("rings"))).where(F.col("area_m2") >= least)
    return rows.where(F.col("area_m2") <= most) if most else rows


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    first = Window.partitionBy(key).orderBy(order)
    return df.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r")


def numbered(df: DataFrame, order: str, rows_a_range: int = 500_000) -> DataFrame:
    """processing_id from 0 in the order of a numeric column, without one task for all rows: ranges of the order are counted, their counts summed, and each row numbered within its range."""
    ranges = min(1_000, max(8, df.count() // rows_a_range))
    bounds = df.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    bounds = sorted(set(bounds))
    bucket = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(order))) if bounds else F.lit(0)
    rows = df.withColumn("__b", bucket)
    counts = rows.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    base = counts.select("__b", (F.sum("__n").over(Window.orderBy("__b")) - F.col("__n")).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("__b").orderBy(order)) - 1
    return rows.withColumn("__i", inside).join(base, "__b").withColumn("processing_id", (F.col("__base") + F.col("__i")).cast("long")).drop("__b", "__i", "__base")


def numbered_as_read(df: DataFrame, file: str = "file", row: str = "row_index", rows_a_part: int = 65_536) -> DataFrame:
    """processing_id from 0 in the order in which rows lie in their files, files by name (see vector.parquet's places): stretches of a file are counted, their counts summed (a row for each stretch, in one task), and each row is numbered within its stretch. So rows may have been left out before."""
    rows = df.withColumn("__p", F.floor(F.col(row) / rows_a_part))
    counts = rows.groupBy(file, "__p").agg(F.count(F.lit(1)).alias("__n"))
    base = counts.select(file, "__p", (F.sum("__n").over(Window.orderBy(file, "__p")) - F.col("__n")).alias("__base"))
    inside = F.row_number().over(Window.partitionBy(file, "__p").orderBy(row)) - 1
    return rows.withColumn("__i", inside).join(base, [file, "__p"]).withColumn("processing_id", (F.col("__base") + F.col("__i")).cast("long")).drop("__p", "__i", "__base")


def requirements(zones: DataFrame, grid: Grid, chunk_size: int = 5000, window_mb: float = 1000.0) -> DataFrame:
    """One row: total_parcels, estimated_chunks, raster_size_mb (a byte a cell), parcel_size_mb (16 bytes a point) and estimated_peak_mb: zones and the part of the raster that is open at once, at most window_mb."""
    mb = float(1 << 20)
    points = F.aggregate("rings", F.lit(0).cast("long"), lambda a, r: a + F.size(r))
    found = zones.agg(F.count(F.lit(1)).alias("total_parcels"), (F.coalesce(F.sum(points), F.lit(0)) * 16 / mb).alias("parcel_size_mb")).withColumn("raster_size_mb", F.lit(grid.width * grid.height / mb))
    return found.select("total_parcels", (F.floor(F.col("total_parcels") / chunk_size) + 1).alias("estimated_chunks"), "raster_size_mb", "parcel_size_mb", (F.col("parcel_size_mb") + F.least(F.col("raster_size_mb"), F.lit(window_mb))).alias("estimated_peak_mb"))


def count_chunks(df: DataFrame, size: int) -> DataFrame:
    return df.withColumn("chunk_id", F.floor(F.col("processing_id") / size))


def grid_chunks(df: DataFrame, size: int) -> DataFrame:
    """A row for each grid cell that a zone's bounds meet (so zones on borders repeat); chunk_id numbers the cells that have any, x before y."""
    total = with_bounds(df)
    box = total.agg(F.count(F.lit(1)).alias("rows"), F.min("min_x").alias("bx0"), F.min("min_y").alias("by0"), F.max("max_x").alias("bx1"), F.max("max_y").alias("by1"))
    side = F.greatest(F.lit(1), F.floor(F.sqrt(F.col("rows") / size)).cast("int"))
    rows = total.crossJoin(F.broadcast(box)).withColumn("side", side)
    step = lambda a, b: (F.col(b) - F.col(a)) / F.col("side")
    # where all bounds share an x or a y, there is one column or row of cells
    place = lambda c, a, b: F.coalesce(F.try_divide(F.col(c) - F.col(a), step(a, b)), F.lit(0.0))
    held = lambda i: F.least(F.greatest(i, F.lit(0)), F.col("side") - 1)
    cell = lambda c, a, b: held(F.floor(place(c, a, b)))
    low = lambda c, a, b: held(F.ceil(place(c, a, b)) - 1)
    cells = rows.withColumn("i", F.explode(F.sequence(low("min_x", "bx0", "bx1"), cell("max_x", "bx0", "bx1")))).withColumn("j", F.explode(F.sequence(low("min_y", "by0", "by1"), cell("max_y", "by0", "by1"))))
    ids = cells.select("i", "j").distinct().withColumn("chunk_id", F.row_number().over(Window.orderBy("i", "j")) - 1)
    return cells.join(ids, ["i", "j"])


def hybrid_plan(sizes: DataFrame, least: int, most: int) -> DataFrame:
    """chunk_id, base and parts, from a row for each grid cell (chunk_id, n): cells over `most` are split into parts, those under `least` join the one before, the first excepted. Running sums over the cells, of which there is one for many zones."""
    order = Window.orderBy("chunk_id")
    own = (F.row_number().over(order) == 1) | (F.col("n") >= least)
    parts = F.when(own & (F.col("n") > most), F.ceil(F.col("n") / most)).otherwise(1)
    rows = sizes.withColumns({"own": own, "parts": parts})
    last = F.sum(F.when(F.col("own"), F.col("parts")).otherwise(0)).over(order) - 1
    return rows.withColumn("last", last).select("chunk_id", F.when(F.col("own"), F.col("last") - F.col("parts") + 1).otherwise(F.col("last")).alias("base"), "parts")


def hybrid_chunks(df: DataFrame, size: int, least: int, most: int, order: str) -> DataFrame:
    cells = grid_chunks(df, size)
    plan = hybrid_plan(cells.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")), least, most)
    place = F.floor((F.row_number().over(Window.partitionBy("chunk_id").orderBy(order)) - 1) / most)
    placed = cells.withColumn("part", place).join(plan, "chunk_id")
    return placed.withColumn("chunk_id", F.col("base") + F.when(F.col("parts") > 1, F.col("part")).otherwise(0)).drop("base", "parts", "part")


def chunks(df: DataFrame, strategy: str = "count", settings: Settings | None = None) -> DataFrame:
    """chunk_id by strategy: count (zones in the order of processing_id), spatial (grid) or hybrid."""
    s = settings or Settings()
    if strategy == "count":
        return count_chunks(df, s.chunk_size)
    if strategy == "spatial":
        return grid_chunks(df, s.chunk_size)
    if strategy == "hybrid":
        return hybrid_chunks(df, s.chunk_size, s.min_chunk, s.max_chunk, "PARCEL_LID")
    raise ValueError(f"unknown strategy: {strategy}")


def chunk_order(df: DataFrame) -> DataFrame:
    """chunk_id, the centre of its zones' bounds (cx, cy), and place: chunks from west to east, then by y. A row for each chunk."""
    box = with_bounds(df).groupBy("chunk_id").agg(((F.min("min_x") + F.max("max_x")) / 2).alias("cx"), ((F.min("min_y") + F.max("max_y")) / 2).alias("cy"))
    return box.withColumn("place", F.row_number().over(Window.orderBy("cx", "cy", "chunk_id")) - 1)


def pending(all_ids: DataFrame, done: DataFrame) -> DataFrame:
    return all_ids.join(done, "chunk_id", "left_anti")


def hashed_order(key: str, seed: int = 42) -> Column:
    """A key's digest with a seed: an order that looks like chance and is the same in every run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))


def sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows, the same ones every time."""
    return df.orderBy(hashed_order(key, seed), key).limit(n)


def stratified(df: DataFrame, n: int, bands: list[tuple[float, float]], column: str, order: Column) -> DataFrame:
    """Up to n // len(bands) rows of each band [low, high), the first by order."""
    band = None
    for i, (low, high) in enumerate(bands):
        hit = (F.col(column) >= low) & (F.col(column) < high)
        band = F.when(hit, i) if band is None else band.when(hit, i)
    rows = df.withColumn("band", band).where(F.col("band").isNotNull())
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy("band").orderBy(order))).where(F.col("__r") <= n // len(bands)).drop("__r")


def boxes_join(zones: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """Zones (with bounds) by boxes that their bounds meet: an equi-join on grid cells, then the exact test."""
    cells = lambda df, a, b, c, d: df.withColumn("gx", F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))).withColumn("gy", F.explode(F.sequence(F.floor(F.col(c) / cell), F.floor(F.col(d) / cell))))
    left = cells(zones, "min_x", "max_x", "min_y", "max_y")
    right = cells(boxes, "c_min_x", "c_max_x", "c_min_y", "c_max_y")
    met = left.join(right, ["gx", "gy"]).where((F.col("max_x") >= F.col("c_min_x")) & (F.col("min_x") <= F.col("c_max_x")) & (F.col("max_y") >= F.col("c_min_y")) & (F.col("min_y") <= F.col("c_max_y")))
    # a pair that meets in several cells stays in the one that holds the lower corner of what both have in common
    corner = lambda a, b: F.floor(F.greatest(a, b) / cell)
    return met.where((F.col("gx") == corner("min_x", "c_min_x")) & (F.col("gy") == corner("min_y", "c_min_y"))).drop("gx", "gy")
