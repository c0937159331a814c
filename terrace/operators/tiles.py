"""The raster as tiles: trow, tcol and vals, the cells of a square of SIDE by SIDE in an array, row by row. Zones meet tiles by their key, so cells travel as arrays, and tiles that no zone is near do not travel at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import NODATA, Grid
from ..functions.geometry import with_bounds

SIDE = 64
#: Blocks a side that near() tells apart; so it broadcasts this number squared of pairs at most, whatever the raster's and the zones' size.
BLOCKS = 256


def is_tiled(raster: DataFrame) -> bool:
    return "vals" in raster.columns


def _key(row: Column, col: Column) -> dict[str, Column]:
    return {"trow": F.floor(row / SIDE), "tcol": F.floor(col / SIDE)}


def _place(row: Column, col: Column) -> Column:
    return (row % SIDE * SIDE + col % SIDE).cast("int")


def tiled(px: DataFrame) -> DataFrame:
    """Tiles of a raster that has a row for each cell (row, col, val; no cell twice). Cells that are missing have no data; tiles without any cell are missing."""
    cells = px.select(*[c.alias(n) for n, c in _key(F.col("row"), F.col("col")).items()], F.struct(_place(F.col("row"), F.col("col")).alias("at"), F.col("val").cast("int").alias("val")).alias("c"))
    found = cells.groupBy("trow", "tcol").agg(F.sort_array(F.collect_list("c")).alias("cs"))
    none = lambda n: F.array_repeat(F.lit(NODATA), n.cast("int"))
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get("cs", F.greatest(i - 1, F.lit(0)))["at"])
    filled = F.flatten(F.transform("cs", lambda c, i: F.concat(none(c["at"] - before(i) - 1), F.array(c["val"]))))
    return found.select("trow", "tcol", F.concat(filled, none(SIDE * SIDE - 1 - F.element_at("cs", -1)["at"])).alias("vals"))


def cells(tiles: DataFrame) -> DataFrame:
    """row, col, val of all cells of tiles."""
    rows = tiles.select("trow", "tcol", F.posexplode("vals").alias("at", "val"))
    return rows.select((F.col("trow") * SIDE + F.floor(F.col("at") / SIDE)).alias("row"), (F.col("tcol") * SIDE + F.col("at") % SIDE).alias("col"), "val")


def near(raster: DataFrame, zones: DataFrame, grid: Grid) -> DataFrame:
    """Tiles (or cells) of the blocks that bounds of zones meet. Blocks are so large that there are at most BLOCKS a side, so the broadcast is bounded, and the raster is cut where it is read."""
    step_r, step_c = (max(1, -(-n // (SIDE * BLOCKS))) for n in (grid.height, grid.width))
    block = lambda low, high, origin, n, step: F.sequence(*[F.floor(F.least(F.greatest((F.col(c) - origin) / grid.cell, F.lit(0)), F.lit(n - 1)) / (SIDE * step)) for c in (low, high)])
    met = with_bounds(zones.select("rings")).where(F.col("min_x").isNotNull())
    met = met.where((F.col("max_x") >= grid.origin_x) & (F.col("min_x") <= grid.origin_x + grid.width * grid.cell) & (F.col("max_y") >= grid.origin_y) & (F.col("min_y") <= grid.origin_y + grid.height * grid.cell))
    met = met.select(F.explode(block("min_y", "max_y", grid.origin_y, grid.height, step_r)).alias("br"), "min_x", "max_x").select("br", F.explode(block("min_x", "max_x", grid.origin_x, grid.width, step_c)).alias("bc")).distinct()
    key = {"trow": F.col("trow"), "tcol": F.col("tcol")} if is_tiled(raster) else _key(F.col("row"), F.col("col"))
    at = raster.withColumns({"br": F.floor(key["trow"] / step_r), "bc": F.floor(key["tcol"] / step_c)})
    return at.join(F.broadcast(met), ["br", "bc"], "left_semi").drop("br", "bc")


def met(covered: DataFrame, raster: DataFrame, zones: DataFrame, grid: Grid, *columns: str) -> DataFrame:
    """zone, columns and val of covered cells (zone, band, row, col) that have data: cells are gathered by zone and tile where they are, and meet their tile once.

    The join is by shuffle: Spark takes covered cells for as small as the file of zones they come from, and would send them all through the driver."""
    cut = near(raster, zones, grid)
    cut = cut if is_tiled(cut) else tiled(cut)
    cell = F.struct(_place(F.col("row"), F.col("col")).alias("at"), *columns)
    held = covered.withColumns(_key(F.col("row"), F.col("col"))).groupBy("zone", "band", "trow", "tcol").agg(F.collect_list(cell).alias("cells"))
    rows = held.hint("merge").join(cut, ["trow", "tcol"]).select("zone", F.explode(F.transform("cells", lambda c: F.struct(*[c[n].alias(n) for n in columns], F.get("vals", c["at"]).alias("val")))).alias("c"))
    return rows.select("zone", "c.*").where(F.col("val") != NODATA)


def window_of(grid: Grid, bounds: tuple[float, float, float, float], pad: int = 2) -> tuple[int, int, int, int]:
    """First row, first column, rows and columns of the cells that bounds (min_x, min_y, max_x, max_y) meet, with pad cells around, cut at the raster's ends; no cell where bounds lie beyond them."""
    x0, y0, x1, y1 = bounds
    out = []
    for low, high, origin, n in ((y0, y1, grid.origin_y, grid.height), (x0, x1, grid.origin_x, grid.width)):
        first = max(0, int((low - origin) / grid.cell) - pad)
        out.append((first, max(0, min(int((high - low) / grid.cell) + 2 * pad + 1, n - first))))
    (row, rows), (col, cols) = out
    return row, col, rows, cols


def read_window(raster: DataFrame, grid: Grid, bounds: tuple[float, float, float, float], pad: int = 2) -> DataFrame:
    """row, col, val of the padded window around bounds. Tiles are chosen by key first, which reaches the scan of a stored raster; only theirs are opened."""
    row, col, rows, cols = window_of(grid, bounds, pad)
    inside = F.col("row").between(row, row + rows - 1) & F.col("col").between(col, col + cols - 1)
    if is_tiled(raster):
        key = lambda c, first, n: F.col(c).between(first // SIDE, (first + n - 1) // SIDE)
        raster = cells(raster.where(key("trow", row, rows) & key("tcol", col, cols)))
    return raster.where(inside).select("row", "col", "val")
