"""Which cells a polygon covers, and how much of each: scanline spans over an edge table.

Edges are dealt out once, by zone and band of rows; crossings, spans and cells of a zone's band are then grouped where they are, without another shuffle. A zone of any size is spread over its bands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Grid
from ..functions.geometry import edges

#: Rows of cells in a band.
BAND = 256


def edge_table(parcels: DataFrame, grid: Grid, n: Column) -> DataFrame:
    """zone, n and edges in raster space (y down, origin at the corner)."""
    e = parcels.select("zone", n.cast("long").alias("n"), F.explode(edges(F.col("rings"))).alias("e"))
    x, y = (lambda c: F.col(c) - grid.origin_x), (lambda c: F.col(c) - grid.origin_y)
    return e.select("zone", "n", x("e.x1").alias("x1"), y("e.y1").alias("y1"), x("e.x2").alias("x2"), y("e.y2").alias("y2"))


def _tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions: edges are few bytes and much work, so their number must not follow from their size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spans(parcels: DataFrame, grid: Grid, n: Column) -> DataFrame:
    """zone, n, band, r (sub-row), a and b: runs [a, b) of sub-cells whose centres lie inside, by the even-odd rule; an edge counts to the right of it.

    Coordinates are scaled by 2n, so centres of sub-cells are odd multiples of the cell size and whole-number input stays exact.
    """
    s = grid.cell
    up = F.col("y1") < F.col("y2")
    low_x, low_y, high_x, high_y = (F.when(up, F.col(a)).otherwise(F.col(b)) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1")))
    scaled = edge_table(parcels, grid, n).where("y1 <> y2").select("zone", "n", *[(c * 2 * F.col("n")).alias(name) for c, name in ((low_x, "xa"), (low_y, "ya"), (high_x, "xb"), (high_y, "yb"))])
    # rows r with ya <= s(2r+1) < yb
    first = F.greatest(F.ceil((F.col("ya") - s) / (2 * s)), F.lit(0))
    last = F.least(F.ceil((F.col("yb") - s) / (2 * s)) - 1, F.lit(grid.height) * F.col("n") - 1)
    per = F.col("n") * BAND
    banded = scaled.withColumns({"r0": first, "r1": last}).where("r0 <= r1").withColumn("band", F.explode(F.sequence(F.floor(F.col("r0") / per), F.floor(F.col("r1") / per)))).repartition(_tasks(parcels), "zone", "band")
    rows = banded.withColumn("r", F.explode(F.sequence(F.greatest(F.col("r0"), F.col("band") * per), F.least(F.col("r1"), (F.col("band") + 1) * per - 1))))
    d = F.col("yb") - F.col("ya")
    num = F.col("xa") * d + (s * (2 * F.col("r") + 1) - F.col("ya")) * (F.col("xb") - F.col("xa"))
    k = F.ceil((num - s * d) / (2 * s * d))
    crossed = rows.select("zone", "n", "band", "r", k.alias("k")).groupBy("zone", "n", "band", "r").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    pair = lambda i: F.struct(F.greatest(F.get("ks", i), F.lit(0)).alias("a"), F.least(F.get("ks", i + 1), F.lit(grid.width) * F.col("n")).alias("b"))
    pairs = F.when(F.size("ks") < 4, F.array(pair(F.lit(0)))).otherwise(F.transform(F.sequence(F.lit(0), (F.size("ks") / 2).cast("int") - 1), lambda i: pair(2 * i)))
    return crossed.where("size(ks) >= 2").select("zone", "n", "band", "r", F.explode(pairs).alias("p")).select("zone", "n", "band", "r", "p.a", "p.b").where("a < b")


def cover(parcels: DataFrame, grid: Grid, n: Column) -> DataFrame:
    """zone, n, band, row, col, hits: sub-cells (of n by n) of the cell whose centres the zone covers; only cells with any."""
    n_ = F.col("n")
    # sub-rows of a cell's row often have equal spans, which are counted before they become cells
    equal = spans(parcels, grid, n).groupBy("zone", "n", "band", F.floor(F.col("r") / n_).alias("row"), "a", "b").agg(F.count(F.lit(1)).alias("times"))
    cells = equal.withColumn("col", F.explode(F.sequence(F.floor(F.col("a") / n_), F.floor((F.col("b") - 1) / n_))))
    hits = F.least(F.col("b"), (F.col("col") + 1) * n_) - F.greatest(F.col("a"), F.col("col") * n_)
    return cells.select("zone", "n", "band", "row", "col", (hits * F.col("times")).alias("hits")).groupBy("zone", "n", "band", "row", "col").agg(F.sum("hits").alias("hits"))


def touched(parcels: DataFrame, grid: Grid) -> DataFrame:
    """zone, band, row, col and centre (is the cell's centre covered?) of the cells whose centre the zone covers or that one of its edges passes; a point belongs to the cell right of and below it.

    Edges are dealt out once; each of their rows gives the cells it passes there and, where it crosses the row's centre line, the place of the crossing.
    """
    s = grid.cell
    e = edge_table(parcels, grid, F.lit(1))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    ranged = e.withColumns({"low": low, "high": high}).withColumns({"r0": F.greatest(F.floor(F.col("low") / s), F.lit(0)), "r1": F.least(F.floor(F.col("high") / s), F.lit(grid.height - 1))}).where("r0 <= r1")
    banded = ranged.withColumn("band", F.explode(F.sequence(F.floor(F.col("r0") / BAND), F.floor(F.col("r1") / BAND)))).repartition(_tasks(parcels), "zone", "band")
    rows = banded.withColumn("row", F.explode(F.sequence(F.greatest(F.col("r0"), F.col("band") * BAND), F.least(F.col("r1"), (F.col("band") + 1) * BAND - 1))))
    rise, way = F.abs(F.col("y2") - F.col("y1")), F.signum(F.col("y2") - F.col("y1"))
    at = lambda y: F.floor((F.col("x1") * rise + way * (y - F.col("y1")) * (F.col("x2") - F.col("x1"))) / (rise * s))
    top, bottom = F.greatest(F.col("low"), F.col("row") * s), F.least(F.col("high"), (F.col("row") + 1) * s)
    flat = F.col("y1") == F.col("y2")
    ca = F.when(flat, F.floor(F.col("x1") / s)).otherwise(at(top))
    cb = F.when(flat, F.floor(F.col("x2") / s)).otherwise(at(bottom))
    passed = F.struct(F.greatest(F.least(ca, cb), F.lit(0)).alias("a"), (F.least(F.greatest(ca, cb), F.lit(grid.width - 1)) + 1).alias("b"))
    # in doubled coordinates, as spans() has them, whole-number input stays exact
    middle = s * (2 * F.col("row") + 1)
    d = 2 * rise
    num = 2 * F.col("x1") * d + way * (middle - 2 * F.col("y1")) * 2 * (F.col("x2") - F.col("x1"))
    crossing = F.when(~flat & (2 * F.col("low") <= middle) & (middle < 2 * F.col("high")), F.ceil((num - s * d) / (2 * s * d)))
    met = rows.select("zone", "band", "row", passed.alias("passed"), crossing.alias("k")).groupBy("zone", "band", "row").agg(F.sort_array(F.collect_list("k")).alias("ks"), F.collect_list("passed").alias("passed"))
    spans = F.transform(F.sequence(F.lit(0), (F.size("ks") / 2).cast("int") - 1), lambda i: F.struct(F.greatest(F.get("ks", 2 * i), F.lit(0)).alias("a"), F.least(F.get("ks", 2 * i + 1), F.lit(grid.width)).alias("b"), F.lit(True).alias("centre")))
    edges_ = F.transform("passed", lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), F.lit(False).alias("centre")))
    runs = met.select("zone", "band", "row", F.explode(F.concat(F.when(F.size("ks") >= 2, spans).otherwise(F.slice(spans, 1, 0)), edges_)).alias("p")).select("zone", "band", "row", "p.*").where("a < b")
    return runs.select("zone", "band", "row", "centre", F.explode(F.sequence(F.col("a"), F.col("b") - 1)).alias("col")).groupBy("zone", "band", "row", "col").agg(F.max("centre").alias("centre"))
