"""Queries over the derived zones and raster, and their SQL for an independent check: centre tests of every sub-cell instead of spans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import CLASSES, PERCENTS
from ..functions.geometry import acres, albers, area, with_bounds
from ..functions import wkb
from ..operators import analysis, comparing, joining, preparing, repairing, tiles, zonal
from ..sources import derived

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# ---- SQL pieces
PARCELS = """
g AS (SELECT CAST(ceil(count(*) / 120.0) AS BIGINT) AS H FROM orders),
px AS (SELECT o_orderkey // 120 AS "row", o_orderkey % 120 AS col, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 97 = 0 THEN 6 ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS val FROM orders),
p0 AS (SELECT p_partkey AS k, 'P' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS zone, [12, 50, 110, 170, 350, 500][p_partkey % 6 + 1] AS w,
       (p_partkey * 37) % 120 * 30 + p_partkey % 30 AS x, (p_partkey * 61) % H * 30 + (p_partkey * 7) % 30 AS y, (p_partkey // 6) % 4 AS shape FROM part, g),
p1 AS (SELECT *, w // 2 AS h, w // 4 AS q FROM p0),
p2 AS (SELECT k, zone, w, x, y, shape,
       CASE shape WHEN 0 THEN [[[x, y], [x + w, y], [x + w, y + w], [x, y + w]]]
                  WHEN 1 THEN [[[x, y], [x + w, y], [x, y + w]]]
                  WHEN 2 THEN [[[x, y], [x + w, y], [x + w, y + h], [x + h, y + h], [x + h, y + w], [x, y + w]]]
                  ELSE [[[x, y], [x + w, y], [x + w, y + w], [x, y + w]], [[x + q, y + q], [x + h, y + q], [x + h, y + h], [x + q, y + h]]] END AS rings,
       CASE shape WHEN 0 THEN w * w WHEN 1 THEN w * w / 2.0 WHEN 2 THEN w * h + (w - h) * h ELSE w * w - (h - q) * (h - q) END AS area FROM p1),
parcels AS (SELECT *, CASE WHEN k % 50 = 0 THEN NULL WHEN k % 53 = 1 THEN 0.0 ELSE area / 4046.86 * (1 + (k % 21 - 10) / 1000.0) END AS cal FROM p2),
sized AS (SELECT *, CASE WHEN cal IS NULL THEN 10 WHEN cal < 0.22 THEN 10 WHEN cal < 1 THEN 7 WHEN cal < 10 THEN 5 WHEN cal < 50 THEN 7 ELSE 10 END AS tier FROM parcels),
ring AS (SELECT zone, unnest(rings) AS pts FROM parcels),
edge AS (SELECT zone, pts[i][1] AS x1, pts[i][2] AS y1, pts[i % len(pts) + 1][1] AS x2, pts[i % len(pts) + 1][2] AS y2 FROM (SELECT zone, pts, unnest(range(1, len(pts) + 1)) AS i FROM ring))
"""


def sub_cells(n: str) -> str:
    """hit(zone, n, row, col, hits): for each sub-cell centre in a zone's bounds, an odd number of edges to its left."""
    return f"""
z AS (SELECT zone, {n} AS n, x, y, w FROM sized),
c AS (SELECT zone, n, unnest(range(greatest(0, x * n // 30 - 1), least(120 * n, (x + w) * n // 30 + 2))) AS cx, y, w FROM z),
cc AS (SELECT zone, n, cx, unnest(range(greatest(0, y * n // 30 - 1), least(H * n, (y + w) * n // 30 + 2))) AS cy FROM c, g),
odd AS (SELECT cc.zone, n, cx, cy FROM cc JOIN edge e ON cc.zone = e.zone AND (2 * n * e.y1 <= 30 * (2 * cy + 1)) <> (2 * n * e.y2 <= 30 * (2 * cy + 1))
        WHERE CASE WHEN e.y2 > e.y1 THEN 30 * (2 * cx + 1) * 2 * n * (e.y2 - e.y1) >= 2 * n * e.x1 * 2 * n * (e.y2 - e.y1) + (30 * (2 * cy + 1) - 2 * n * e.y1) * 2 * n * (e.x2 - e.x1)
                   ELSE 30 * (2 * cx + 1) * 2 * n * (e.y1 - e.y2) >= 2 * n * e.x1 * 2 * n * (e.y1 - e.y2) - (30 * (2 * cy + 1) - 2 * n * e.y1) * 2 * n * (e.x2 - e.x1) END
        GROUP BY ALL HAVING count(*) % 2 = 1),
hit AS (SELECT zone, n, cy // n AS "row", cx // n AS col, count(*) AS hits FROM odd GROUP BY ALL)
"""


TOUCHED = """
band AS (SELECT e.*, unnest(range(greatest(0, least(y1, y2) // 30), least(H - 1, greatest(y1, y2) // 30) + 1)) AS r FROM edge e, g),
ends AS (SELECT *, greatest(least(y1, y2), r * 30) AS ya, least(greatest(y1, y2), (r + 1) * 30) AS yb FROM band),
cols AS (SELECT zone, r, CASE WHEN y1 = y2 THEN x1 // 30 WHEN y2 > y1 THEN (x1 * (y2 - y1) + (ya - y1) * (x2 - x1)) // ((y2 - y1) * 30) ELSE (x1 * (y1 - y2) - (ya - y1) * (x2 - x1)) // ((y1 - y2) * 30) END AS ca,
         CASE WHEN y1 = y2 THEN x2 // 30 WHEN y2 > y1 THEN (x1 * (y2 - y1) + (yb - y1) * (x2 - x1)) // ((y2 - y1) * 30) ELSE (x1 * (y1 - y2) - (yb - y1) * (x2 - x1)) // ((y1 - y2) * 30) END AS cb FROM ends),
touch AS (SELECT zone, r AS "row", unnest(range(greatest(0, least(ca, cb)), least(119, greatest(ca, cb)) + 1)) AS col, 1 AS hits, 1 AS n FROM cols UNION SELECT zone, "row", col, 1, 1 FROM hit)
"""


def results(source: str, mapped: bool) -> str:
    """res: the result columns of a zonal run."""
    keep = "val BETWEEN 1 AND 5" if mapped else "TRUE"
    pct = ", ".join(f"CASE WHEN total > 0 THEN coalesce(h{k}, 0) * 100.0 / total ELSE 0.0 END AS {p}" for k, p in zip(CLASSES, PERCENTS, strict=True))
    return f"""
cls AS (SELECT h.zone, max(n) AS n, val, sum(h.hits) AS hits FROM {source} h JOIN px ON h."row" = px."row" AND h.col = px.col WHERE val <> 0 GROUP BY h.zone, val),
tot AS (SELECT zone, sum(hits) AS all_hits, sum(hits) FILTER ({keep}) AS total, {", ".join(f"sum(hits) FILTER (val = {k}) AS h{k}" for k in CLASSES)} FROM cls GROUP BY zone),
top AS (SELECT zone, val FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY hits DESC, (val BETWEEN 1 AND 5) DESC, val) AS r FROM cls WHERE {keep}) WHERE r = 1),
res AS (SELECT s.k, s.zone AS PARCEL_LID, s.cal AS CAL_ACREAGE, s.area, {pct},
        CASE WHEN total > 0 THEN CASE top.val WHEN 1 THEN 'AGRICULTURE' WHEN 2 THEN 'DEVELOPED' WHEN 3 THEN 'FOREST' WHEN 4 THEN 'OTHER' WHEN 5 THEN 'RANGELAND_PASTURE' ELSE 'CLASS_' || top.val END ELSE 'NO_DATA' END AS majority_land_use,
        CASE WHEN total > 0 THEN CAST(total AS DOUBLE) / (z1.n * z1.n) ELSE 0.0 END AS total_pixels,
        coalesce(CAST(all_hits AS DOUBLE) / (z1.n * z1.n) * 900 / 4046.86, 0.0) AS calculated_acres, s.tier
        FROM sized s LEFT JOIN tot ON s.zone = tot.zone LEFT JOIN top ON s.zone = top.zone LEFT JOIN (SELECT zone, max(n) AS n FROM cls GROUP BY zone) z1 ON s.zone = z1.zone)
"""


SHOWN = ", ".join(f"round({p}, 6) AS {p}" for p in PERCENTS) + ", majority_land_use, round(total_pixels, 6) AS total_pixels, round(calculated_acres, 6) AS calculated_acres"
SUB = f"WITH {PARCELS}, {sub_cells('tier')}, {results('hit', False)}"
CENTER = f"WITH {PARCELS}, {sub_cells('1')}, {results('hit', True)}"
STANDARD = f"WITH {PARCELS}, {sub_cells('1')}, {TOUCHED}, {results('touch', True)}"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def given(spark: SparkSession, d: str):
    grid = derived.grid_of(spark, d)
    return grid, derived.raster(spark, d), derived.parcels(spark, d, grid)


def run(spark: SparkSession, d: str, method: str) -> DataFrame:
    grid, px, zones = given(spark, d)
    return zonal.zonal(zones, px, grid, method)


def shown(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("PARCEL_LID", *[F.round(p, 6).alias(p) for p in PERCENTS], "majority_land_use", F.round("total_pixels", 6).alias("total_pixels"), F.round("calculated_acres", 6).alias("calculated_acres"), *more)


# ---- zonal
@query(f"{SUB} SELECT PARCEL_LID, {SHOWN}, tier AS subpixel_resolution FROM res")
def zonal_subpixel(spark, d):
    return shown(run(spark, d, "subpixel"), "subpixel_resolution")


@query(f"{CENTER} SELECT PARCEL_LID, {SHOWN} FROM res")
def zonal_center(spark, d):
    return shown(run(spark, d, "center"))


@query(f"{STANDARD} SELECT PARCEL_LID, {SHOWN} FROM res")
def zonal_standard(spark, d):
    return shown(run(spark, d, "standard"))


def _fixed(n: int):
    @query(f"WITH {PARCELS}, {sub_cells(str(n))} SELECT s.zone AS PARCEL_LID, round(coalesce(sum(hits), 0) / {n * n}.0, 6) AS pixels FROM sized s LEFT JOIN hit ON s.zone = hit.zone GROUP BY s.zone")
    def fixed(spark, d):
        grid, _, zones = given(spark, d)
        return zonal.fixed_acres(zones, grid, n).select(F.col("zone").alias("PARCEL_LID"), F.round("pixels", 6).alias("pixels"))

    for table in (QUERIES, ORACLE):
        table[f"subpixel_fixed_{n}"] = table.pop("fixed")


for _n in (2, 5, 10):
    _fixed(_n)


@query(f"WITH {PARCELS}, {sub_cells('5')}, {results('hit', True)} SELECT PARCEL_LID, {SHOWN} FROM res")
def subpixel5_mapped(spark, d):
    grid, px, zones = given(spark, d)
    hits = zonal.class_hits(zonal.cover(zones, grid, F.lit(5)), px, zones, grid)
    return shown(zonal.summary(zones.drop("rings"), hits, F.lit(25), grid, mapped_only=True))


@query(f"""WITH {PARCELS}, {sub_cells('1')}, {TOUCHED},
a AS (SELECT zone, count(*) AS t FROM touch JOIN px ON touch."row" = px."row" AND touch.col = px.col WHERE val <> 0 GROUP BY zone),
b AS (SELECT zone, count(*) AS c FROM hit JOIN px ON hit."row" = px."row" AND hit.col = px.col WHERE val <> 0 GROUP BY zone)
SELECT s.zone AS PARCEL_LID, coalesce(t, 0) AS touched, coalesce(c, 0) AS centre, round(coalesce(t, 0) * (1 - w) + coalesce(c, 0) * w, 6) AS weighted
FROM (SELECT zone, CASE WHEN coalesce(cal, 1.0) < 900 / 4046.86 THEN 0.8 WHEN coalesce(cal, 1.0) < 1800 / 4046.86 THEN 0.5 ELSE 0.2 END AS w FROM sized) s LEFT JOIN a ON s.zone = a.zone LEFT JOIN b ON s.zone = b.zone""")
def weighted_count(spark, d):
    grid, px, zones = given(spark, d)
    return zonal.weighted_count(zones, px, grid).select(F.col("zone").alias("PARCEL_LID"), "touched", "centre", F.round("weighted", 6).alias("weighted"))


@query(f"WITH {PARCELS} SELECT zone AS PARCEL_LID, tier AS n FROM sized")
def adaptive_resolution(spark, d):
    return given(spark, d)[2].select("PARCEL_LID", zonal.resolution(F.col("CAL_ACREAGE")).alias("n"))


@query(f"{SUB} SELECT PARCEL_LID, round(CASE WHEN calculated_acres > 0 THEN calculated_acres - CAL_ACREAGE END, 6) AS acre_diff, round(CASE WHEN calculated_acres > 0 AND CAL_ACREAGE <> 0 THEN (calculated_acres - CAL_ACREAGE) / CAL_ACREAGE * 100 END, 6) AS acre_diff_pct, CAL_ACREAGE = 0 AND calculated_acres > 0 AS endless FROM res")
def acre_diff(spark, d):
    endless = F.abs("acre_diff_pct") == float("inf")
    return run(spark, d, "subpixel").select("PARCEL_LID", F.round("acre_diff", 6).alias("acre_diff"), F.round(F.when(~endless, F.col("acre_diff_pct")), 6).alias("acre_diff_pct"), ((F.col("CAL_ACREAGE") == 0) & (F.col("calculated_acres") > 0)).alias("endless"))


@query(f"{SUB} SELECT PARCEL_LID, majority_land_use FROM res")
def majority_class(spark, d):
    return run(spark, d, "subpixel").select("PARCEL_LID", "majority_land_use")


VALID = "round(" + " + ".join(PERCENTS) + ", 6) AS proportion_sum, NOT (abs(" + " + ".join(PERCENTS) + " - 100) > 0.1 AND total_pixels > 0) AND NOT total_pixels < 0.001 AS is_valid"


@query(f"{SUB} SELECT PARCEL_LID, {VALID} FROM res")
def validate_results(spark, d):
    return zonal.validate(run(spark, d, "subpixel")).select("PARCEL_LID", F.round("proportion_sum", 6).alias("proportion_sum"), "is_valid")


# ---- raster
@query(f"WITH {PARCELS} SELECT DISTINCT val FROM px")
def raster_distinct(spark, d):
    return derived.raster(spark, d).select("val").distinct()


@query(f"WITH {PARCELS} SELECT val, count(*) AS n FROM px GROUP BY val")
def raster_histogram(spark, d):
    return analysis.histogram(derived.raster(spark, d))


@query(f'WITH {PARCELS} SELECT "row", col, val FROM px WHERE "row" BETWEEN 2 AND 8 AND col BETWEEN 10 AND 40')
def raster_window_read(spark, d):
    """Two cells around the bounds."""
    return tiles.read_window(tiles.tiled(derived.raster(spark, d)), derived.grid_of(spark, d), (360, 120, 1140, 180), pad=2)


@query(f"""WITH {PARCELS}, c AS (SELECT ['DEVELOPED', 'AGRICULTURE', 'RANGELAND_PASTURE', 'FOREST', 'OTHER', 'OTHER', 'OTHER', 'DEVELOPED', 'FOREST', 'RANGELAND_PASTURE', 'AGRICULTURE', 'AGRICULTURE', 'OTHER', 'OTHER', 'OTHER'][val] AS class, count(*) AS cells FROM px WHERE val BETWEEN 1 AND 15 GROUP BY 1)
SELECT class, cells, round(cells * 900.0 / 4046.86, 4) AS acres, round(cells * 100.0 / sum(cells) OVER (), 6) AS pct FROM c""")
def class_remap_acres(spark, d):
    return analysis.class_acres(derived.raster(spark, d), analysis.REMAP, derived.grid_of(spark, d))


@query(f"WITH {PARCELS} SELECT val, count(*) AS n FROM px WHERE val > 15 GROUP BY val")
def class_remap_unmapped(spark, d):
    return analysis.unmapped(derived.raster(spark, d), analysis.REMAP)


@query(f"""WITH {PARCELS} SELECT val, count(*) AS n FROM px WHERE val <> 0 AND "row" * 30 + 15 < (SELECT H FROM g) * 6 AND col * 30 + 15 >= 720 AND col * 30 + 15 < 1440 GROUP BY val""")
def masked_histogram(spark, d):
    grid = derived.grid_of(spark, d)
    box = derived.counties(spark, d, grid).where("c_min_x = 720 and c_min_y = 0")
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("c_min_x", "c_min_y"), ("c_max_x", "c_min_y"), ("c_max_x", "c_max_y"), ("c_min_x", "c_max_y"))])
    zone = box.select(F.col("NAME").alias("zone"), F.array(ring).alias("rings"))
    return zonal.class_hits(zonal.cover(zone, grid, F.lit(1)), derived.raster(spark, d), zone, grid).select("val", F.col("hits").alias("n"))


# ---- zones
@query(f"""WITH {PARCELS} SELECT zone AS PARCEL_LID, CAST(area AS DOUBLE) AS area_m2, round(area / 4046.86, 6) AS acres, CAST(x AS DOUBLE) AS min_x, CAST(y AS DOUBLE) AS min_y, CAST(x + w AS DOUBLE) AS max_x, CAST(y + w AS DOUBLE) AS max_y FROM parcels""")
def parcel_area_bounds(spark, d):
    return with_bounds(given(spark, d)[2]).select("PARCEL_LID", area(F.col("rings")).alias("area_m2"), F.round(acres(F.col("rings")), 6).alias("acres"), "min_x", "min_y", "max_x", "max_y")


@query(f"WITH {PARCELS} SELECT zone AS PARCEL_LID, CAST(area AS DOUBLE) AS area_m2 FROM parcels WHERE area >= 2500 AND area <= 100000")
def filter_by_area(spark, d):
    return preparing.filter_by_area(given(spark, d)[2], 2500, 100000).select("PARCEL_LID", "area_m2")


@query(f"WITH {PARCELS} SELECT zone AS PARCEL_LID FROM parcels, g WHERE NOT (k % 10 = 9) AND x <= 3600 AND y <= H * 30")
def clip_to_extent(spark, d):
    grid, _, zones = given(spark, d)
    far = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + F.when(F.col("k") % 10 == 9, 100000.0).otherwise(0.0)).alias("x"), p["y"].alias("y"))))
    return preparing.clip(zones.withColumn("rings", far), 0, 0, grid.width * grid.cell, grid.height * grid.cell).select("PARCEL_LID")


@query(f"""WITH {PARCELS}, b AS (SELECT 900.0 AS x0, 120.0 AS y0, 1800.0 AS x1, 240.0 AS y1),
c AS (SELECT unnest([x0, x1, x1, x0]) AS cx, unnest([y0, y0, y1, y1]) AS cy, unnest([x1, x1, x0, x0]) AS dx, unnest([y0, y1, y1, y0]) AS dy FROM b),
ends AS (SELECT zone FROM edge, b WHERE greatest(b.x0 - edge.x1, edge.x1 - b.x1, 0) ** 2 + greatest(b.y0 - edge.y1, edge.y1 - b.y1, 0) ** 2 <= 10000),
t AS (SELECT zone, e.x1, e.y1, e.x2 - e.x1 AS ux, e.y2 - e.y1 AS uy, cx, cy, least(1, greatest(0, ((cx - e.x1) * (e.x2 - e.x1) + (cy - e.y1) * (e.y2 - e.y1)) / CAST((e.x2 - e.x1) ** 2 + (e.y2 - e.y1) ** 2 AS DOUBLE))) AS s FROM edge e, c),
corners AS (SELECT zone FROM t WHERE (x1 + s * ux - cx) ** 2 + (y1 + s * uy - cy) ** 2 <= 10000),
across AS (SELECT zone FROM edge e, c WHERE sign((e.x2 - e.x1) * (cy - e.y1) - (e.y2 - e.y1) * (cx - e.x1)) * sign((e.x2 - e.x1) * (dy - e.y1) - (e.y2 - e.y1) * (dx - e.x1)) <= 0 AND sign((dx - cx) * (e.y1 - cy) - (dy - cy) * (e.x1 - cx)) * sign((dx - cx) * (e.y2 - cy) - (dy - cy) * (e.x2 - cx)) <= 0 AND least(e.x1, e.x2) <= greatest(cx, dx) AND least(cx, dx) <= greatest(e.x1, e.x2) AND least(e.y1, e.y2) <= greatest(cy, dy) AND least(cy, dy) <= greatest(e.y1, e.y2)),
around AS (SELECT zone FROM edge e, b WHERE (e.y1 <= b.y0) <> (e.y2 <= b.y0) AND e.x1 + (b.y0 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) <= b.x0 GROUP BY zone HAVING count(*) % 2 = 1)
SELECT zone AS PARCEL_LID FROM (SELECT zone FROM ends UNION SELECT zone FROM corners UNION SELECT zone FROM across UNION SELECT zone FROM around)""")
def clip_with_buffer(spark, d):
    return preparing.clip(given(spark, d)[2], 900, 120, 1800, 240, buffer=100).select("PARCEL_LID")


@query(f"WITH {PARCELS} SELECT count_if(k % 40 = 3) AS n_null, count_if(k % 40 = 7) AS n_empty, count_if(k % 40 = 11) AS n_invalid, count_if(k % 40 NOT IN (3, 7, 11)) AS n_valid FROM parcels")
def geometry_validation_counts(spark, d):
    zones = given(spark, d)[2]
    square = F.get("rings", F.lit(0))
    x0, y0, w = square[0]["x"], square[0]["y"], F.array_max(F.transform(square, lambda p: p["x"])) - square[0]["x"]
    at = lambda a, b: F.struct((x0 + a * w).alias("x"), (y0 + b * w).alias("y"))
    bow = F.array(F.array(at(0, 0), at(1, 1), at(1, 0), at(0, 1)))
    bad = F.when(F.col("k") % 40 == 3, None).when(F.col("k") % 40 == 7, F.array().cast(zones.schema["rings"].dataType)).when(F.col("k") % 40 == 11, bow).otherwise(F.col("rings"))
    return preparing.validity(zones.withColumn("rings", bad))


@query(f"""WITH {PARCELS} SELECT zone AS PARCEL_LID, CASE WHEN k % 8 IN (3, 5) OR shape = 3 THEN 2 ELSE 1 END AS n_rings, round(CASE k % 8 WHEN 3 THEN w * w / 2.0 WHEN 5 THEN w * w * 1.5 ELSE area END, 3) AS area_m2 FROM parcels WHERE k % 40 NOT IN (7, 15)""")
def repair_geometries(spark, d):
    """Some zones are bow ties, some two squares over each other, some null or empty."""
    zones = given(spark, d)[2]
    first = F.get("rings", F.lit(0))
    x0, y0, w = first[0]["x"], first[0]["y"], F.array_max(F.transform(first, lambda p: p["x"])) - first[0]["x"]
    at = lambda a, b: F.struct((x0 + a * w).alias("x"), (y0 + b * w).alias("y"))
    square = lambda a: F.array(at(a, a), at(a + 1, a), at(a + 1, a + 1), at(a, a + 1))
    bow, two = F.array(F.array(at(0, 0), at(1, 1), at(1, 0), at(0, 1))), F.array(square(0), square(0.5))
    k, empty = F.col("k"), F.array().cast(zones.schema["rings"].dataType)
    broken = F.when(k % 40 == 7, None).when(k % 40 == 15, empty).when(k % 8 == 3, bow).when(k % 8 == 5, two).otherwise(F.col("rings"))
    return repairing.repair(zones.withColumn("rings", broken)).select("PARCEL_LID", F.size("rings").alias("n_rings"), F.round(area(F.col("rings")), 3).alias("area_m2"))


@query(f"WITH {PARCELS} SELECT zone AS PARCEL_LID, row_number() OVER (ORDER BY zone) - 1 AS processing_id FROM parcels")
def processing_id(spark, d):
    return preparing.numbered(given(spark, d)[2], "k").select("PARCEL_LID", "processing_id")


@query("""WITH c AS (SELECT c_custkey, -124 + (c_custkey % 500) / 100.0 AS lon, 42 + (c_custkey // 500) / 10.0 AS lat, sqrt((1 / 298.257222101) * (2 - 1 / 298.257222101)) AS e FROM customer),
q AS (SELECT *, (1 - e * e) * (sin(radians(lat)) / (1 - e * e * sin(radians(lat)) ** 2) - ln((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat)))) / (2 * e)) AS q FROM c),
r AS (SELECT *, 6378137.0 * sqrt(1.3491820315609704 - 0.6029027690657601 * q) / 0.6029027690657601 AS rho, 0.6029027690657601 * radians(lon + 96) AS theta FROM q)
SELECT c_custkey, round(rho * sin(theta), 3) AS x, round(9928937.004248781 - rho * cos(theta), 3) AS y FROM r""")
def reproject_albers(spark, d):
    key = F.col("c_custkey")
    x, y = albers(-124 + key % 500 / 100.0, 42 + F.floor(key / 500) / 10.0)
    return derived.table(spark, d, "customer").select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query(f"""WITH {PARCELS}, s AS (SELECT count(*) AS n, sum([4, 3, 6, 8][shape + 1]) * 16 / 1048576.0 AS mb, (SELECT H FROM g) * 120 / 1048576.0 AS r FROM parcels)
SELECT n AS total_parcels, n // 5000 + 1 AS estimated_chunks, round(r, 6) AS raster_size_mb, round(mb, 6) AS parcel_size_mb, round(mb + least(1000, r), 6) AS estimated_peak_mb FROM s""")
def estimate_requirements(spark, d):
    grid, _, zones = given(spark, d)
    rows = preparing.requirements(zones, grid)
    return rows.select("total_parcels", "estimated_chunks", *[F.round(c, 6).alias(c) for c in ("raster_size_mb", "parcel_size_mb", "estimated_peak_mb")])


@query(f"WITH {PARCELS}, d AS (SELECT zone, k FROM parcels UNION ALL SELECT zone, k FROM parcels WHERE k % 101 = 0) SELECT zone AS PARCEL_LID, min(k) AS k FROM d GROUP BY zone")
def dedup_keep_first(spark, d):
    zones = given(spark, d)[2]
    return preparing.keep_first(zones.unionByName(zones.where("k % 101 = 0")), "PARCEL_LID", "k").select("PARCEL_LID", "k")


@query(f"{SUB}, d AS (SELECT zone AS PARCEL_LID FROM parcels UNION ALL SELECT zone FROM parcels WHERE k % 101 = 0) SELECT PARCEL_LID, majority_land_use FROM d JOIN res USING (PARCEL_LID)")
def geometry_join(spark, d):
    zones = given(spark, d)[2]
    twice = zones.unionByName(zones.where("k % 101 = 0")).select("PARCEL_LID", "rings")
    # by shuffle: the planner takes zones for as small as their file, and would send them all through the driver
    return twice.hint("merge").join(run(spark, d, "subpixel").select("PARCEL_LID", "majority_land_use"), "PARCEL_LID").select("PARCEL_LID", "majority_land_use")


@query(f"""WITH {PARCELS}, n AS (SELECT n_name AS NAME, n_nationkey % 5 * 720 AS ax, n_nationkey // 5 * (SELECT H FROM g) * 6 AS ay FROM nation)
SELECT zone AS PARCEL_LID, NAME FROM parcels JOIN n ON x + w >= ax AND x <= ax + 720 AND y + w >= ay AND y <= ay + (SELECT H FROM g) * 6""")
def county_spatial_join(spark, d):
    grid, _, zones = given(spark, d)
    return preparing.boxes_join(with_bounds(zones), derived.counties(spark, d, grid), 720.0).select("PARCEL_LID", "NAME")


#: Every pair of edges, and every first point against all edges, of zones and districts whose bounds meet.
DISTRICTS = f"""{PARCELS},
n0 AS (SELECT n_name AS NAME, n_nationkey % 3 AS turn, n_nationkey % 5 * 720 AS ax, n_nationkey // 5 * H * 6 AS ay, 120 AS u, H AS v FROM nation, g),
n1 AS (SELECT *, CASE turn WHEN 0 THEN [[[ax, ay], [ax + 6 * u, ay], [ax + 6 * u, ay + 6 * v], [ax, ay + 6 * v]]]
                           WHEN 1 THEN [[[ax, ay], [ax + 6 * u, ay], [ax + 6 * u, ay + 3 * v], [ax + 3 * u, ay + 3 * v], [ax + 3 * u, ay + 6 * v], [ax, ay + 6 * v]]]
                           ELSE [[[ax, ay], [ax + 6 * u, ay], [ax + 6 * u, ay + 6 * v], [ax, ay + 6 * v]], [[ax + 2 * u, ay + 2 * v], [ax + 4 * u, ay + 2 * v], [ax + 4 * u, ay + 4 * v], [ax + 2 * u, ay + 4 * v]]] END AS rings FROM n0),
dring AS (SELECT NAME, unnest(rings) AS pts FROM n1),
dedge AS (SELECT NAME, pts[i][1] AS x1, pts[i][2] AS y1, pts[i % len(pts) + 1][1] AS x2, pts[i % len(pts) + 1][2] AS y2 FROM (SELECT NAME, pts, unnest(range(1, len(pts) + 1)) AS i FROM dring)),
pair AS (SELECT zone, NAME FROM parcels JOIN n1 ON x + w >= ax AND x <= ax + 6 * u AND y + w >= ay AND y <= ay + 6 * v),
ef AS (SELECT p.zone, p.NAME, e.x1, e.y1, e.x2, e.y2, f.x1 AS u1, f.y1 AS v1, f.x2 AS u2, f.y2 AS v2 FROM pair p JOIN edge e ON p.zone = e.zone JOIN dedge f ON p.NAME = f.NAME),
crossed AS (SELECT zone, NAME FROM ef WHERE least(x1, x2) <= greatest(u1, u2) AND least(u1, u2) <= greatest(x1, x2) AND least(y1, y2) <= greatest(v1, v2) AND least(v1, v2) <= greatest(y1, y2)
            AND sign((x2 - x1) * (v1 - y1) - (y2 - y1) * (u1 - x1)) * sign((x2 - x1) * (v2 - y1) - (y2 - y1) * (u2 - x1)) <= 0 AND sign((u2 - u1) * (y1 - v1) - (v2 - v1) * (x1 - u1)) * sign((u2 - u1) * (y2 - v1) - (v2 - v1) * (x2 - u1)) <= 0),
zin AS (SELECT p.zone, p.NAME, r.pts FROM pair p JOIN ring r ON p.zone = r.zone JOIN dedge f ON p.NAME = f.NAME WHERE (f.y1 <= r.pts[1][2]) <> (f.y2 <= r.pts[1][2]) AND f.x1 + (r.pts[1][2] - f.y1) * (f.x2 - f.x1) / (f.y2 - f.y1) <= r.pts[1][1] GROUP BY ALL HAVING count(*) % 2 = 1),
din AS (SELECT p.zone, p.NAME, r.pts FROM pair p JOIN dring r ON p.NAME = r.NAME JOIN edge f ON p.zone = f.zone WHERE (f.y1 <= r.pts[1][2]) <> (f.y2 <= r.pts[1][2]) AND f.x1 + (r.pts[1][2] - f.y1) * (f.x2 - f.x1) / (f.y2 - f.y1) <= r.pts[1][1] GROUP BY ALL HAVING count(*) % 2 = 1),
meets AS (SELECT zone, NAME FROM crossed UNION SELECT zone, NAME FROM zin UNION SELECT zone, NAME FROM din)"""


@query(f"WITH {DISTRICTS} SELECT zone AS PARCEL_LID, NAME FROM meets")
def district_polygon_join(spark, d):
    grid, _, zones = given(spark, d)
    return joining.intersecting(zones, derived.districts(spark, d, grid), "PARCEL_LID", "NAME")


@query(f"WITH {DISTRICTS} SELECT m.zone AS PARCEL_LID, CAST(area AS DOUBLE) AS area_m2 FROM meets m JOIN parcels p ON m.zone = p.zone WHERE NAME = (SELECT n_name FROM nation WHERE n_nationkey = 7)")
def zones_of_a_district(spark, d):
    """Zones of one boundary that is looked up by its columns, as for a sample of a county."""
    grid, _, zones = given(spark, d)
    name = derived.table(spark, d, "nation").where("n_nationkey = 7").first()["n_name"]
    one = joining.boundary(derived.districts(spark, d, grid), NAME=name)
    return zones.join(joining.intersecting(zones, one, "PARCEL_LID", "NAME"), "PARCEL_LID").select("PARCEL_LID", area(F.col("rings")).alias("area_m2"))


@query(f"WITH {PARCELS} SELECT zone AS PARCEL_LID, CAST(area AS DOUBLE) AS area_m2 FROM parcels ORDER BY area, zone LIMIT 50")
def smallest_k(spark, d):
    return given(spark, d)[2].select("PARCEL_LID", area(F.col("rings")).alias("area_m2")).orderBy("area_m2", "PARCEL_LID").limit(50)


@query(f"{SUB} SELECT PARCEL_LID, round(abs(calculated_acres - CAL_ACREAGE) / CAL_ACREAGE * 100, 6) AS off_pct FROM res WHERE CAL_ACREAGE <> 0 AND calculated_acres > 0 ORDER BY off_pct DESC, PARCEL_LID LIMIT 10")
def largest_diff_k(spark, d):
    """By percent; infinite ones (no acreage) are left out."""
    finite = F.abs("acre_diff_pct") < float("inf")
    return run(spark, d, "subpixel").where(finite).select("PARCEL_LID", F.round(F.abs("acre_diff_pct"), 6).alias("off_pct")).orderBy(F.desc("off_pct"), "PARCEL_LID").limit(10)


@query(f"""WITH {PARCELS}, b AS (SELECT zone, CASE WHEN cal >= 0.1 AND cal < 0.5 THEN 0 WHEN cal >= 0.5 AND cal < 2 THEN 1 WHEN cal >= 2 AND cal < 10 THEN 2 END AS band FROM parcels)
SELECT zone AS PARCEL_LID, band FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY md5('42:' || zone), zone) AS r FROM b WHERE band IS NOT NULL) WHERE r <= 66""")
def stratified_sample(spark, d):
    return preparing.stratified(given(spark, d)[2], 200, [(0.1, 0.5), (0.5, 2), (2, 10)], "CAL_ACREAGE", preparing.hashed_order("PARCEL_LID")).select("PARCEL_LID", "band")


@query(f"WITH {PARCELS} SELECT zone AS PARCEL_LID FROM parcels ORDER BY md5('42:' || zone), zone LIMIT 100")
def sample_n(spark, d):
    return preparing.sample(given(spark, d)[2], 100, "PARCEL_LID").select("PARCEL_LID")


# ---- chunks
@query(f"WITH {PARCELS} SELECT zone AS PARCEL_LID, (row_number() OVER (ORDER BY zone) - 1) // 300 AS chunk_id FROM parcels")
def chunk_count(spark, d):
    return preparing.count_chunks(preparing.numbered(given(spark, d)[2], "k"), 300).select("PARCEL_LID", "chunk_id")


def _grid(size: int) -> str:
    return f"""WITH {PARCELS}, t AS (SELECT greatest(1, CAST(floor(sqrt(count(*) / {size})) AS INTEGER)) AS side, min(x) AS x0, min(y) AS y0, max(x + w) AS x1, max(y + w) AS y1 FROM parcels),
ij AS (SELECT side, x0, y0, (x1 - x0) / side AS dx, (y1 - y0) / side AS dy, i, unnest(range(side)) AS j FROM (SELECT *, unnest(range(side)) AS i FROM t)),
m AS (SELECT zone, i, j FROM parcels JOIN ij ON x + w >= x0 + i * dx AND x <= x0 + (i + 1) * dx AND y + w >= y0 + j * dy AND y <= y0 + (j + 1) * dy),
cells AS (SELECT zone, dense_rank() OVER (ORDER BY i, j) - 1 AS chunk FROM m)"""


@query(f"{_grid(300)} SELECT zone AS PARCEL_LID, chunk AS chunk_id FROM cells")
def chunk_spatial(spark, d):
    return preparing.grid_chunks(given(spark, d)[2], 300).select("PARCEL_LID", "chunk_id")


@query(f"""{_grid(100)}, n AS (SELECT chunk, count(*) AS n FROM cells GROUP BY chunk), o AS (SELECT *, chunk = 0 OR n >= 60 AS own FROM n),
q AS (SELECT *, CASE WHEN own AND n > 150 THEN CAST(ceil(n / 150.0) AS BIGINT) ELSE 1 END AS parts FROM o), l AS (SELECT *, sum(CASE WHEN own THEN parts ELSE 0 END) OVER (ORDER BY chunk) - 1 AS last FROM q),
p AS (SELECT zone, chunk, (row_number() OVER (PARTITION BY chunk ORDER BY zone) - 1) // 150 AS part FROM cells)
SELECT zone AS PARCEL_LID, CAST(CASE WHEN own THEN last - parts + 1 + CASE WHEN parts > 1 THEN part ELSE 0 END ELSE last END AS BIGINT) AS chunk_id FROM p JOIN l USING (chunk)""")
def chunk_hybrid(spark, d):
    return preparing.hybrid_chunks(given(spark, d)[2], 100, 60, 150, "PARCEL_LID").select("PARCEL_LID", F.col("chunk_id").cast("long").alias("chunk_id"))


@query(f"""WITH {PARCELS}, n AS (SELECT *, (row_number() OVER (ORDER BY zone) - 1) // 300 AS chunk_id FROM parcels), b AS (SELECT chunk_id, (min(x) + max(x + w)) / 2.0 AS cx, (min(y) + max(y + w)) / 2.0 AS cy FROM n GROUP BY chunk_id)
SELECT chunk_id, cx, cy, row_number() OVER (ORDER BY cx, cy, chunk_id) - 1 AS place FROM b""")
def chunk_order(spark, d):
    return preparing.chunk_order(preparing.count_chunks(preparing.numbered(given(spark, d)[2], "k"), 300))


@query(f"WITH {PARCELS} SELECT DISTINCT (row_number() OVER (ORDER BY zone) - 1) // 300 AS chunk_id FROM parcels QUALIFY chunk_id % 3 <> 0")
def pending_chunks(spark, d):
    ids = chunk_count(spark, d).select("chunk_id").distinct()
    return preparing.pending(ids, ids.where("chunk_id % 3 = 0"))


# ---- summaries
@query(f"{SUB} SELECT majority_land_use, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM res), 6) AS pct FROM res GROUP BY 1")
def majority_distribution(spark, d):
    return analysis.majority_distribution(run(spark, d, "subpixel"))


@query(f"{SUB} SELECT {', '.join(f'round(avg({p}), 6) AS {p}' for p in PERCENTS)} FROM res")
def average_proportions(spark, d):
    return analysis.average_proportions(run(spark, d, "subpixel"))


@query(f"{SUB} SELECT round(sum(total_pixels), 4) AS pixels, round(avg(total_pixels), 6) AS mean_pixels, count_if(total_pixels = 0) AS n_without FROM res")
def pixel_statistics(spark, d):
    return analysis.pixel_statistics(run(spark, d, "subpixel"))


@query(f"{SUB}, v AS (SELECT {VALID} FROM res) SELECT count_if(is_valid) AS n_valid, count_if(NOT is_valid) AS n_invalid, round(avg(CAST(is_valid AS INTEGER)) * 100, 6) AS valid_pct FROM v")
def validation_statistics(spark, d):
    return analysis.validation_statistics(zonal.validate(run(spark, d, "subpixel")))


ACRE = " UNION ALL ".join(f"SELECT '{n}' AS class, sum(CAL_ACREAGE * {p} / 100) AS a, sum(CAL_ACREAGE) AS t, avg({p}) AS m FROM res" for n, p in zip(CLASSES.values(), PERCENTS, strict=True))


@query(f"{SUB} SELECT class, round(a, 4) AS acres, round(a / t * 100, 6) AS acre_pct, round(m, 6) AS parcel_pct, round(a / t * 100 - m, 6) AS diff, round(m / (a / t * 100), 6) AS bias FROM ({ACRE})")
def acre_weighted(spark, d):
    return analysis.acre_weighted(run(spark, d, "subpixel"))


@query(f"{SUB} SELECT class FROM ({ACRE}) ORDER BY a DESC LIMIT 1")
def dominant_use(spark, d):
    return analysis.acre_weighted(run(spark, d, "subpixel")).agg(F.max_by("class", "acres").alias("class"))


BUCKET = "CASE WHEN CAL_ACREAGE <= 0 THEN NULL WHEN CAL_ACREAGE <= 0.22 THEN 1 WHEN CAL_ACREAGE <= 1 THEN 2 WHEN CAL_ACREAGE <= 5 THEN 3 WHEN CAL_ACREAGE <= 10 THEN 4 WHEN CAL_ACREAGE <= 50 THEN 5 WHEN CAL_ACREAGE <= 100 THEN 6 WHEN CAL_ACREAGE > 100 THEN 7 END"


@query(f"{SUB}, b AS (SELECT {BUCKET} AS bucket, * FROM res) SELECT bucket, count(*) AS n, round(sum(CAL_ACREAGE), 4) AS acres, round(avg(CAL_ACREAGE), 6) AS mean_acres, round(sum(CAL_ACREAGE) / (SELECT sum(CAL_ACREAGE) FROM res) * 100, 6) AS acre_pct, round(sum(CAL_ACREAGE * developed_pct / 100) / sum(CAL_ACREAGE) * 100, 6) AS developed_pct FROM b WHERE bucket IS NOT NULL GROUP BY bucket")
def size_buckets(spark, d):
    return analysis.size_buckets(run(spark, d, "subpixel"))


@query(f"{SUB} SELECT count_if(developed_pct > 50) AS n, round(count_if(developed_pct > 50) * 100.0 / count(*), 6) AS pct, round(avg(CAL_ACREAGE) FILTER (developed_pct > 50), 6) AS mean_acres FROM res")
def developed_parcels(spark, d):
    more = F.col("developed_pct") > 50
    return run(spark, d, "subpixel").agg(F.count_if(more).alias("n"), F.round(F.count_if(more) * 100 / F.count(F.lit(1)), 6).alias("pct"), F.round(F.avg(F.when(more, F.col("CAL_ACREAGE"))), 6).alias("mean_acres"))


@query(f"{SUB}, r AS (SELECT val, count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM px WHERE val BETWEEN 1 AND 5 GROUP BY val), a AS ({ACRE}) SELECT class, round(r.pct, 6) AS raster_pct, round(a.a / a.t * 100, 6) AS parcel_pct, round(round(a.a / a.t * 100, 6) - round(r.pct, 6), 6) AS diff FROM a JOIN r ON r.val = list_position(['AGRICULTURE', 'DEVELOPED', 'FOREST', 'OTHER', 'RANGELAND_PASTURE'], class)")
def raster_vs_parcel(spark, d):
    grid, px, _ = given(spark, d)
    cells = analysis.class_acres(px, CLASSES, grid).select("class", F.col("pct").alias("raster_pct"))
    acre = analysis.acre_weighted(run(spark, d, "subpixel")).select("class", F.col("acre_pct").alias("parcel_pct"))
    return cells.join(acre, "class").select("class", "raster_pct", "parcel_pct", F.round(F.col("parcel_pct") - F.col("raster_pct"), 6).alias("diff"))


@query(f"WITH {PARCELS}, r AS (SELECT count(*) * 900 / 4046.86 AS acres FROM px WHERE val BETWEEN 1 AND 5), p AS (SELECT sum(cal) AS acres, count(*) AS n FROM parcels) SELECT round(r.acres, 4) AS raster_acres, round(p.acres, 4) AS parcel_acres, round(p.acres / r.acres * 100, 6) AS coverage_pct, n FROM r, p")
def parcel_coverage(spark, d):
    """Acres of zones as a share of the raster's acres with a class."""
    grid, px, zones = given(spark, d)
    return analysis.coverage(zones, px, grid)


# ---- comparisons
ERRORS = "round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(max(abs(e)), 6) AS max_error, round(avg(e), 6) AS mean_error, round(median(e), 6) AS median_error, round(stddev_samp(e), 6) AS std_error, round(min(e), 6) AS least_error, round(corr(calculated_acres, CAL_ACREAGE) FILTER (CAL_ACREAGE > 0 AND calculated_acres > 0), 6) AS correlation"


@query(f"{SUB} SELECT {ERRORS} FROM (SELECT *, calculated_acres - CAL_ACREAGE AS e FROM res WHERE CAL_ACREAGE IS NOT NULL)")
def method_error_metrics(spark, d):
    return analysis.error_metrics(run(spark, d, "subpixel"), "CAL_ACREAGE", "calculated_acres")


@query(f"{CENTER} SELECT {ERRORS} FROM (SELECT *, calculated_acres - CAL_ACREAGE AS e FROM res WHERE CAL_ACREAGE IS NOT NULL)")
def center_error_metrics(spark, d):
    return analysis.error_metrics(run(spark, d, "center"), "CAL_ACREAGE", "calculated_acres")


@query(f"{SUB}, t AS (SELECT CASE WHEN CAL_ACREAGE = 0 THEN 1e300 ELSE abs(calculated_acres - CAL_ACREAGE) / CAL_ACREAGE * 100 END AS p FROM res WHERE CAL_ACREAGE IS NOT NULL AND calculated_acres > 0) SELECT count_if(p <= 5) AS within_5, count_if(p <= 10) AS within_10, count_if(p <= 25) AS within_25, count_if(p > 25) AS over_25 FROM t")
def tolerance_buckets(spark, d):
    return analysis.tolerance_buckets(run(spark, d, "subpixel"), "acre_diff_pct")


@query(f"{SUB}, b AS (SELECT CASE WHEN CAL_ACREAGE <= 0 THEN NULL WHEN CAL_ACREAGE <= 0.5 THEN 1 WHEN CAL_ACREAGE <= 1 THEN 2 WHEN CAL_ACREAGE <= 2 THEN 3 WHEN CAL_ACREAGE <= 5 THEN 4 WHEN CAL_ACREAGE > 5 THEN 5 END AS bucket, abs(calculated_acres - CAL_ACREAGE) AS e FROM res) SELECT bucket, count(*) AS n, round(avg(e), 6) AS mae FROM b WHERE bucket IS NOT NULL GROUP BY bucket")
def error_by_size(spark, d):
    rows = run(spark, d, "subpixel").select(analysis.bucket(F.col("CAL_ACREAGE"), (0.0, 0.5, 1.0, 2.0, 5.0)).alias("bucket"), F.abs(F.col("calculated_acres") - F.col("CAL_ACREAGE")).alias("e"))
    return rows.where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("e"), 6).alias("mae"))


def _two(second: str) -> str:
    """Results by sub-cells (a) and by another method (b)."""
    again = f"{sub_cells('1')}, {TOUCHED}, {results('touch', True)}" if second == "standard" else f"{sub_cells('1')}, {results('hit', True)}"
    return f"a AS (WITH {PARCELS}, {sub_cells('tier')}, {results('hit', False)} SELECT * FROM res), b AS (WITH {PARCELS}, {again} SELECT * FROM res)"


@query(f"WITH {_two('center')} SELECT round(avg(CAST(a.majority_land_use = b.majority_land_use AS INTEGER)) * 100, 6) AS agreement FROM a JOIN b USING (PARCEL_LID)")
def majority_agreement(spark, d):
    a, b = (run(spark, d, m).select("PARCEL_LID", F.col("majority_land_use").alias(m)) for m in ("subpixel", "center"))
    return a.join(b, "PARCEL_LID").agg(F.round(F.avg((F.col("subpixel") == F.col("center")).cast("int")) * 100, 6).alias("agreement"))


@query(f"WITH {_two('standard')}, e AS (SELECT abs(a.calculated_acres - a.CAL_ACREAGE) AS x, abs(b.calculated_acres - b.CAL_ACREAGE) AS y FROM a JOIN b USING (PARCEL_LID) WHERE a.CAL_ACREAGE IS NOT NULL) SELECT round(avg(y - x), 6) AS mean_reduction, count_if(round(x - y, 9) < 0) AS improved, count_if(round(x - y, 9) > 0) AS worse, count_if(round(x - y, 9) = 0) AS unchanged FROM e")
def error_reduction(spark, d):
    a, b = (run(spark, d, m).where("CAL_ACREAGE is not null").select("PARCEL_LID", F.abs(F.col("calculated_acres") - F.col("CAL_ACREAGE")).alias(m)) for m in ("subpixel", "standard"))
    off = F.round(F.col("subpixel") - F.col("standard"), 9)
    return a.join(b, "PARCEL_LID").agg(F.round(F.avg(F.col("standard") - F.col("subpixel")), 6).alias("mean_reduction"), F.count_if(off < 0).alias("improved"), F.count_if(off > 0).alias("worse"), F.count_if(off == 0).alias("unchanged"))


@query(f"WITH {PARCELS} SELECT count(cal) AS n, round(avg(cal), 6) AS mean, round(stddev_samp(cal), 6) AS std, round(min(cal), 6) AS least, round(quantile_cont(cal, 0.25), 6) AS q1, round(quantile_cont(cal, 0.5), 6) AS q2, round(quantile_cont(cal, 0.75), 6) AS q3, round(max(cal), 6) AS most FROM parcels")
def acreage_describe(spark, d):
    return analysis.describe(given(spark, d)[2], "CAL_ACREAGE")


RASTER_VS = ORACLE["raster_vs_parcel"].rpartition(" SELECT class, ")


@query(f"{RASTER_VS[0]}, rv AS (SELECT class, {RASTER_VS[2]}) SELECT round(avg(abs(parcel_pct - raster_pct)), 6) AS mae, round(sqrt(avg((parcel_pct - raster_pct) ** 2)), 6) AS rmse, round(corr(raster_pct, parcel_pct), 6) AS correlation FROM rv")
def class_share_errors(spark, d):
    return comparing.share_errors(raster_vs_parcel(spark, d), "raster_pct", "parcel_pct")


@query(f"{SUB}, p AS (SELECT CASE WHEN CAL_ACREAGE > 0 THEN (calculated_acres - CAL_ACREAGE) / CAL_ACREAGE * 100 WHEN calculated_acres > 0 THEN NULL ELSE 0 END AS p FROM res WHERE CAL_ACREAGE IS NOT NULL) SELECT count(*) - count(p) AS n_infinite, round(avg(p), 6) AS mean_pct, round(median(p), 6) AS median_pct FROM p")
def percentage_errors(spark, d):
    return comparing.percentage_errors(run(spark, d, "subpixel"), "CAL_ACREAGE", "calculated_acres")


@query(f"WITH {PARCELS} SELECT round(sum(cal), 4) AS total, round(avg(cal), 6) AS mean, round(median(cal), 6) AS median FROM parcels")
def sample_statistics(spark, d):
    return comparing.sample_statistics(given(spark, d)[2])


@query(f"{CENTER}, l AS (SELECT unnest([0.5, 1.0, 2.0]) AS pixels) SELECT CAST(pixels AS DOUBLE) AS pixels, count(*) AS n, round(avg(abs(calculated_acres - CAL_ACREAGE)), 6) AS mae FROM res JOIN l ON CAL_ACREAGE < pixels * 900 / 4046.86 GROUP BY 1")
def below_pixels(spark, d):
    return comparing.below_pixels(run(spark, d, "center"), derived.grid_of(spark, d), "CAL_ACREAGE", "calculated_acres")


def _three(spark, d, *columns: str) -> DataFrame:
    return comparing.side_by_side({m: run(spark, d, m) for m in METHODS}, *columns)


METHODS = ["standard", "center", "subpixel"]
THREE = f"WITH {_two('center')}, c AS (WITH {PARCELS}, {sub_cells('1')}, {TOUCHED}, {results('touch', True)} SELECT * FROM res)"


@query(f"{THREE} SELECT PARCEL_LID, round(c.calculated_acres, 6) AS standard_acres, c.majority_land_use AS standard_majority, round(b.calculated_acres, 6) AS center_acres, b.majority_land_use AS center_majority, round(a.calculated_acres, 6) AS subpixel_acres, a.majority_land_use AS subpixel_majority FROM a JOIN b USING (PARCEL_LID) JOIN c USING (PARCEL_LID)")
def method_comparison(spark, d):
    rows = _three(spark, d, "calculated_acres", "majority_land_use")
    return rows.select("PARCEL_LID", *[c for m in METHODS for c in (F.round(f"{m}_calculated_acres", 6).alias(f"{m}_acres"), F.col(f"{m}_majority_land_use").alias(f"{m}_majority"))])


AGREE = " UNION ALL ".join(f"SELECT '{m}' AS first, '{n}' AS second, round(avg(CAST({x}.majority_land_use = {y}.majority_land_use AS INTEGER)) * 100, 6) AS agreement FROM {x} JOIN {y} USING (PARCEL_LID)" for m, n, x, y in (("standard", "center", "c", "b"), ("standard", "subpixel", "c", "a"), ("center", "subpixel", "b", "a")))


@query(f"{THREE} {AGREE}")
def method_agreement(spark, d):
    return comparing.agreement(_three(spark, d, "majority_land_use"), METHODS)


@query(f"""{THREE}, e AS (SELECT method, avg(abs(calculated_acres - CAL_ACREAGE)) AS e FROM (SELECT 'standard' AS method, * FROM c UNION ALL SELECT 'center', * FROM b UNION ALL SELECT 'subpixel', * FROM a) WHERE CAL_ACREAGE IS NOT NULL GROUP BY method)
SELECT method, round(e, 6) AS mae, round((1 - e / (SELECT e FROM e WHERE method = 'standard')) * 100, 6) AS gain_pct, e = (SELECT min(e) FROM e) AS most_accurate FROM e""")
def tradeoff_vs_baseline(spark, d):
    known = given(spark, d)[2].select("PARCEL_LID", "CAL_ACREAGE")
    return comparing.tradeoff(_three(spark, d, "calculated_acres").join(known, "PARCEL_LID"), METHODS, "standard")


@query(f"{SUB}, b AS (SELECT CASE WHEN CAL_ACREAGE <= 0 THEN NULL WHEN CAL_ACREAGE <= 0.5 THEN 1 WHEN CAL_ACREAGE <= 1 THEN 2 WHEN CAL_ACREAGE <= 2 THEN 3 WHEN CAL_ACREAGE <= 5 THEN 4 WHEN CAL_ACREAGE <= 10 THEN 5 WHEN CAL_ACREAGE > 10 THEN 6 END AS bucket, abs(calculated_acres - CAL_ACREAGE) AS e FROM res) SELECT bucket, count(*) AS n, round(avg(e), 6) AS mae FROM b WHERE bucket IS NOT NULL GROUP BY bucket")
def error_by_size_6(spark, d):
    rows = run(spark, d, "subpixel").select(analysis.bucket(F.col("CAL_ACREAGE"), (0.0, 0.5, 1.0, 2.0, 5.0, 10.0)).alias("bucket"), F.abs(F.col("calculated_acres") - F.col("CAL_ACREAGE")).alias("e"))
    return rows.where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("e"), 6).alias("mae"))


@query(f"WITH {PARCELS} SELECT zone AS PARCEL_LID, CAST(area AS DOUBLE) AS area_m2 FROM parcels")
def wkb_round_trip(spark, d):
    shaped = given(spark, d)[2].select("PARCEL_LID", wkb.encode(F.col("rings")).alias("geometry"))
    return wkb.decode(shaped).select("PARCEL_LID", area(F.col("rings")).alias("area_m2"))
