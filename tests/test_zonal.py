import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terrace.config import Grid
from terrace.functions.geometry import RINGS, albers, area
from terrace.operators import coverage, preparing, sinks, zonal
from terrace.plans import pipeline

DATA = "/root/testdata/sf0.001"
GRID = Grid(4, 4)


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def zones(spark, *rows):
    return spark.createDataFrame([(i, str(i), str(i), a, r) for i, (a, r) in enumerate(rows)], f"k long, zone string, PARCEL_LID string, CAL_ACREAGE double, rings {RINGS}")


def raster(spark, **cells):
    return spark.createDataFrame([(int(k[1]), int(k[2]), v) for k, v in cells.items()], "row long, col long, val int")


def one(spark, acreage, rings, **cells):
    return zonal.validate(zonal.zonal(zones(spark, (acreage, rings)), raster(spark, **cells), GRID)).first()


def test_whole_cell(spark):
    r = one(spark, 0.2224, [box(0, 0, 30, 30)], c00=3)
    assert (r["forest_pct"], r["total_pixels"], r["subpixel_resolution"], r["majority_land_use"], r["is_valid"]) == (100, 1, 7, "FOREST", True)


def test_half_cell_and_ties(spark):
    assert one(spark, 0.11, [box(0, 0, 15, 30)], c00=2)["total_pixels"] == 0.5
    r = one(spark, 0.44, [box(0, 0, 60, 30)], c00=5, c01=1)
    assert (r["agriculture_pct"], r["rangeland_pasture_pct"], r["majority_land_use"]) == (50, 50, "AGRICULTURE")


def test_no_data_unmapped_and_off_raster(spark):
    r = one(spark, 0.2224, [box(0, 0, 30, 30)], c00=0)
    assert (r["majority_land_use"], r["is_valid"], r["calculated_acres"]) == ("NO_DATA", False, 0)
    r = one(spark, 0.44, [box(0, 0, 60, 30)], c00=1, c01=6)
    assert (r["agriculture_pct"], r["total_pixels"], r["proportion_sum"], r["is_valid"]) == (50, 2, 50, False)
    assert one(spark, 0.2224, [box(900, 900, 930, 930)], c00=1)["majority_land_use"] == "NO_DATA"


def test_hole(spark):
    cells = {f"c{i}{j}": 4 for i in range(3) for j in range(3)}
    assert one(spark, 1.78, [box(0, 0, 90, 90), box(30, 30, 60, 60)], **cells)["total_pixels"] == 8


def test_acre_difference(spark):
    r = one(spark, 0.0, [box(0, 0, 30, 30)], c00=1)
    assert r["acre_diff_pct"] == float("inf")
    assert one(spark, None, [box(0, 0, 30, 30)], c00=1)["acre_diff"] is None
    with pytest.raises(ValueError):
        zonal.zonal(zones(spark, (1.0, [box(0, 0, 1, 1)])), raster(spark, c00=1), GRID, "other")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(-20, 140), st.integers(-20, 140)), min_size=3, max_size=7), min_size=1, max_size=2), st.sampled_from([1, 2, 5]))
def test_spans_are_centre_tests(spark, rings, n):
    found = {(r["row"], r["col"]): r["hits"] for r in coverage.cover(zones(spark, (1.0, [ring(*r) for r in rings])), GRID, F.lit(n)).collect()}
    edges = [(r[i], r[(i + 1) % len(r)]) for r in rings for i in range(len(r))]
    expected = {}
    for cy in range(4 * n):
        for cx in range(4 * n):
            x, y, odd = 30 * (2 * cx + 1), 30 * (2 * cy + 1), False
            for (x1, y1), (x2, y2) in edges:
                x1, y1, x2, y2 = (2 * n * v for v in (x1, y1, x2, y2))
                if (y1 <= y) != (y2 <= y):
                    d, num = y2 - y1, x1 * (y2 - y1) + (y - y1) * (x2 - x1)
                    odd ^= (x * d >= num) if d > 0 else (x * -d >= -num)
            if odd:
                expected[cy // n, cx // n] = expected.get((cy // n, cx // n), 0) + 1
    assert found == expected


def test_geometry(spark):
    row = zones(spark, (1.0, [box(0, 0, 10, 10), box(2, 2, 4, 4)])).select(area(F.col("rings")).alias("a")).first()
    assert row["a"] == 96
    x, y = albers(F.lit(-96.0), F.lit(23.0))
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(r["x"]) < 1e-6 and abs(r["y"]) < 1e-6


def test_hybrid_plan(spark):
    sizes = spark.createDataFrame([(0, 50), (1, 30), (2, 260)], "chunk_id long, n long")
    assert [tuple(r) for r in preparing.hybrid_plan(sizes, 40, 100).orderBy("chunk_id").collect()] == [(0, 0, 1), (1, 0, 1), (2, 1, 3)]
    with pytest.raises(ValueError):
        preparing.chunks(zones(spark, (1.0, [box(0, 0, 1, 1)])), "other")


def test_acreage_of_the_geometry_where_none_is_given(spark):
    given_, px = zones(spark, (0.9, [box(0, 0, 60, 60)])), raster(spark, c00=3, c01=3, c10=3, c11=3)
    r = zonal.zonal(given_.drop("CAL_ACREAGE"), px, GRID).first()
    assert (r["subpixel_resolution"], r["total_pixels"], r["acre_diff"]) == (7, 4, None)


def test_sample_is_exact_and_the_same_again(spark):
    rows = zones(spark, *[(1.0, [box(0, 0, i + 1, 1)]) for i in range(40)])
    first, again = ({r["zone"] for r in preparing.sample(rows, 15, "zone").collect()} for _ in range(2))
    assert first == again and len(first) == 15 and preparing.sample(rows, 99, "zone").count() == 40


def test_box_and_multipolygon(spark):
    from terrace.functions.geometry import meets_box

    shapes = [[box(0, 0, 1, 1)], [box(4, 4, 5, 5)], [ring((0, 8), (8, 0), (8, 8))], [box(-9, -9, 9, 9)], [box(-9, -9, 9, 9), box(-8, -8, 8, 8)], [ring((0, 9), (9, 9), (9, 0))]]
    out = zones(spark, *[(1.0, s) for s in shapes]).select(meets_box(F.col("rings"), 1, 1, 3, 3).alias("m")).collect()
    assert [r["m"] for r in out] == [True, False, False, True, False, False]
    two = zones(spark, (1.0, [box(0, 0, 10, 10), box(20, 0, 30, 10), box(22, 2, 24, 4)])).select(area(F.col("rings")).alias("a")).first()
    assert two["a"] == 196


def test_well_known_binary_and_files(spark, tmp_path):
    import json
    import struct

    from terrace.functions import wkb
    from terrace.sources import vector

    shapes = [[box(0, 0, 30, 30)], [ring((-1.5, 2.25), (1e-3, -7e5), (123456.789, 0.1))], [box(0, 0, 90, 90), box(30, 30, 60, 60)], None]
    rows = zones(spark, *[(float(i), s) for i, s in enumerate(shapes)]).select("PARCEL_LID", "CAL_ACREAGE", wkb.encode(F.col("rings")).alias("geometry"), F.lit(1).alias("other"))
    first = bytes(rows.first()["geometry"])
    assert first == struct.pack(">BIII10d", 0, 3, 1, 5, 0, 0, 30, 0, 30, 30, 0, 30, 0, 0)
    part = lambda *p: struct.pack(f"<BIII{2 * len(p)}d", 1, 3, 1, len(p), *[v for q in p for v in q])
    many = struct.pack("<BII", 1, 6, 2) + part((0, 0), (1, 0), (1, 1), (0, 0)) + part((5, 5), (6, 5), (6, 6), (5, 5))
    assert [len(r) for r in wkb.parse(many)] == [3, 3] and wkb.parse(many[:40]) is None and wkb.parse(struct.pack("<BIdd", 1, 1, 0, 0)) is None
    path = f"{tmp_path}/z.parquet"
    rows.write.parquet(path)
    read = vector.load(spark, path, ["PARCEL_LID"])
    assert read.columns == ["PARCEL_LID", "CAL_ACREAGE", "rings"]
    got = {r["PARCEL_LID"]: r["rings"] and [[tuple(p) for p in x] for x in r["rings"]] for r in read.collect()}
    assert got == {str(i): s for i, s in enumerate(shapes)}
    feature = lambda i, kind, shape: {"type": "Feature", "geometry": {"type": kind, "coordinates": shape}, "properties": {"PARCEL_LID": f"g{i}", "CAL_ACREAGE": i}}
    square = [[0, 0], [30, 0], [30, 30], [0, 30], [0, 0]]
    with open(f"{tmp_path}/z.geojson", "w") as file:
        json.dump({"type": "FeatureCollection", "features": [feature(1, "Polygon", [square]), feature(2, "MultiPolygon", [[square], [square]]), feature(3, "Point", [0, 0])]}, file, indent=1)
    got = {r["PARCEL_LID"]: (r["CAL_ACREAGE"], r["rings"] and len(r["rings"])) for r in vector.load(spark, f"{tmp_path}/z.geojson").collect()}
    assert got == {"g1": (1.0, 1), "g2": (2.0, 2), "g3": (3.0, None)}
    saved = sinks.save(zones(spark, (2.0, [box(0, 0, 30, 30)])), str(tmp_path), "geojson")
    assert [len(r["rings"]) for r in vector.load(spark, saved).collect()] == [1]
    assert vector.newest(spark, str(tmp_path)).endswith(".geojson") and vector.newest(spark, f"{tmp_path}/none") is None
    for bad in (lambda: vector.load(spark, "x.shp"), lambda: preparing.require(rows, "none")):
        with pytest.raises(ValueError):
            bad()
    assert sinks.clean_checkpoint(spark, path) and not sinks.clean_checkpoint(spark, path)


def test_preparation_in_degrees(spark):
    grid = Grid(40, 40, 30.0, -600.0, -600.0)
    rows = zones(spark, (1.0, [ring((-96.001, 22.999), (-95.999, 22.999), (-95.999, 22.999), (-95.999, 23.001), (-96.001, 23.001))]), (1.0, [box(-90, 30, -89, 31)]), (1.0, None), (1.0, []), (1.0, [ring((-96, 23), (-96, 23))]))
    out = pipeline.prepare(rows.drop("k", "zone"), grid, degrees=True)
    assert [r["PARCEL_LID"] for r in out.collect()] == ["0"] and len(out.first()["rings"][0]) == 4
    # a ring of one point is not valid
    assert tuple(preparing.statistics(rows, out).first()) == (1, 1, 1, 2, 5, 1, 4)


def test_pipeline_resumes_and_saves(spark, tmp_path):
    from terrace.sources import derived

    grid = derived.grid_of(spark, DATA)
    px, parcels = derived.raster(spark, DATA), derived.parcels(spark, DATA, grid)
    whole = pipeline.run(parcels, px, grid)
    again = pipeline.run(parcels, px, grid, checkpoint=f"{tmp_path}/cp")
    assert whole.count() == again.count() == pipeline.run(parcels, px, grid, checkpoint=f"{tmp_path}/cp").count()
    assert spark.read.parquet(sinks.save(whole, str(tmp_path))).count() == whole.count()
    assert spark.read.option("header", True).csv(sinks.save(whole, str(tmp_path), "csv")).count() == whole.count()
    found = sinks.summary(whole)
    assert found["parcels"] == whole.count() and "Majority" in sinks.report(found) and sinks.as_json(found)
    with pytest.raises(ValueError):
        sinks.save(whole, str(tmp_path), "shp")


@pytest.mark.parametrize("name", ["zonal_center", "zonal_standard", "size_buckets", "county_spatial_join", "processing_id", "largest_diff_k", "class_remap_acres", "chunk_spatial", "chunk_hybrid", "chunk_order", "class_share_errors", "percentage_errors", "below_pixels", "method_agreement", "tradeoff_vs_baseline", "sample_statistics"])
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("orders", "part", "nation", "customer"):
        db.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = entry.queries()[name](spark, DATA)
    found = sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())
    rel = db.sql(entry.oracle_sql()[name])
    at = [list(rel.columns).index(c) for c in sorted(df.columns)]
    assert found == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


#: The raster comparison's table, by code from 1.
COMPARED = "DEVELOPED AGRICULTURE RANGELAND_PASTURE FOREST OTHER OTHER OTHER DEVELOPED FOREST RANGELAND_PASTURE AGRICULTURE AGRICULTURE OTHER OTHER OTHER".split()


def test_class_remap_takes_all_codes(spark):
    from terrace.operators import analysis
    from terrace.plans import queries
    from terrace.sources import derived

    cells = [(k, k, v) for k, v in enumerate([0, -1, 16, 16, 200, *(v for v in range(1, 16) for _ in range(v))])]
    px = spark.createDataFrame(cells, "row long, col long, val int")
    out = {r["class"]: r["cells"] for r in analysis.class_acres(px, analysis.REMAP, derived.grid_of(spark, DATA)).collect()}
    assert out == {c: sum(v for v, x in enumerate(COMPARED, 1) if x == c) for c in set(COMPARED)}
    assert {r["val"]: r["n"] for r in analysis.unmapped(px, analysis.REMAP).collect()} == {16: 2, 200: 1}
    db = duckdb.connect()
    for t in ("orders", "part"):
        db.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    sql = f"WITH {queries.PARCELS}, c AS (SELECT {COMPARED}[val] AS class, count(*) AS cells FROM px WHERE val BETWEEN 1 AND 15 GROUP BY 1) SELECT class, cells, round(cells * 900.0 / 4046.86, 4) AS acres, round(cells * 100.0 / sum(cells) OVER (), 6) AS pct FROM c"
    assert sorted(map(tuple, entry.queries()["class_remap_acres"](spark, DATA).collect())) == sorted(db.sql(sql).fetchall())
    assert entry.queries()["class_remap_unmapped"](spark, DATA).count() == len(db.sql(entry.oracle_sql()["class_remap_unmapped"]).fetchall())
