"""Tiles against cells, windows, and runs that break off and go on."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.config import Grid, Settings
from terrace.operators import analysis, checkpoint, coverage, preparing, tiles, zonal
from terrace.plans import pipeline
from terrace.plans.queries import QUERIES
from terrace.sources import derived
from tests.test_zonal import DATA, box, ring, zones


def cells_of(spark, width, height, missing, seed=1):
    rng = random.Random(seed)
    rows = [(r, c, rng.choice([0, 1, 2, 3, 4, 5, 6, 200])) for r in range(height) for c in range(width) if rng.random() >= missing]
    return rows, spark.createDataFrame(rows, "row long, col long, val int")


@pytest.mark.parametrize("missing", [0.0, 0.4, 0.999])
def test_tiles_hold_the_cells(spark, missing):
    rows, px = cells_of(spark, 130, 70, missing)
    out = tiles.tiled(px)
    assert {len(r["vals"]) for r in out.collect()} == {tiles.SIDE**2} and out.count() == len({(r // 64, c // 64) for r, c, _ in rows})
    found = {(r["row"], r["col"]): r["val"] for r in tiles.cells(out).collect()}
    assert all(found.pop((r, c)) == v for r, c, v in rows) and set(found.values()) <= {0}
    assert tiles.tiled(px.where("false")).count() == 0


def test_zonal_over_tiles_and_cells_alike(spark):
    grid = Grid(130, 140)
    _, px = cells_of(spark, 130, 140, 0.1)
    shapes = [[box(0, 0, 3900, 4200)], [box(1900, 1900, 1950, 1950)], [ring((10, 10), (3000, 70), (100, 4100))], [box(-500, -500, 20, 20)], [box(9000, 0, 9100, 100)], [box(100, 100, 2500, 2500), box(700, 700, 1900, 1900)], [ring((5, 5), (5, 5.5), (5.5, 5))]]
    parcels = zones(spark, *[(float(i + 1), s) for i, s in enumerate(shapes)])
    for method in ("subpixel", "standard"):
        a, b = (sorted(map(str, zonal.zonal(parcels, p, grid, method).drop("rings").collect())) for p in (px, tiles.tiled(px)))
        assert a == b and len(a) == len(shapes)
        # the plain way: covered cells by (row, col)
        cover = coverage.touched(parcels, grid).withColumn("hits", F.lit(1)) if method == "standard" else coverage.cover(parcels, grid, F.lit(1))
        plain = cover.join(px.where("val <> 0"), ["row", "col"]).groupBy("zone", "val").agg(F.sum("hits").alias("hits"))
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, zonal.class_hits(cover, tiles.tiled(px), parcels, grid).collect()))


def test_touched_cells_against_plain_geometry(spark):
    """Cells by the ends of each edge within each row of cells, with fractions."""
    from fractions import Fraction
    from math import floor

    rng, grid = random.Random(8), Grid(6, 5)
    shapes = [[ring(*[(rng.randint(-40, 220), rng.randint(-40, 190)) for _ in range(rng.randint(3, 6))])] for _ in range(25)]
    found = {(r["zone"], r["row"], r["col"]): r["centre"] for r in coverage.touched(zones(spark, *[(1.0, s) for s in shapes]), grid).collect()}
    centres = {(r["zone"], r["row"], r["col"]) for r in coverage.cover(zones(spark, *[(1.0, s) for s in shapes]), grid, F.lit(1)).collect()}
    expected = dict.fromkeys(centres, True)
    for z, shape in enumerate(shapes):
        points = [(int(x), int(y)) for x, y in shape[0]]
        for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]):
            for row in range(max(0, min(y1, y2) // 30), min(4, max(y1, y2) // 30) + 1):
                at = lambda y: x1 + Fraction((y - y1) * (x2 - x1), y2 - y1)  # noqa: B023, E731
                ends = (x1, x2) if y1 == y2 else (at(max(min(y1, y2), row * 30)), at(min(max(y1, y2), row * 30 + 30)))
                for col in range(max(0, floor(min(ends) / 30)), min(5, floor(max(ends) / 30)) + 1):
                    expected.setdefault((str(z), row, col), False)
    assert found == expected


def test_tiles_far_from_zones_stay(spark):
    grid = Grid(64 * 300, 64 * 10, origin_x=-100.0)  # two tiles a block across, one down
    raster = spark.range(3000).select(F.floor(F.col("id") / 300).alias("trow"), (F.col("id") % 300).alias("tcol"), F.array(F.lit(1)).alias("vals"))
    side = 64 * 30
    rows = zones(spark, (1.0, [box(side * 5 - 90, side * 2 + 10, side * 5 - 80, side * 3 + 5)]), (1.0, [box(-1e9, -1e9, -1e8, -1e8)]), (1.0, []), (1.0, None))
    assert {(r["trow"], r["tcol"]) for r in tiles.near(raster, rows, grid).collect()} == {(r, c) for r in (2, 3) for c in (4, 5)}
    assert tiles.near(raster, rows.where("false"), grid).count() == 0
    across = zones(spark, (1.0, [box(-1e7, -1e7, 1e7, 1e7)]))
    assert tiles.near(raster, across, grid).count() == 3000


def test_windows(spark):
    grid = Grid(130, 70, origin_x=-60.0, origin_y=30.0)
    rows, px = cells_of(spark, 130, 70, 0.0)
    for bounds, pad in (((300, 120, 1140, 180), 2), ((-60, 30, 0, 60), 10), ((3700, 2000, 9000, 9000), 0), ((-900, -900, -800, -800), 3), ((9000, 100, 9100, 200), 2)):
        x0, y0, x1, y1 = bounds
        c0, r0 = max(0, int((x0 + 60) / 30) - pad), max(0, int((y0 - 30) / 30) - pad)
        w, h = min(int((x1 - x0) / 30) + 2 * pad + 1, 130 - c0), min(int((y1 - y0) / 30) + 2 * pad + 1, 70 - r0)
        expected = sorted((r, c, v) for r, c, v in rows if r0 <= r < r0 + h and c0 <= c < c0 + w)
        for raster in (px, tiles.tiled(px)):
            assert sorted(map(tuple, tiles.read_window(raster, grid, bounds, pad).collect())) == expected


def test_a_run_that_breaks_off_goes_on(spark, tmp_path, monkeypatch):
    grid = derived.grid_of(spark, DATA)
    px, parcels, s = derived.raster(spark, DATA), derived.parcels(spark, DATA, grid).where("k < 90"), Settings(chunk_size=10, chunks_a_commit=2)
    plain = pipeline.run(parcels, px, grid, settings=s)
    path, whole = f"{tmp_path}/cp", sorted(map(str, plain.collect()))
    real = zonal.validate
    monkeypatch.setattr(zonal, "validate", lambda rows, settings: real(rows, settings).withColumn("is_valid", F.when(F.col("chunk_id") >= 4, F.raise_error(F.lit("lost")).cast("boolean")).otherwise(F.col("is_valid"))))
    with pytest.raises(Exception, match="lost"):
        pipeline.run(parcels, px, grid, checkpoint=path, settings=s)
    monkeypatch.setattr(zonal, "validate", real)
    folder = checkpoint.Folder(spark, path)
    first = checkpoint.done(folder)
    assert sorted(first) == [0, 1] and pipeline.summary(parcels, path).first()["n_chunks"] == 2
    # what a crash may leave: rows that nothing names, half a file, a file whose rows have gone
    spark.range(3).write.parquet(f"{path}/data/left-over")
    (tmp_path / "cp/done/7.json").write_text('{"group": 7, "da')
    (tmp_path / "cp/done/8.json").write_text('{"group": 4, "data": "data/none", "n_parcels": 1, "seconds": 1, "method": "x"}')
    assert checkpoint.done(folder) == first
    out = pipeline.run(parcels, px, grid, checkpoint=path, settings=s)
    assert sorted(map(str, out.select(*plain.columns).collect())) == whole
    last = checkpoint.done(folder)
    assert sorted(last) == [0, 1, 2, 3, 4] and all(last[g] == first[g] for g in first)
    again = pipeline.run(parcels, px, grid, checkpoint=path, settings=s)
    assert checkpoint.done(folder) == last and again.count() == len(whole)
    found = pipeline.summary(parcels, path).first()
    assert (found["n_chunks"], found["total_parcels"], found["primary_method"]) == (5, len(whole), "subpixel") and found["total_seconds"] > 0
    with pytest.raises(ValueError, match="other settings"):
        pipeline.run(parcels, px, grid, method="center", checkpoint=path, settings=s)
    assert pipeline.run(parcels.where("false"), px, grid, checkpoint=f"{tmp_path}/none", settings=s).count() == 0


def test_covered_cells_meet_tiles_by_shuffle(spark):
    """However small the file of zones: their cells are many times as large, and a broadcast takes them through the driver."""
    grid = derived.grid_of(spark, DATA)
    px, rows = derived.raster(spark, DATA), derived.parcels(spark, DATA, grid)
    covered = {"covered": coverage.cover(rows, grid, F.lit(5)), "touched": coverage.touched(rows, grid).withColumn("hits", F.lit(1))}
    for name, cells in covered.items():
        for whole in (px, tiles.tiled(px)):
            plan = tiles.met(cells, whole, rows, grid, "hits")._jdf.queryExecution().sparkPlan().toString()
            found = [line for line in plan.splitlines() if "Join" in line]
            assert len(found) == 2 and "SortMergeJoin [trow" in found[0] and "LeftSemi" in found[1], (name, plan)


def joins(df):
    return [line for line in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]


FROM_CELLS = (
    "acre_diff", "acre_weighted", "average_proportions", "below_pixels", "center_error_metrics", "class_share_errors", "developed_parcels", "dominant_use", "error_by_size", "error_by_size_6", "error_reduction", "majority_agreement",
    "geometry_join", "largest_diff_k", "majority_class", "majority_distribution", "method_agreement", "method_comparison", "method_error_metrics", "percentage_errors", "pixel_statistics", "raster_vs_parcel", "subpixel5_mapped",
)


@pytest.mark.parametrize("name", FROM_CELLS)
def test_no_query_broadcasts_covered_cells(spark, name):
    found = [x for x in joins(QUERIES[name](spark, DATA)) if "[trow" in x]
    assert found and all("SortMergeJoin" in x for x in found), found


def test_zones_join_their_results_by_shuffle(spark):
    first = joins(QUERIES["geometry_join"](spark, DATA))[0]
    assert "SortMergeJoin [PARCEL_LID" in first, first


def test_majority_distribution_computes_zones_once(spark):
    found = joins(QUERIES["majority_distribution"](spark, DATA))
    assert len([x for x in found if "[trow" in x]) == 1, found
    rows = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "majority_land_use string")
    assert {tuple(r) for r in analysis.majority_distribution(rows).collect()} == {("A", 2, 66.666667), ("B", 1, 33.333333)}


def test_chunks_of_zones_on_a_line(spark):
    for shape in ([box(5, 5, 5, 5)], [box(5, 0, 5, 40)], [box(0, 7, 30, 7)]):
        rows = zones(spark, *[(1.0, shape)] * 9)
        for strategy in ("spatial", "hybrid"):
            out = preparing.chunks(rows, strategy, Settings(chunk_size=1, min_chunk=1, max_chunk=100)).collect()
            assert {r["zone"] for r in out} == {str(i) for i in range(9)}


def test_numbers_in_the_order_of_files(spark, tmp_path):
    from terrace.functions import wkb
    from terrace.sources import vector

    for i, n in enumerate((50, 7, 120)):
        rows = spark.createDataFrame([(f"{i}-{k:03}", 1.0, [box(k, 0, k + 1, 1)]) for k in range(n, 0, -1)], "PARCEL_LID string, CAL_ACREAGE double, rings array<array<struct<x:double,y:double>>>")
        rows.coalesce(1).withColumn("geometry", wkb.encode(F.col("rings"))).drop("rings").write.mode("append").parquet(f"{tmp_path}/z{i}")
    # three files of one folder, whose names are in this order
    import shutil

    folder = tmp_path / "all"
    folder.mkdir()
    for i in range(3):
        (part,) = (tmp_path / f"z{i}").glob("part-*.parquet")
        shutil.copy(part, folder / f"part-{i}.parquet")
    read = vector.parquet(spark, str(folder), ["PARCEL_LID"], places=True)
    order = [f"{i}-{k:03}" for i, n in enumerate((50, 7, 120)) for k in range(n, 0, -1)]
    for part in (65_536, 16):
        out = preparing.numbered_as_read(read, rows_a_part=part).orderBy("processing_id").collect()
        assert [r["PARCEL_LID"] for r in out] == order and [r["processing_id"] for r in out] == list(range(177))
    some = preparing.numbered_as_read(read.where("not PARCEL_LID like '%5'"), rows_a_part=16).orderBy("processing_id").collect()
    assert [r["PARCEL_LID"] for r in some] == [x for x in order if x[-1] != "5"] and [r["processing_id"] for r in some] == list(range(len(some)))
    prepared = pipeline.prepare(read, Grid(40, 40, 1.0)).orderBy("processing_id").collect()
    assert [r["PARCEL_LID"] for r in prepared] == [x for x in order if int(x[2:]) <= 40]


def test_a_preparation_counts_in_passing(spark):
    rows = zones(spark, *[(1.0, [box(0, 0, 30, 30)])] * 5, *[(1.0, [box(900, 900, 930, 930)])] * 3, (1.0, None), (1.0, [ring((0, 0), (30, 30), (30, 0), (0, 30))]), (1.0, [box(0, 0, 1, 1)]))
    watch = {}
    out = pipeline.prepare(rows, Grid(4, 4), least_area=10.0, watch=watch)
    assert out.count() == 6
    assert pipeline.passed(watch) == [("read", 11, 0), ("repaired", 10, 1), ("clipped", 7, 3), ("large enough", 6, 1)]
