"""Validity, repair and the exact join of polygons against plain geometry with fractions."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from terrace.functions.geometry import RINGS, area
from terrace.operators import joining, preparing, repairing
from tests.test_zonal import box, ring, zones


def edges_of(rings):
    return [(r[i], r[(i + 1) % len(r)]) for r in rings for i in range(len(r))]


def odd(rings, x, y):
    """Does an odd number of edges lie left of the point? Exact."""
    found = False
    for (x1, y1), (x2, y2) in edges_of(rings):
        if (y1 <= y) != (y2 <= y):
            found ^= Fraction(x1) + (Fraction(y) - Fraction(y1)) * (Fraction(x2) - Fraction(x1)) / (Fraction(y2) - Fraction(y1)) <= x
    return found


def turn(a, b, c):
    v = (Fraction(b[0]) - Fraction(a[0])) * (Fraction(c[1]) - Fraction(a[1])) - (Fraction(b[1]) - Fraction(a[1])) * (Fraction(c[0]) - Fraction(a[0]))
    return (v > 0) - (v < 0)


def cross(e, f):
    (a, b), (c, d) = e, f
    near = all(min(a[i], b[i]) <= max(c[i], d[i]) and min(c[i], d[i]) <= max(a[i], b[i]) for i in (0, 1))
    return near and turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0


def polygons(spark, shapes):
    return spark.createDataFrame([(str(i), s) for i, s in enumerate(shapes)], f"name string, rings {RINGS}")


def bad(spark, shapes):
    rows = polygons(spark, shapes).select(F.col("name").alias("key"), repairing.cleaned(F.col("rings")).alias("rings"))
    return {int(r["key"]) for r in repairing.invalid(rows).collect()}


SHAPES = {
    "square": ([box(0, 0, 10, 10)], True),
    "repeated points": ([ring((0, 0), (0, 0), (10, 0), (10, 10), (0, 10), (0, 0))], True),
    "bow tie": ([ring((0, 0), (10, 10), (10, 0), (0, 10))], False),
    "spike": ([ring((0, 0), (10, 0), (10, 10), (10, 20), (10, 10), (0, 10))], False),
    "touches itself at a point": ([ring((0, 0), (10, 0), (10, 10), (5, 0), (0, 10))], False),
    "point twice": ([ring((0, 0), (5, 5), (10, 0), (10, 10), (5, 5), (0, 10))], False),
    "hole": ([box(0, 0, 10, 10), box(2, 2, 4, 4)], True),
    "hole touches at a point": ([box(0, 0, 10, 10), ring((0, 5), (4, 3), (4, 7))], True),
    "hole at a corner": ([box(0, 0, 10, 10), ring((0, 0), (4, 2), (2, 4))], True),
    "hole shares an edge": ([box(0, 0, 10, 10), box(0, 2, 4, 4)], False),
    "hole crosses": ([box(0, 0, 10, 10), box(8, 2, 14, 4)], False),
    "hole crosses at points of both": ([ring((0, 0), (10, 0), (10, 5), (10, 10), (0, 10)), ring((5, 5), (10, 5), (12, 6), (10, 10), (5, 9))], False),
    "crosses through corners": ([ring((0, 0), (8, 0), (8, 8), (0, 8)), ring((4, 4), (8, 0), (12, 4), (8, 8))], False),
    "two parts": ([box(0, 0, 10, 10), box(20, 0, 30, 10)], True),
    "parts touch at a corner": ([box(0, 0, 10, 10), box(10, 10, 30, 20)], True),
    "parts share a border": ([box(0, 0, 10, 10), box(10, 0, 30, 10)], False),
    "same ring twice": ([box(0, 0, 10, 10), box(0, 0, 10, 10)], False),
    "two points": ([ring((0, 0), (5, 5))], False),
    "line there and back": ([ring((0, 0), (5, 5), (9, 9))], False),
}


@pytest.mark.parametrize("few", [48, 0])
def test_validity(spark, monkeypatch, few):
    monkeypatch.setattr(repairing, "FEW", few)  # 0: all by cells
    names = list(SHAPES)
    assert {names[i] for i in bad(spark, [s for s, _ in SHAPES.values()])} == {n for n, (_, valid) in SHAPES.items() if not valid}


@pytest.mark.parametrize("few", [48, 0])
def test_validity_of_single_rings_against_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(repairing, "FEW", few)
    rng = random.Random(few)
    shapes = []
    for _ in range(150):
        points = [(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(rng.randint(3, 7))]
        shapes.append([ring(*[p for i, p in enumerate(points) if p != points[i - 1]])])
    shapes = [s for s in shapes if len(s[0]) >= 3]

    def wrong(r):
        es = edges_of([r])
        for i, e in enumerate(es):
            for j in range(i + 1, len(es)):
                if j == i + 1 or (i == 0 and j == len(es) - 1):
                    first, last = (es[i], es[j]) if j == i + 1 else (es[j], es[i])
                    (a, b), (_, c) = first, last
                    if turn(a, b, c) == 0 and (a[0] - b[0]) * (c[0] - b[0]) + (a[1] - b[1]) * (c[1] - b[1]) > 0:
                        return True
                elif cross(e, es[j]):
                    return True
        return False

    expected = {i for i, s in enumerate(shapes) if wrong(s[0])}
    assert bad(spark, shapes) == expected and 20 < len(expected) < len(shapes) - 5


def test_validity_of_a_polygon_of_many_edges(spark):
    import math

    round_ = [(1000 * math.cos(k * math.tau / 20_000), 1000 * math.sin(k * math.tau / 20_000)) for k in range(20_000)]
    knotted = list(round_)
    knotted[7000], knotted[7001] = knotted[7001], knotted[7000]
    assert bad(spark, [[round_], [knotted]]) == {1}


def repaired(spark, shapes):
    out = repairing.repair(polygons(spark, shapes)).withColumn("area", area(F.col("rings"))).collect()
    return {int(r["name"]): ([[tuple(p) for p in x] for x in r["rings"]], r["area"]) for r in out}


def test_repair_of_known_shapes(spark):
    names = list(SHAPES)
    got = repaired(spark, [s for s, _ in SHAPES.values()])
    areas = {names[i]: a for i, (_, a) in got.items()}
    assert areas == {"square": 100, "repeated points": 100, "bow tie": 50, "spike": 100, "touches itself at a point": 50, "point twice": 50, "hole": 96, "hole touches at a point": 92, "hole at a corner": 94, "hole shares an edge": 92, "hole crosses": 96 + 8, "hole crosses at points of both": 100 + areas_beyond(), "crosses through corners": 64 - 16 + 16, "two parts": 200, "parts touch at a corner": 300, "parts share a border": 300}
    assert not bad(spark, [r for r, _ in got.values()])
    assert len(got[names.index("bow tie")][0]) == 2 and len(got[names.index("parts share a border")][0]) == 1
    for n in ("square", "hole", "hole at a corner", "two parts"):  # valid ones stay as they are
        assert got[names.index(n)][0] == SHAPES[n][0]


def areas_beyond():
    """Of the ring inside the square: what lies beyond it counts, what lies in it is a hole."""
    inner = [(5, 5), (10, 5), (10, 10), (5, 9)]
    whole = [(5, 5), (10, 5), (12, 6), (10, 10), (5, 9)]
    size = lambda r: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1]))) / 2
    return size(whole) - 2 * size(inner)


def test_repair_covers_the_same_points(spark):
    rng = random.Random(6)
    shapes = []
    for k in range(60):
        size = rng.choice([8, 40])
        shapes.append([ring(*[(rng.randint(0, size), rng.randint(0, size)) for _ in range(rng.randint(3, 9))]) for _ in range(1 + k % 3)])
    got = repaired(spark, shapes)
    for i, shape in enumerate(shapes):
        for _ in range(60):
            x, y = Fraction(rng.randint(0, 4000), 99), Fraction(rng.randint(0, 4000), 101)
            assert odd(shape, x, y) == (i in got and odd(got[i][0], x, y))
    assert not bad(spark, [r for r, _ in got.values()])


def test_repair_keeps_rows_and_columns(spark):
    rows = spark.createDataFrame([("a", "k1", [box(0, 0, 2, 2)]), ("a", "k1", [box(0, 0, 2, 2)]), ("b", "k2", [ring((0, 0), (10, 10), (10, 0), (0, 10))]), ("c", "k3", None), ("d", "k4", []), ("e", "k5", [ring((0, 0), (1, 1))])], f"zone string, other string, rings {RINGS}")
    out = repairing.repair(rows)
    assert out.columns == ["zone", "other", "rings"] and sorted((r["zone"], r["other"], len(r["rings"])) for r in out.collect()) == [("a", "k1", 1), ("a", "k1", 1), ("b", "k2", 2)]
    assert tuple(preparing.validity(rows).first()) == (1, 1, 2, 2) and repairing.repair(rows.where("false")).count() == 0


def test_polygon_join_against_plain_geometry(spark, monkeypatch):
    monkeypatch.setattr(joining, "AIM", 8)  # so that cells are split
    rng = random.Random(3)
    some = lambda n, size, spread: [[ring(*[(x + rng.randint(0, size), y + rng.randint(0, size)) for _ in range(rng.randint(3, 6))])] + ([box(x + size // 4, y + size // 4, x + size // 2, y + size // 2)] if rng.random() < 0.4 else []) for x, y in ((rng.randint(0, spread), rng.randint(0, spread)) for _ in range(n))]
    a = [*some(60, 12, 100), *some(40, 4, 20), [box(-50, -50, -40, -40)], None, [], [box(0, 0, 100, 100), box(1, 1, 99, 99)], [box(40, 40, 41, 41)]]
    b = [*some(25, 40, 90), [box(-500, -500, 500, 500)], [box(-9, -9, 500, 500), box(-8, -8, 400, 400)], [box(10, 10, 12, 12)], None]

    def meet(s, t):
        if not s or not t:
            return False
        return any(cross(e, f) for e in edges_of(s) for f in edges_of(t)) or any(odd(t, *r[0]) for r in s) or any(odd(s, *r[0]) for r in t)

    expected = {(str(i), str(j)) for i, s in enumerate(a) for j, t in enumerate(b) if meet(s, t)}
    out = joining.intersecting(polygons(spark, a), polygons(spark, b), "name", "name")
    assert out.columns == ["name", "other_name"]
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    assert joining.intersecting(polygons(spark, a).where("false"), polygons(spark, b), "name", "name").count() == 0


def test_boundaries_are_looked_up(spark):
    rows = spark.createDataFrame([("41", "A"), ("41", "B"), ("42", "A")], "STATEFP string, NAME string")
    assert joining.boundary(rows, STATEFP="41", NAME=["A", "C"]).count() == 1
    with pytest.raises(ValueError, match="no boundary"):
        joining.boundary(rows, STATEFP="43")


def test_parts_are_saved_and_loaded_again(spark, tmp_path):
    import json
    import struct

    from terrace.functions import wkb
    from terrace.functions.geometry import parts
    from terrace.operators import sinks
    from terrace.sources import vector

    shapes = [[box(0, 0, 9, 9)], [box(0, 0, 9, 9), box(20, 0, 30, 9)], [box(0, 0, 9, 9), box(1, 1, 2, 2), box(5, 5, 6, 6)], [box(2, 2, 3, 3), box(20, 0, 90, 70), box(0, 0, 9, 9), box(30, 10, 60, 60), box(40, 20, 50, 50), box(41, 21, 42, 22)], [box(0, 0, 8, 8), ring((4, 0), (8, 4), (4, 8), (0, 4))], None, []]
    tree = lambda ps: ps and sorted((p[0], sorted(p[1:])) for p in ([[tuple(q) for q in r] for r in p] for p in ps))
    rows = zones(spark, *[(float(i), s) for i, s in enumerate(shapes)])
    found = {r["zone"]: tree(r["p"]) for r in rows.select("zone", parts(F.col("rings")).alias("p")).collect()}
    assert found == {"0": [(shapes[0][0], [])], "1": [(r, []) for r in shapes[1]], "2": [(shapes[2][0], shapes[2][1:])], "3": sorted([(box(0, 0, 9, 9), [box(2, 2, 3, 3)]), (box(20, 0, 90, 70), [box(30, 10, 60, 60)]), (box(40, 20, 50, 50), [box(41, 21, 42, 22)])]), "4": [(shapes[4][0], [shapes[4][1]])], "5": None, "6": []}
    kinds = {r["zone"]: bytes(r["g"])[:9] for r in rows.select("zone", wkb.encode(F.col("rings")).alias("g")).where("g is not null").collect()}
    assert kinds == {z: struct.pack(">BII", 0, *k) for z, k in {"0": (3, 1), "1": (6, 2), "2": (3, 3), "3": (6, 3), "4": (3, 2), "6": (3, 0)}.items()}
    for fmt in ("parquet", "geojson"):
        path = sinks.save(rows.drop("zone"), str(tmp_path), fmt)
        again = vector.load(spark, path).select("PARCEL_LID", parts(F.col("rings")).alias("p")).collect()
        assert {r["PARCEL_LID"]: tree(r["p"]) or None for r in again} == {z: t or None for z, t in found.items()}
        if fmt == "geojson":
            lines = {json.loads(r[0])["properties"]["PARCEL_LID"]: json.loads(r[0])["geometry"] for r in spark.read.text(path).collect()}
            assert {z: g and g["type"] for z, g in lines.items()} == {"0": "Polygon", "1": "MultiPolygon", "2": "Polygon", "3": "MultiPolygon", "4": "Polygon", "5": None, "6": "MultiPolygon"}
            assert len(lines["3"]["coordinates"]) == 3 and lines["0"]["coordinates"][0][0] == lines["0"]["coordinates"][0][-1]


def test_distance_to_a_box_is_round(spark):
    from terrace.functions.geometry import near_box

    shapes = [[box(13, 14, 20, 20)], [box(13.01, 14, 20, 20)], [box(15, 2, 20, 3)], [box(15.01, 2, 20, 3)], [ring((10, 17), (17, 10), (20, 20))], [ring((10, 17.1), (17.1, 10), (20, 20))], [box(-50, -50, 50, 50)], [box(-50, -50, 50, 50), box(-6, -6, 16, 16)], [ring((-50, 5), (50, 4), (50, 6))]]
    found = [r["m"] for r in zones(spark, *[(1.0, s) for s in shapes]).select("k", near_box(F.col("rings"), 0, 0, 10, 10, 5).alias("m")).orderBy("k").collect()]
    assert found == [True, False, True, False, True, False if 7.1 / 2**0.5 > 5 else True, True, False, True]


def test_tables_are_saved(spark, tmp_path):
    from terrace.operators import sinks

    for n in (3, 2):  # the second takes the place of the first
        path = sinks.save_table(spark.range(n), str(tmp_path), "shares")
    assert path.endswith("/shares.csv") and spark.read.option("header", True).csv(path).count() == 2
