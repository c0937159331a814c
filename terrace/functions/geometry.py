"""Polygons as columns: rings are array<array<struct<x:double,y:double>>>, the first ring outside, the others holes; a ring's last point joins its first."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..config import SQUARE_METRES_AN_ACRE

RINGS = "array<array<struct<x:double,y:double>>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring_edges(ring: Column) -> Column:
    """Each point with the next one, the last with the first."""
    return F.transform(ring, lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), F.coalesce(F.get(ring, i + 1), F.get(ring, F.lit(0)))["x"].alias("x2"), F.coalesce(F.get(ring, i + 1), F.get(ring, F.lit(0)))["y"].alias("y2")))


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def ring_area(ring: Column) -> Column:
    return F.abs(F.aggregate(ring_edges(ring), F.lit(0.0), lambda a, e: a + e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def holds(ring: Column, x: Column, y: Column) -> Column:
    """Does the ring lie around the point, by the even-odd rule?"""
    across = lambda e: e["x1"] + F.try_divide((y - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"]) <= x
    return F.aggregate(ring_edges(ring), F.lit(False), lambda odd, e: odd != (((e["y1"] <= y) != (e["y2"] <= y)) & F.coalesce(across(e), F.lit(False))))


def nested(ring: Column, other: Column) -> Column:
    """Does the ring lie inside the other, where the two do not cross? Told by the middles of its first five edges, most of them, since rings may touch at points."""
    middles = F.slice(ring_edges(ring), 1, 5)
    held = F.size(F.filter(middles, lambda e: holds(other, (e["x1"] + e["x2"]) / 2, (e["y1"] + e["y2"]) / 2)))
    return (other != ring) & (2 * held > F.size(middles))


def area(rings: Column) -> Column:
    """Planar area, holes taken off: a ring inside an odd number of others is a hole, so parts of a multipolygon add up."""
    inside = lambda r: F.size(F.filter(rings, lambda other: nested(r, other)))
    signed = lambda a, r: a + ring_area(r) * (1 - 2 * (inside(r) % 2))
    return F.when(F.size(rings) == 1, ring_area(F.get(rings, F.lit(0)))).otherwise(F.aggregate(rings, F.lit(0.0), signed))


def parts(rings: Column) -> Column:
    """Rings as parts of a multipolygon, each a shell and then its holes: a ring inside an even number of others is a shell, and the holes of a shell are the rings one level deeper inside it. Null stays null."""
    placed = F.transform(rings, lambda r: F.struct(r.alias("r"), F.size(F.filter(rings, lambda other: nested(r, other))).alias("depth")))
    shells = F.filter(placed, lambda s: s["depth"] % 2 == 0)
    of = lambda s: F.transform(F.filter(placed, lambda h: (h["depth"] == s["depth"] + 1) & nested(h["r"], s["r"])), lambda h: h["r"])
    return F.when(F.size(rings) <= 1, F.filter(F.array(rings), lambda p: F.size(p) > 0)).otherwise(F.transform(shells, lambda s: F.concat(F.array(s["r"]), of(s))))


def meets_box(rings: Column, min_x: float, min_y: float, max_x: float, max_y: float) -> Column:
    """Has the polygon a point in the box: a corner of its own in there, an edge through it, or the box inside the polygon?"""
    corner = lambda p: (p["x"] >= min_x) & (p["x"] <= max_x) & (p["y"] >= min_y) & (p["y"] <= max_y)
    side = lambda e, x, y: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])

    def through(e: Column) -> Column:
        sides = [side(e, F.lit(float(x)), F.lit(float(y))) for x in (min_x, max_x) for y in (min_y, max_y)]
        near = (F.greatest(e["x1"], e["x2"]) >= min_x) & (F.least(e["x1"], e["x2"]) <= max_x) & (F.greatest(e["y1"], e["y2"]) >= min_y) & (F.least(e["y1"], e["y2"]) <= max_y)
        return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    around = F.aggregate(rings, F.lit(False), lambda odd, r: odd != holds(r, F.lit(float(min_x)), F.lit(float(min_y))))
    return F.exists(F.flatten(rings), corner) | F.exists(edges(rings), through) | around


def near_box(rings: Column, min_x: float, min_y: float, max_x: float, max_y: float, far: float) -> Column:
    """Has the polygon a point within the distance of the box? So the box grows by it on all sides, with round corners. Where polygon and box do not meet, the nearest points are an end of an edge and the box, or a corner of the box and an edge."""

    def beside(e: Column) -> Column:
        off = lambda v, low, high: F.greatest(low - v, v - high, F.lit(0.0))
        ends = [off(e[f"x{k}"], F.lit(float(min_x)), F.lit(float(max_x))) ** 2 + off(e[f"y{k}"], F.lit(float(min_y)), F.lit(float(max_y))) ** 2 for k in (1, 2)]
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]

        def corner(x: float, y: float) -> Column:
            along = F.least(F.greatest(F.coalesce(F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, dx * dx + dy * dy), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
            return (e["x1"] + along * dx - x) ** 2 + (e["y1"] + along * dy - y) ** 2

        return F.least(*ends, *[corner(float(x), float(y)) for x in (min_x, max_x) for y in (min_y, max_y)]) <= far * far

    return meets_box(rings, min_x, min_y, max_x, max_y) | F.exists(edges(rings), beside)


def reproject(rings: Column, onto=None) -> Column:
    """Longitudes and latitudes, in degrees, of all points onto a plane (the Albers projection if none is given)."""

    def moved(p: Column) -> Column:
        x, y = (onto or albers)(p["x"], p["y"])
        return point(x, y)

    return F.transform(rings, lambda r: F.transform(r, moved))


def southwards(rings: Column, north: float) -> Column:
    """Points with y counted down from the northern end, as rows of a raster are."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: point(p["x"], north - p["y"])))


def acres(rings: Column) -> Column:
    return area(rings) / SQUARE_METRES_AN_ACRE


def with_bounds(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Adds min_x, min_y, max_x and max_y (null without points), in a generator of one row, so that filters on them do not compute them again."""
    points = F.flatten(F.col(rings))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    ends = F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))
    return df.drop("min_x", "min_y", "max_x", "max_y").select("*", F.inline(F.array(ends)))


def albers(lon: Column, lat: Column, lat0: float = 23.0, lon0: float = -96.0, lat1: float = 29.5, lat2: float = 45.5) -> tuple[Column, Column]:
    """Albers equal-area conic, ellipsoidal form (Snyder, USGS PP 1395), GRS80, metres."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    q_of = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    m_of = lambda p: math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)
    p0, p1, p2 = map(math.radians, (lat0, lat1, lat2))
    n = (m_of(p1) ** 2 - m_of(p2) ** 2) / (q_of(math.sin(p2)) - q_of(math.sin(p1)))
    c = m_of(p1) ** 2 + n * q_of(math.sin(p1))
    rho0 = a * math.sqrt(c - n * q_of(math.sin(p0))) / n
    s = F.sin(F.radians(lat))
    q = (1 - e2) * (s / (1 - e2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    rho = a * F.sqrt(c - n * q) / n
    theta = n * F.radians(lon - lon0)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)
