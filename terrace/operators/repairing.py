"""Which polygons are valid, and valid ones in place of others.

Edges of a polygon meet by cells of a grid of its own, so that a polygon of very many edges is spread over tasks and no edge is compared with all others. Polygons of few edges are judged where they are.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geometry import RINGS, with_bounds
from ..sources.scratch import remove, written
from .joining import crosses

#: Up to so many edges are compared within their row, each with each; beyond, cells join. Both use the same test.
FEW = 48
KEY = "struct<a:bigint,b:bigint>"


def cleaned(rings: Column) -> Column:
    """Rings without repeated neighbouring points and closing points, and without null points."""
    known = lambda r: F.filter(r, lambda p: p.isNotNull() & p["x"].isNotNull() & p["y"].isNotNull())
    again = lambda r: F.filter(r, lambda p, i: (i == 0) | (p != F.get(r, F.greatest(i - 1, F.lit(0)))))
    opened = lambda r: F.when((F.size(r) > 1) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r)
    return F.transform(F.transform(F.transform(F.filter(rings, lambda r: r.isNotNull()), known), again), opened)


def _edges(rings: Column) -> Column:
    """Edges with their ring, place in it, the ring's number of edges, and the point after the edge (x3, y3)."""

    def of(r: Column, ring: Column) -> Column:
        at = lambda i: F.get(r, (i % F.size(r)).cast("int"))
        return F.transform(r, lambda p, i: F.struct(ring.alias("ring"), i.alias("i"), F.size(r).alias("n"), p["x"].alias("x1"), p["y"].alias("y1"), at(i + 1)["x"].alias("x2"), at(i + 1)["y"].alias("y2"), at(i + 2)["x"].alias("x3"), at(i + 2)["y"].alias("y3")))

    return F.flatten(F.transform(rings, of))


# Tests of two edges are SQL text over their names, which is quicker to build than columns.
def _turn(ax: str, ay: str, bx: str, by: str) -> str:
    return f"(({ax}) * ({by}) - ({ay}) * ({bx}))"


def _side(e: str, x: str, y: str) -> str:
    return _turn(f"{e}.x2 - {e}.x1", f"{e}.y2 - {e}.y1", f"{x} - {e}.x1", f"{y} - {e}.y1")


def _on(e: str, x: str, y: str) -> str:
    """Does the point lie on the edge?"""
    between = lambda v, c: f"{v} BETWEEN least({e}.{c}1, {e}.{c}2) AND greatest({e}.{c}1, {e}.{c}2)"
    return f"({_side(e, x, y)} = 0 AND {between(x, 'x')} AND {between(y, 'y')})"


def _properly(e: str, f: str) -> str:
    """Do two edges cross at a point inside both?"""
    apart = lambda a, b: f"signum({_side(a, f'{b}.x1', f'{b}.y1')}) * signum({_side(a, f'{b}.x2', f'{b}.y2')}) < 0"
    return f"({apart(e, f)} AND {apart(f, e)})"


def _overlap(e: str, f: str) -> str:
    """Do two edges lie on each other along some length?"""
    shared = lambda c: f"least(greatest({e}.{c}1, {e}.{c}2), greatest({f}.{c}1, {f}.{c}2)) > greatest(least({e}.{c}1, {e}.{c}2), least({f}.{c}1, {f}.{c}2))"
    return f"({_side(e, f'{f}.x1', f'{f}.y1')} = 0 AND {_side(e, f'{f}.x2', f'{f}.y2')} = 0 AND ({shared('x')} OR {shared('y')}))"


def _passes(e: str, f: str) -> str:
    """Does e's ring pass through f's at the end of e: do its two ways from there lie on different sides of f's ways?"""
    px, py = f"{e}.x2", f"{e}.y2"
    ended = f"({px} = {f}.x2 AND {py} = {f}.y2)"
    here = f"({_on(f, px, py)} AND NOT ({px} = {f}.x1 AND {py} = {f}.y1))"
    ax, ay = f"{f}.x1 - {px}", f"{f}.y1 - {py}"
    bx, by = (f"if({ended}, {f}.{c}3, {f}.{c}2) - {p}" for c, p in (("x", px), ("y", py)))
    wide = _turn(ax, ay, bx, by)

    def within(x: str, y: str) -> str:
        first, last = _turn(ax, ay, x, y), _turn(x, y, bx, by)
        return f"(CASE WHEN {wide} > 0 THEN {first} > 0 AND {last} > 0 WHEN {wide} < 0 THEN NOT ({first} <= 0 AND {last} <= 0) ELSE {first} > 0 END)"

    return f"({here} AND {within(f'{e}.x1 - {px}', f'{e}.y1 - {py}')} <> {within(f'{e}.x3 - {px}', f'{e}.y3 - {py}')})"


def _wrong(e: str, f: str) -> str:
    """Do two edges of a polygon, e before f, make it invalid? Within a ring neighbours may share their point and others none; rings may touch at points but not cross or share a length."""
    same = f"{e}.ring = {f}.ring"
    neighbours = f"{same} AND ({f}.i = {e}.i + 1 OR ({e}.i = 0 AND {f}.i = {e}.n - 1))"
    return f"({crosses(e, f)} AND (CASE WHEN {neighbours} THEN {_overlap(e, f)} WHEN {same} THEN true ELSE {_properly(e, f)} OR {_overlap(e, f)} OR {_passes(e, f)} OR {_passes(f, e)} END))"


def _before(e: str, f: str) -> str:
    return f"({e}.ring < {f}.ring OR ({e}.ring = {f}.ring AND {e}.i < {f}.i))"


def pairs(rows: DataFrame) -> DataFrame:
    """key, size (the polygon's largest coordinate), e and f: edges of a polygon (key, rings) that have a point in common, e before f; a pair that shares several cells comes several times."""
    known = with_bounds(rows.select("key", F.inline(F.array(F.struct(F.col("rings"), _edges(F.col("rings")).alias("es"))))))
    side = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("es")) / 2))
    step = lambda low, high: F.greatest((F.col(high) - F.col(low)) / F.col("side"), F.lit(1e-300))
    each = known.withColumn("side", side).withColumns({"sx": step("min_x", "max_x"), "sy": step("min_y", "max_y"), "size": F.greatest(*[F.abs(F.col(c)) for c in ("min_x", "min_y", "max_x", "max_y")])}).select("key", "size", "min_x", "min_y", "sx", "sy", "side", F.explode("es").alias("e"))
    index = lambda v, low, s: F.least(F.greatest(F.floor((v - F.col(low)) / F.col(s)), F.lit(0)), F.col("side") - 1)
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    banded = each.withColumn("j", F.explode(F.sequence(index(low, "min_y", "sy"), index(high, "min_y", "sy"))))
    at = lambda y: F.col("e.x1") + (y - F.col("e.y1")) * (F.col("e.x2") - F.col("e.x1")) / (F.col("e.y2") - F.col("e.y1"))
    # a little more than the band, since crossings at its ends are rounded
    bottom, top = (F.col("min_y") + (F.col("j") + a) * F.col("sy") for a in (-1e-6, 1 + 1e-6))
    flat = F.col("e.y1") == F.col("e.y2")
    ends = [F.when(flat, F.col(f"e.x{k}")).otherwise(at(F.least(F.greatest(y, low), high))) for k, y in ((1, bottom), (2, top))]
    margin = F.col("sx") * 1e-6
    cells = banded.withColumn("i", F.explode(F.sequence(index(F.least(*ends) - margin, "min_x", "sx"), index(F.greatest(*ends) + margin, "min_x", "sx")))).select("key", "i", "j", "size", "e")
    met = cells.join(cells.drop("size").withColumnRenamed("e", "f"), ["key", "i", "j"])
    return met.where(f"{_before('e', 'f')} AND {crosses('e', 'f')}").select("key", "size", "e", "f")


def judged(rings: Column) -> Column:
    """Is a polygon of cleaned rings not valid? Null where it has too many edges to compare each with each: its edges have to meet by cells."""
    n = F.aggregate(rings, F.lit(0), lambda a, r: a + F.size(r))
    crossed = F.expr(f"exists(es, e -> exists(es, f -> {_before('e', 'f')} AND {_wrong('e', 'f')}))")
    return F.when(F.exists(rings, lambda r: F.size(r) < 3), F.lit(True)).when(n <= FEW, crossed)


def marked(rows: DataFrame, *columns: str) -> DataFrame:
    """columns, rings and bad (see judged()) of polygons with rings, cleaned first."""
    held = F.struct(cleaned(F.col("rings")).alias("rings"))
    known = rows.select(*columns, F.inline(F.array(held))).select(*columns, "rings", _edges(F.col("rings")).alias("es"))
    # generators of one row, so that what follows does not compute the rings or their state again
    return known.select(*columns, "rings", F.inline(F.array(F.struct(judged(F.col("rings")).alias("bad")))))


def invalid(rows: DataFrame) -> DataFrame:
    """Keys (perhaps repeated) of polygons (key, rings) that are not valid: a ring of fewer than three points, or edges that cross, touch or overlap as _wrong() says. Rings stand as they nest: one inside another is its hole, one inside a hole a part of its own. Null and empty polygons are not among them, and points that follow their like are one. Interiors cut apart by rings that touch at several points are not looked for."""
    known = marked(rows, "key").where(F.size("rings") > 0)
    many = pairs(known.where("bad is null")).where(_wrong("e", "f")).select("key")
    return known.where("bad").select("key").union(many)


def noded(rows: DataFrame) -> DataFrame:
    """key, x1, y1, x2, y2: the outline of each polygon (key, rings) by the even-odd rule: edges cut wherever they meet, of pieces that lie on each other only those in odd number. What is left encloses the same points, but for new points' rounding to a 2^40th of the polygon's largest coordinate."""
    met = pairs(rows)
    both = met.unionByName(met.select("key", "size", F.col("f").alias("e"), F.col("e").alias("f")))
    # of either order the same point: the edge that comes first in its polygon is the one that is followed
    ordered = both.select("key", "size", "e", "f", F.expr(f"if({_before('e', 'f')}, struct(e AS a, f AS b), struct(f AS a, e AS b))").alias("o")).select("key", "size", "e", "f", "o.a", "o.b")
    share = f"{_turn('b.x1 - a.x1', 'b.y1 - a.y1', 'b.x2 - b.x1', 'b.y2 - b.y1')} / {_turn('a.x2 - a.x1', 'a.y2 - a.y1', 'b.x2 - b.x1', 'b.y2 - b.y1')}"
    # where three edges meet, their crossings differ in the last bits; they are rounded to one step of the polygon
    fine = "power(2, floor(log2(greatest(1e-300, size))) - 40)"
    near = lambda c: f"floor((a.{c}1 + {share} * (a.{c}2 - a.{c}1)) / {fine} + 0.5) * {fine}"
    crossing = f"if({_properly('e', 'f')}, struct({near('x')} AS x, {near('y')} AS y), NULL)"
    ends = [f"if({_on('e', f'f.x{k}', f'f.y{k}')}, struct(f.x{k} AS x, f.y{k} AS y), NULL)" for k in (1, 2)]
    cuts = ordered.select("key", F.col("e.ring").alias("ring"), F.col("e.i").alias("i"), F.explode(F.array(*map(F.expr, (crossing, *ends)))).alias("p")).where("p is not null")
    held = cuts.groupBy("key", "ring", "i").agg(F.collect_set("p").alias("ps"))
    each = rows.select("key", F.explode(_edges(F.col("rings"))).alias("e")).select("key", F.col("e.ring").alias("ring"), F.col("e.i").alias("i"), "e")
    way = lambda p: (p["x"] - F.col("e.x1")) * (F.col("e.x2") - F.col("e.x1")) + (p["y"] - F.col("e.y1")) * (F.col("e.y2") - F.col("e.y1"))
    own = F.array(*[F.struct(F.col(f"e.x{k}").alias("x"), F.col(f"e.y{k}").alias("y")) for k in (1, 2)])
    along = F.sort_array(F.transform(F.array_union(own, F.coalesce("ps", F.slice(own, 1, 0))), lambda p: F.struct(way(p).alias("t"), p["x"].alias("x"), p["y"].alias("y"))))
    cut = each.join(held, ["key", "ring", "i"], "left").withColumn("ps", along)
    pieces = cut.select("key", F.explode(F.transform(F.slice("ps", F.lit(1), F.size("ps") - 1), lambda p, k: F.struct(F.struct(p["x"], p["y"]).alias("p"), F.struct(F.get("ps", k + 1)["x"].alias("x"), F.get("ps", k + 1)["y"].alias("y")).alias("q")))).alias("s"))
    sides = pieces.select("key", F.least("s.p", "s.q").alias("p"), F.greatest("s.p", "s.q").alias("q")).where("p <> q")
    odd = sides.groupBy("key", "p", "q").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    return odd.select("key", F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("q.x").alias("x2"), F.col("q.y").alias("y2"))


def rings_of(segments: list[tuple[float, float, float, float]]) -> list[list[tuple[float, float]]]:
    """Rings whose edges are these segments, which meet at their ends alone, an even number at each. No ring has a point twice; where several meet, those follow each other that have the inside between them."""
    around = defaultdict(set)
    for x1, y1, x2, y2 in segments:
        around[x1, y1].add((x2, y2))
        around[x2, y2].add((x1, y1))
    turns = {p: sorted(qs, key=lambda q: math.atan2(q[1] - p[1], q[0] - p[0])) for p, qs in around.items()}
    place = {p: {q: k for k, q in enumerate(qs)} for p, qs in turns.items()}
    follow: dict[tuple, tuple] = {}
    seen: set[tuple] = set()
    for start in sorted(turns):
        if start in seen:
            continue
        # the leftmost point of what hangs together: west of it is outside, unless other segments lie around it
        x, y = start
        inside = sum((y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x for x1, y1, x2, y2 in segments) % 2
        todo, first = [(start, len(turns[start]) - 1, bool(inside))], {start}
        seen.add(start)
        while todo:
            p, k, inner = todo.pop()  # inner: is the sector after the k-th way inside?
            for step, q in enumerate(turns[p][k:] + turns[p][:k]):
                at, after = (k + step) % len(turns[p]), inner ^ bool(step % 2)
                if after:
                    nxt = turns[p][(at + 1) % len(turns[p])]
                    follow[q, p], follow[nxt, p] = nxt, q
                if q not in first:
                    first.add(q)
                    seen.add(q)
                    # left of the way from p is right of the way back: the sector before it there
                    todo.append((q, place[q][p] - 1, after))
    out, left = [], set(follow)
    while left:
        p, q = left.pop()
        path, spots = [p], {p: 0}
        while True:
            left.discard((p, q))
            left.discard((follow[p, q], q))
            if q in spots:
                ring = path[spots[q] :]
                for r in ring[1:]:
                    del spots[r]
                del path[spots[q] + 1 :]
                if len(ring) > 2:
                    out.append(ring)
                if len(path) == 1:
                    break
            else:
                spots[q] = len(path)
                path.append(q)
            p, q = q, follow[p, q]
    return out


def rebuilt(rows: DataFrame) -> DataFrame:
    """key and rings of polygons (key, rings) put together anew from their outlines; those that enclose nothing are missing. The tracing of one polygon's outline is all that Python does."""
    outlines = noded(rows).groupBy("key").agg(F.collect_list(F.array("x1", "y1", "x2", "y2")).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rings = [[{"x": x, "y": y} for x, y in r] for r in rings_of([tuple(s) for s in batch.column(1)[k].as_py()])]
                kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([rings], kind)], names=["key", "rings"])

    return outlines.mapInArrow(run, f"key {KEY}, rings {RINGS}").where(F.size("rings") > 0)


def repair(df: DataFrame) -> DataFrame:
    """Zones with valid polygons. Repeated neighbouring points, rings of fewer than three points and zones without a ring go; a polygon that is still not valid is put together anew, so that it covers what it covered by the even-odd rule; one that covers nothing goes. Other columns stay, and so do repeated rows; keys are digests of 128 bits of the rings themselves.

    Polygons that are not valid or have many edges are written out, judged and mended there, and joined to the zones again; the others are not shuffled for it.
    """
    names, spark = df.columns, df.sparkSession
    long_enough = F.struct(F.filter(cleaned(F.col("rings")), lambda r: F.size(r) >= 3).alias("rings"))
    rows = df.select(*[c for c in names if c != "rings"], F.inline(F.array(long_enough))).where(F.size("rings") > 0)
    keyed = rows.withColumn("__key", F.struct(F.xxhash64("rings").alias("a"), F.xxhash64(F.lit(1), "rings").alias("b")))
    doubtful, at = written(marked(keyed.select(F.col("__key").alias("key"), "rings"), "key").where("bad is null or bad").dropDuplicates(["key"]), "doubtful")
    crossed = pairs(doubtful.where("bad is null")).where(_wrong("e", "f")).select("key")
    bad, also = written(doubtful.where("bad").select("key").union(crossed).distinct(), "bad")
    mended = rebuilt(doubtful.join(bad, "key", "left_semi").select("key", "rings"))
    done, _ = written(bad.join(mended, "key", "left").select(F.col("key").alias("__key"), F.col("rings").alias("__mended"), F.lit(True).alias("__bad")), "mended")
    remove(spark, at, also)
    out = keyed.join(done, "__key", "left").withColumn("rings", F.when(F.col("__bad"), F.col("__mended")).otherwise(F.col("rings")))
    return out.where(F.col("rings").isNotNull()).select(*names)
