"""Planar geometry columns.

A geometry is ``struct<kind, srid, parts>``; ``parts`` is an array of vertex
arrays: points hold one vertex per part, lines one line per part, polygons one
closed ring per part (outer rings counter-clockwise, holes clockwise).
Everything here is a column expression that stays in the JVM; only the WKB
conversion at the edges uses Arrow batches.
"""

from __future__ import annotations

import math
import struct as _struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from .text import col

VERTEX = "struct<x:double,y:double>"
PARTS = f"array<array<{VERTEX}>>"
GEOM = f"struct<kind:string,srid:int,parts:{PARTS}>"
VERTEX_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOM_TYPE = T.StructType([T.StructField("kind", T.StringType()), T.StructField("srid", T.IntegerType()),
                          T.StructField("parts", T.ArrayType(T.ArrayType(VERTEX_TYPE)))])

POLYGONS = ("POLYGON", "MULTIPOLYGON")
LINES = ("LINESTRING", "MULTILINESTRING")
POINTS = ("POINT", "MULTIPOINT")


# -- building -------------------------------------------------------------

def num(v) -> Column:
    return v.cast("double") if isinstance(v, Column) else (
        F.col(v).cast("double") if isinstance(v, str) else F.lit(float(v)))


def vertex(x, y) -> Column:
    return F.struct(num(x).alias("x"), num(y).alias("y"))


def geom(kind: str | Column, parts: Column, srid: int | Column = 25832) -> Column:
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    srid = srid if isinstance(srid, Column) else F.lit(srid)
    return F.when(parts.isNotNull(), F.struct(kind.alias("kind"), srid.cast("int").alias("srid"), parts.alias("parts")))


def point(x, y, srid=25832) -> Column:
    x, y = num(x), num(y)
    return F.when(x.isNotNull() & y.isNotNull(), geom("POINT", F.array(F.array(vertex(x, y))), srid))


def line(vertices: Column, srid=25832) -> Column:
    return geom("LINESTRING", F.array(vertices), srid)


def ring_rect(x0, y0, x1, y1) -> Column:
    return F.array(vertex(x0, y0), vertex(x1, y0), vertex(x1, y1), vertex(x0, y1), vertex(x0, y0))


def rectangle(x0, y0, x1, y1, srid=25832) -> Column:
    return geom("POLYGON", F.array(ring_rect(x0, y0, x1, y1)), srid)


def kind(g) -> Column:
    return col(g)["kind"]


def is_polygon(g) -> Column:
    return kind(g).isin(*POLYGONS)


def is_line(g) -> Column:
    return kind(g).isin(*LINES)


def is_point(g) -> Column:
    return kind(g).isin(*POINTS)


def multi(g) -> Column:
    """Same geometry under its multi kind."""
    g = col(g)
    k = F.when(g["kind"].startswith("MULTI"), g["kind"]).otherwise(F.concat(F.lit("MULTI"), g["kind"]))
    return F.when(g.isNotNull(), F.struct(k.alias("kind"), g["srid"].alias("srid"), g["parts"].alias("parts")))


def vertices(g) -> Column:
    return F.flatten(col(g)["parts"])


def let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once per row, not once per use."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


# -- measures -------------------------------------------------------------

def total(arr: Column, f) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda s, e: s + f(e))


def segments(part: Column) -> Column:
    """Edges of one vertex array as structs a, b."""
    n = F.size(part)
    edge = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    return F.when(n >= 2, F.zip_with(F.slice(part, 1, F.greatest(n - 1, F.lit(0))),
                                     F.slice(part, 2, F.greatest(n - 1, F.lit(0))), edge)
                  ).otherwise(F.slice(F.zip_with(part, part, edge), 1, 0))


def edges(g) -> Column:
    """All edges of a geometry; a point gives one edge of no length."""
    g = col(g)
    pointy = F.transform(F.flatten(g["parts"]), lambda p: F.struct(p.alias("a"), p.alias("b")))
    return F.when(is_point(g), pointy).otherwise(F.flatten(F.transform(g["parts"], segments)))


def dist(ax, ay, bx, by) -> Column:
    return F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))


def seg_length(e: Column) -> Column:
    return dist(e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"])


def ring_area2(ring: Column) -> Column:
    """Twice the signed area, relative to the first vertex."""
    def shoelace(o):
        cross = lambda e: ((e["a"]["x"] - o["x"]) * (e["b"]["y"] - o["y"])
                           - (e["b"]["x"] - o["x"]) * (e["a"]["y"] - o["y"]))
        return total(segments(ring), cross)

    return let(start_vertex(ring), shoelace)


def area(g) -> Column:
    g = col(g)
    return F.when(is_polygon(g), F.abs(total(F.transform(g["parts"], ring_area2), lambda a: a)) / 2).when(
        g.isNotNull(), F.lit(0.0))


def length(g) -> Column:
    g = col(g)
    return F.when(is_line(g), total(edges(g), seg_length)).when(g.isNotNull(), F.lit(0.0))


def perimeter(g) -> Column:
    return total(edges(g), seg_length)


def npoints(g) -> Column:
    return F.size(vertices(g))


def bbox(g) -> Column:
    """Struct xmin, ymin, xmax, ymax."""
    def box(v):
        xs, ys = F.transform(v, lambda p: p["x"]), F.transform(v, lambda p: p["y"])
        return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))

    return let(vertices(g), box)


def centroid(g) -> Column:
    """Centre of mass by the highest dimension present; fallback mean vertex."""
    g = col(g)
    v = vertices(g)

    def weighted(o, es, weight, share):
        zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

        def step(s, e):
            return let(weight(e), lambda w: F.struct(
                (s["w"] + w).alias("w"),
                (s["x"] + w * (e["a"]["x"] + e["b"]["x"] - 2 * o["x"]) / share).alias("x"),
                (s["y"] + w * (e["a"]["y"] + e["b"]["y"] - 2 * o["y"]) / share).alias("y")))

        return F.aggregate(es, zero, step)

    def place(o):
        cross = lambda e: ((e["a"]["x"] - o["x"]) * (e["b"]["y"] - o["y"])
                           - (e["b"]["x"] - o["x"]) * (e["a"]["y"] - o["y"]))
        at = lambda s: point(s["x"] / s["w"] + o["x"], s["y"] / s["w"] + o["y"], g["srid"])
        mean = point(total(v, lambda p: p["x"] - o["x"]) / F.size(v) + o["x"],
                     total(v, lambda p: p["y"] - o["y"]) / F.size(v) + o["y"], g["srid"])
        by_area = let(weighted(o, edges(g), cross, 3), lambda s: F.when(F.abs(s["w"]) > 1e-9, at(s)))
        by_line = let(weighted(o, edges(g), seg_length, 2), lambda s: F.when(s["w"] > 0, at(s)))
        return F.coalesce(F.when(is_polygon(g), by_area), F.when(~is_point(g), by_line), mean)

    return F.when(F.size(v) > 0, let(start_vertex(v), place))


def point_on_surface(g) -> Column:
    """Middle of the widest inside span on a horizontal scan line, fallback centroid."""
    g = col(g)

    def scan_height(ys):
        mid = (F.array_min(ys) + F.array_max(ys)) / 2
        below = F.array_max(F.filter(ys, lambda y: y <= mid))
        above = F.array_min(F.filter(ys, lambda y: y > mid))
        return (below + above) / 2  # never through a vertex

    def widest(y):
        crossed = F.filter(edges(g), lambda e: (e["a"]["y"] < y) != (e["b"]["y"] < y))
        xs = F.array_sort(F.transform(crossed, lambda e: e["a"]["x"] + (y - e["a"]["y"])
                                      * (e["b"]["x"] - e["a"]["x"]) / (e["b"]["y"] - e["a"]["y"])))
        half = lambda xs, r: F.filter(F.transform(xs, lambda x, i: F.when(i % 2 == r, x)), lambda x: x.isNotNull())
        span = lambda a, b: F.struct((b - a).alias("w"), ((a + b) / 2).alias("x"))
        best = let(xs, lambda xs: F.array_max(F.zip_with(half(xs, 0), half(xs, 1), span)))
        return let(best, lambda s: F.when(s.isNotNull(), point(s["x"], y, g["srid"])))

    heights = F.array_distinct(F.transform(vertices(g), lambda p: p["y"]))
    inside = let(let(heights, scan_height), widest)
    return F.coalesce(F.when(is_polygon(g), inside), centroid(g))


# -- transforms -----------------------------------------------------------

def map_vertices(g, f) -> Column:
    g = col(g)
    moved = F.transform(g["parts"], lambda part: F.transform(part, f))
    return F.when(g.isNotNull(), F.struct(g["kind"].alias("kind"), g["srid"].alias("srid"), moved.alias("parts")))


def translate(g, dx, dy) -> Column:
    dx, dy = num(dx), num(dy)
    return map_vertices(g, lambda p: vertex(p["x"] + dx, p["y"] + dy))


def rotate(g, angle, x0, y0) -> Column:
    """Counter-clockwise about a point, radians."""
    a, x0, y0 = num(angle), num(x0), num(y0)
    c, s = F.cos(a), F.sin(a)
    return map_vertices(g, lambda p: vertex(
        x0 + (p["x"] - x0) * c - (p["y"] - y0) * s, y0 + (p["x"] - x0) * s + (p["y"] - y0) * c))


def snap(g, grid: float = 0.001) -> Column:
    inv = round(1 / grid)
    on = lambda v: F.rint(v * F.lit(float(inv))) / F.lit(float(inv))
    return map_vertices(g, lambda p: vertex(on(p["x"]), on(p["y"])))


def drop_z(xyz_parts: Column, kind_: str, srid=25832) -> Column:
    """Flatten x/y/z vertices to the plane."""
    return geom(kind_, F.transform(xyz_parts, lambda part: F.transform(part, lambda p: vertex(p["x"], p["y"]))), srid)


def drop_repeated(part: Column) -> Column:
    """Remove vertices equal to their predecessor."""
    return F.filter(part, lambda p, i: (i == 0) | (p["x"] != F.get(part, i - 1)["x"]) | (p["y"] != F.get(part, i - 1)["y"]))


def part_geoms(g) -> Column:
    """Array of single geometries: one per point or line, one per outer ring with its holes."""
    g = col(g)
    single = F.regexp_replace(g["kind"], "^MULTI", "")
    wrap = lambda parts: F.struct(single.alias("kind"), g["srid"].alias("srid"), parts.alias("parts"))
    simple = F.transform(g["parts"], lambda p: wrap(F.array(p)))
    outer = F.filter(g["parts"], lambda r: ring_area2(r) > 0)
    holes = F.filter(g["parts"], lambda r: ring_area2(r) <= 0)
    polys = F.transform(outer, lambda o: wrap(F.concat(
        F.array(o), F.filter(holes, lambda h: in_ring(o, h[0]["x"], h[0]["y"])))))
    return F.when(is_polygon(g), polys).otherwise(simple)


# -- lines ----------------------------------------------------------------

def start_vertex(part: Column) -> Column:
    return F.get(part, F.lit(0))


def end_vertex(part: Column) -> Column:
    return F.element_at(part, -1)


def azimuth(a: Column, b: Column) -> Column:
    """Clockwise from north, 0 to 2 pi; null for equal points."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    t = F.atan2(dx, dy)
    return F.when((dx != 0) | (dy != 0), F.when(t < 0, t + 2 * math.pi).otherwise(t))


def part_length(part: Column) -> Column:
    return total(segments(part), seg_length)


def interpolate(part: Column, fraction: Column, whole: Column | None = None) -> Column:
    """Vertex at a fraction of the line's length, which is ``whole`` where it is known."""
    share = F.least(F.greatest(num(fraction), F.lit(0.0)), F.lit(1.0))

    def walk(want):
        first = start_vertex(part)
        zero = F.struct(F.lit(0.0).alias("s"), first["x"].alias("x"), first["y"].alias("y"), (want <= 0).alias("hit"))

        def step(st, e):
            def advance(ln):
                t = (want - st["s"]) / ln
                hit = (ln > 0) & (st["s"] + ln >= want)
                return F.when(hit, F.struct((st["s"] + ln).alias("s"), (e["a"]["x"] + (e["b"]["x"] - e["a"]["x"]) * t).alias("x"),
                                            (e["a"]["y"] + (e["b"]["y"] - e["a"]["y"]) * t).alias("y"), F.lit(True).alias("hit"))
                              ).otherwise(F.struct((st["s"] + ln).alias("s"), e["b"]["x"].alias("x"), e["b"]["y"].alias("y"),
                                                   F.lit(False).alias("hit")))

            return F.when(st["hit"], st).otherwise(let(seg_length(e), advance))

        return let(F.aggregate(segments(part), zero, step), lambda st: vertex(st["x"], st["y"]))

    return let(share * (part_length(part) if whole is None else whole), walk)


def offset_line(part: Column, offs) -> Column:
    """Parallel line: left for positive, right and reversed for negative distance.

    Repeated vertices are skipped, corners are mitred, and where neighbouring
    edges run parallel the end point of the shifted edge is taken.  A line
    without length comes back unchanged.
    """
    d = num(offs)

    def normal(e):
        return let(seg_length(e), lambda ln: F.struct((-(e["b"]["y"] - e["a"]["y"]) / ln).alias("x"),
                                                      ((e["b"]["x"] - e["a"]["x"]) / ln).alias("y")))

    def shift(clean):
        n = F.size(clean)

        def corners(normals):
            def corner(p, i):
                before, after = F.get(normals, F.greatest(i - 1, F.lit(0))), F.get(normals, F.least(i, n - 2))

                def mitre(k):
                    plain = vertex(p["x"] + d * before["x"], p["y"] + d * before["y"])
                    return F.when(k > 1e-9, vertex(p["x"] + d * (before["x"] + after["x"]) / k,
                                                   p["y"] + d * (before["y"] + after["y"]) / k)).otherwise(plain)

                return let(F.lit(1.0) + before["x"] * after["x"] + before["y"] * after["y"], mitre)

            return F.transform(clean, corner)

        moved = let(F.transform(segments(clean), normal), corners)
        return F.when((n < 2) | (d == 0), part).when(d < 0, F.reverse(moved)).otherwise(moved)

    return let(drop_repeated(part), shift)


def flat_buffer(part: Column, width, srid=25832) -> Column:
    """Polygon around a line without caps: left side forward, right side back."""
    w = num(width)
    both = F.concat(offset_line(part, -w), offset_line(part, w))
    ring = let(both, lambda r: F.concat(r, F.slice(r, 1, 1)))
    return F.when(part_length(part) > 0, geom("POLYGON", F.array(let(ring, lambda r: oriented(r))), srid))


# -- predicates -----------------------------------------------------------

def oriented(ring: Column, ccw: bool = True) -> Column:
    a = ring_area2(ring)
    return F.when((a < 0) if ccw else (a > 0), F.reverse(ring)).otherwise(ring)


def _crossings(es: Column, x: Column, y: Column) -> Column:
    right = lambda e: e["a"]["x"] + (y - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"]) / (e["b"]["y"] - e["a"]["y"])
    crossed = lambda e: ((e["a"]["y"] <= y) != (e["b"]["y"] <= y)) & (right(e) > x)
    return F.size(F.filter(es, crossed))


def on_segment(e: Column, x: Column, y: Column, eps: float = 1e-9) -> Column:
    cross = (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])
    return ((F.abs(cross) <= eps) & x.between(F.least(e["a"]["x"], e["b"]["x"]), F.greatest(e["a"]["x"], e["b"]["x"]))
            & y.between(F.least(e["a"]["y"], e["b"]["y"]), F.greatest(e["a"]["y"], e["b"]["y"])))


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    return let(segments(ring), lambda es: (_crossings(es, x, y) % 2 == 1) | F.exists(es, lambda e: on_segment(e, x, y)))


def covers_point(g, x, y) -> Column:
    """Point inside a polygon or on its border."""
    x, y = num(x), num(y)
    return let(edges(g), lambda es: (_crossings(es, x, y) % 2 == 1) | F.exists(es, lambda e: on_segment(e, x, y)))


def segment_distance(e: Column, x: Column, y: Column) -> Column:
    dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
    l2 = dx * dx + dy * dy
    t = F.when(l2 > 0, ((x - e["a"]["x"]) * dx + (y - e["a"]["y"]) * dy) / l2).otherwise(0.0)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return let(t, lambda t: dist(e["a"]["x"] + t * dx, e["a"]["y"] + t * dy, x, y))


def distance_to_point(g, x, y) -> Column:
    """Zero inside a polygon, else the distance to the nearest edge."""
    x, y = num(x), num(y)
    near = F.array_min(F.transform(edges(g), lambda e: segment_distance(e, x, y)))
    return F.when(is_polygon(g) & covers_point(g, x, y), F.lit(0.0)).otherwise(near)


def distance(g, h) -> Column:
    """Smallest distance of two geometries, zero when they meet."""
    g, h = col(g), col(h)
    near = lambda a, b: F.array_min(F.transform(vertices(a), lambda v: F.array_min(
        F.transform(edges(b), lambda e: segment_distance(e, v["x"], v["y"])))))
    spot = lambda a: is_point(a) & (npoints(a) == 1)
    direct = let(vertices(g)[0], lambda p: let(vertices(h)[0], lambda q: dist(p["x"], p["y"], q["x"], q["y"])))
    return F.when(spot(g) & spot(h), direct).when(intersects(g, h), F.lit(0.0)).otherwise(F.least(near(g, h), near(h, g)))


# -- polygons shrunk by a distance ------------------------------------------

#: Slack of the clearance, so that an edge does not hide its own copy.
CLEAR = 1e-9


def frames(g) -> Column:
    """Edges of positive length: part number, first vertex, unit direction, length; the inside lies to the left."""
    g = col(g)
    turned = lambda ring, k: F.when(g["kind"] != "POLYGON", ring).when(k == 0, oriented(ring)).otherwise(oriented(ring, False))

    def one(e, k):
        return let(seg_length(e), lambda n: F.when(n > 0, F.struct(
            k.alias("part"), e["a"]["x"].alias("ax"), e["a"]["y"].alias("ay"),
            ((e["b"]["x"] - e["a"]["x"]) / n).alias("wx"), ((e["b"]["y"] - e["a"]["y"]) / n).alias("wy"), n.alias("m"))))

    every = F.flatten(F.transform(g["parts"], lambda ring, k: F.transform(segments(turned(ring, k)), lambda e: one(e, k))))
    return F.filter(every, lambda f: f.isNotNull())


def hidden_span(e: Column, f: Column, d: float) -> Column:
    """Part ``lo..hi`` of the copy of frame ``e`` moved ``d`` inwards that is nearer than ``d`` to frame ``f``, else null.

    The points near an edge form a convex strip with round ends, so what it
    takes from a line is one span: the hull of those of the strip and of its two ends.
    """
    r = d - CLEAR

    def slab(q, k, lo, hi):
        """Span of t with lo < q + k t < hi; the whole line as two large numbers."""
        u, v = (lo - q) / k, (hi - q) / k
        return F.when(F.abs(k) > 1e-12, F.struct(F.least(u, v).alias("lo"), F.greatest(u, v).alias("hi"))).when(
            (q > lo) & (q < hi), F.struct(F.lit(-1e300).alias("lo"), F.lit(1e300).alias("hi")))

    def disc(s, q):
        b = s * q["s1"] + q["h0"] * q["h1"]
        return let(F.struct(b.alias("b"), (b * b - s * s - q["h0"] * q["h0"] + r * r).alias("w")), lambda c: F.when(
            c["w"] > 0, F.struct((-c["b"] - F.sqrt(c["w"])).alias("lo"), (-c["b"] + F.sqrt(c["w"])).alias("hi"))))

    def both(t):
        lo, hi = F.greatest(t["u"]["lo"], t["v"]["lo"]), F.least(t["u"]["hi"], t["v"]["hi"])
        return F.when(t["u"].isNotNull() & t["v"].isNotNull() & (lo < hi), F.struct(lo.alias("lo"), hi.alias("hi")))

    def spans(q):
        strip = let(F.struct(slab(q["s0"], q["s1"], F.lit(0.0), f["m"]).alias("u"),
                             slab(q["h0"], q["h1"], F.lit(-r), F.lit(r)).alias("v")), both)
        return let(F.struct(strip.alias("u"), disc(q["s0"], q).alias("v"), disc(q["s0"] - f["m"], q).alias("w")), hull)

    def hull(t):
        lo, hi = F.least(*[t[n]["lo"] for n in "uvw"]), F.greatest(*[t[n]["hi"] for n in "uvw"])
        return F.when((hi > 0) & (lo < e["m"]) & (lo < hi), F.struct(
            F.greatest(lo, F.lit(0.0)).alias("lo"), F.least(hi, e["m"]).alias("hi")))

    # the moved start of e and its direction, seen from the start of f along f
    qx, qy = e["ax"] - e["wy"] * d - f["ax"], e["ay"] + e["wx"] * d - f["ay"]
    seen = F.struct((qx * f["wx"] + qy * f["wy"]).alias("s0"), (qy * f["wx"] - qx * f["wy"]).alias("h0"),
                    (e["wx"] * f["wx"] + e["wy"] * f["wy"]).alias("s1"), (e["wy"] * f["wx"] - e["wx"] * f["wy"]).alias("h1"))
    return let(seen, spans)


def free_pieces(e: Column, spans: Column, d: float) -> Column:
    """What the sorted ``spans`` leave of the copy of frame ``e`` moved ``d`` inwards: structs part, a, b."""
    zero = F.struct(F.lit(0.0).alias("at"), F.array().cast("array<struct<lo:double,hi:double>>").alias("out"))
    gap = lambda lo, hi: F.array(F.struct(lo.alias("lo"), hi.alias("hi")))
    step = lambda s, t: F.struct(F.greatest(s["at"], t["hi"]).alias("at"), F.when(
        t["lo"] - s["at"] > 1e-7, F.concat(s["out"], gap(s["at"], t["lo"]))).otherwise(s["out"]).alias("out"))
    left = F.aggregate(spans, zero, step, lambda s: F.when(
        e["m"] - s["at"] > 1e-7, F.concat(s["out"], gap(s["at"], e["m"]))).otherwise(s["out"]))
    place = lambda t: vertex(e["ax"] - e["wy"] * d + e["wx"] * t, e["ay"] + e["wx"] * d + e["wy"] * t)
    return F.transform(left, lambda t: F.struct(e["part"].alias("part"), place(t["lo"]).alias("a"), place(t["hi"]).alias("b")))


def frames_close(e: Column, f: Column, d: float) -> Column:
    """Cheap test that has to hold where the frames are within ``2 d`` of each other."""
    dx = e["ax"] + e["wx"] * e["m"] / 2 - f["ax"] - f["wx"] * f["m"] / 2
    dy = e["ay"] + e["wy"] * e["m"] / 2 - f["ay"] - f["wy"] * f["m"] / 2
    reach = (e["m"] + f["m"]) / 2 + 2 * d
    return (F.abs(dx) <= reach) & (F.abs(dy) <= reach)


def inset_edges(g, d: float) -> Column:
    """Straight edges of the polygon shrunk by ``d``: structs part (of the polygon's edge), a, b.

    The shrunk polygon is the set of inside points at least ``d`` from every
    edge.  Each edge is moved inwards and loses what is too near to another
    edge, so edges that collapse go, outlines that split come in all their
    pieces, and holes grow.  Around inward corners the true border is an arc,
    which has no straight edge.  Empty where nothing is left.
    """
    def pieces(e, fs):
        spans = F.transform(F.filter(fs, lambda f: frames_close(e, f, d)), lambda f: hidden_span(e, f, d))
        return free_pieces(e, F.array_sort(F.filter(spans, lambda t: t.isNotNull())), d)

    return F.when(is_polygon(g), let(frames(g), lambda fs: F.flatten(F.transform(fs, lambda e: pieces(e, fs)))))


def inset_corners(g, d: float) -> Column:
    """Vertices of the polygon shrunk by ``d`` at which two arcs around inward corners meet."""
    def meeting(v, w):
        """The two points at distance ``d`` from both vertices."""
        dx, dy = w["x"] - v["x"], w["y"] - v["y"]
        return let(dx * dx + dy * dy, lambda q: F.when((q > 0) & (q <= 4 * d * d), let(F.sqrt(F.greatest(
            d * d / q - 0.25, F.lit(0.0))), lambda h: F.array(
                vertex(v["x"] + dx / 2 - dy * h, v["y"] + dy / 2 + dx * h), vertex(v["x"] + dx / 2 + dy * h, v["y"] + dy / 2 - dx * h)))))

    def clear(p):
        return covers_point(g, p["x"], p["y"]) & F.forall(edges(g), lambda e: segment_distance(e, p["x"], p["y"]) >= d - 1e-7)

    def all_of(vs):
        near = lambda v: F.filter(vs, lambda w: (F.abs(w["x"] - v["x"]) <= 2 * d) & (F.abs(w["y"] - v["y"]) <= 2 * d)
                                  & ((v["x"] < w["x"]) | ((v["x"] == w["x"]) & (v["y"] < w["y"]))))
        met = lambda v: F.flatten(F.filter(F.transform(near(v), lambda w: meeting(v, w)), lambda t: t.isNotNull()))
        return F.filter(F.flatten(F.transform(vs, met)), clear)

    return F.when(is_polygon(g), let(F.array_distinct(vertices(g)), all_of))


def inset_outer_parts(g, d: float) -> Column:
    """Numbers of the rings that bound the shrunk polygon from outside: outer rings and the holes that grow into them."""
    g = col(g)
    ring = lambda k: line(F.get(g["parts"], k))
    alone = lambda k: F.when(g["kind"] == "POLYGON", k == 0).otherwise(ring_area2(F.get(g["parts"], k)) > 0)
    numbers = F.sequence(F.lit(0), F.size(g["parts"]) - 1)
    grow = lambda have, _: F.filter(numbers, lambda k: F.array_contains(have, k) | F.exists(
        have, lambda j: distance(ring(j), ring(k)) < 2 * d))
    return F.when(F.size(g["parts"]) == 1, F.array(F.lit(0))).otherwise(
        F.aggregate(numbers, F.filter(numbers, alone), grow))


def segments_touch(e: Column, f: Column) -> Column:
    def side(p, q, r):
        return F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))

    boxes = ((F.least(e["a"]["x"], e["b"]["x"]) <= F.greatest(f["a"]["x"], f["b"]["x"]))
             & (F.least(f["a"]["x"], f["b"]["x"]) <= F.greatest(e["a"]["x"], e["b"]["x"]))
             & (F.least(e["a"]["y"], e["b"]["y"]) <= F.greatest(f["a"]["y"], f["b"]["y"]))
             & (F.least(f["a"]["y"], f["b"]["y"]) <= F.greatest(e["a"]["y"], e["b"]["y"])))
    return (boxes & (side(e["a"], e["b"], f["a"]) * side(e["a"], e["b"], f["b"]) <= 0)
            & (side(f["a"], f["b"], e["a"]) * side(f["a"], f["b"], e["b"]) <= 0))


def intersects(g, h) -> Column:
    """Shares at least one point; borders count."""
    g, h = col(g), col(h)
    touch = let(edges(h), lambda hs: F.exists(edges(g), lambda e: F.exists(hs, lambda f: segments_touch(e, f))))
    g0, h0 = vertices(g)[0], vertices(h)[0]
    inside = ((is_polygon(g) & covers_point(g, h0["x"], h0["y"]))
              | (is_polygon(h) & covers_point(h, g0["x"], g0["y"])))
    return touch | inside


def bbox_overlaps(a: Column, b: Column) -> Column:
    return ((a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"])
            & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"]))


def intersection_area(g, h) -> Column:
    """Area common to two polygons with any holes and parts.

    Each polygon is the signed sum of the strips below its edges, so the common
    area is the signed sum, over edge pairs, of the area under the lower edge.
    """
    g, h = col(g), col(h)

    def flat(geo, o, base):
        """Edges left to right with their sign, local coordinates; vertical ones drop out."""
        def one(e):
            fwd = e["a"]["x"] < e["b"]["x"]
            lo, hi = F.when(fwd, e["a"]).otherwise(e["b"]), F.when(fwd, e["b"]).otherwise(e["a"])
            return F.struct(F.when(fwd, 1.0).otherwise(-1.0).alias("s"), (lo["x"] - o["x"]).alias("x0"),
                            (lo["y"] - base).alias("y0"), (hi["x"] - o["x"]).alias("x1"),
                            ((hi["y"] - lo["y"]) / (hi["x"] - lo["x"])).alias("m"))

        return F.transform(F.filter(edges(geo), lambda e: e["a"]["x"] != e["b"]["x"]), one)

    def term(e, f):
        at = lambda s, x: s["y0"] + s["m"] * (x - s["x0"])

        def piece(r):
            ea, eb, fa, fb = at(e, r["a"]), at(e, r["b"]), at(f, r["a"]), at(f, r["b"])
            return let(F.struct(ea.alias("ea"), eb.alias("eb"), fa.alias("fa"), fb.alias("fb"), (r["b"] - r["a"]).alias("w")), under)

        def under(q):
            da, db = q["ea"] - q["fa"], q["eb"] - q["fb"]
            la, lb = F.least(q["ea"], q["fa"]), F.least(q["eb"], q["fb"])
            t = da / (da - db)
            yc = q["ea"] + t * (q["eb"] - q["ea"])
            return F.when(da * db >= 0, q["w"] * (la + lb) / 2).otherwise(
                q["w"] * (t * (la + yc) + (1 - t) * (yc + lb)) / 2)

        span = F.struct(F.greatest(e["x0"], f["x0"]).alias("a"), F.least(e["x1"], f["x1"]).alias("b"))
        apart = (e["x0"] >= f["x1"]) | (f["x0"] >= e["x1"])
        return F.when(apart, 0.0).otherwise(e["s"] * f["s"] * let(span, piece))

    def summed(b):
        o, base = F.struct(b["g"]["xmin"].alias("x")), F.least(b["g"]["ymin"], b["h"]["ymin"])
        # only edges over the x range of the first polygon count
        near = lambda fh: F.filter(fh, lambda e: (e["x0"] < b["g"]["xmax"] - o["x"]) & (e["x1"] > 0))
        return let(near(flat(h, o, base)), lambda fh: F.aggregate(
            flat(g, o, base), F.lit(0.0), lambda s, e: s + F.aggregate(fh, F.lit(0.0), lambda t, f: t + term(e, f))))

    boxes = F.struct(bbox(g).alias("g"), bbox(h).alias("h"))
    return F.when(is_polygon(g) & is_polygon(h), F.abs(let(boxes, summed)))


def interiors_overlap(g, h, eps: float = 1e-6) -> Column:
    """Common area larger than nothing."""
    return intersection_area(g, h) > eps


# -- validity -------------------------------------------------------------

def ring_problem(ring: Column) -> Column:
    """Reason why a ring is not valid, null when it is."""
    n = F.size(ring)
    first, last = start_vertex(ring), end_vertex(ring)

    def crossing(es):
        m = F.size(es)
        tagged = F.transform(es, lambda e, i: F.struct(e.alias("e"), i.alias("i")))
        return let(tagged, lambda ts: F.exists(ts, lambda p: F.exists(ts, lambda q: (
            (q["i"] > p["i"] + 1) & ~((p["i"] == 0) & (q["i"] == m - 1)) & segments_touch(p["e"], q["e"])))))

    def spike(es):
        turns = F.transform(es, lambda e, i: F.struct(e.alias("e"), F.get(es, (i + 1) % F.size(es)).alias("f")))
        return F.exists(turns, lambda p: (on_segment(p["e"], p["f"]["b"]["x"], p["f"]["b"]["y"])
                                          | on_segment(p["f"], p["e"]["a"]["x"], p["e"]["a"]["y"])))

    def verdict(es):
        flat = F.abs(ring_area2(ring)) < 1e-9
        return (F.when(flat, F.when(crossing(es), "self crossing").otherwise("no area"))
                .when(spike(es), "spike").when(crossing(es), "self crossing"))

    return (F.when(n < 4, "too few points")
            .when((first["x"] != last["x"]) | (first["y"] != last["y"]), "open ring")
            .otherwise(let(segments(drop_repeated(ring)), verdict)))


def problem(g) -> Column:
    """First ring problem of a polygon; null for valid geometries."""
    g = col(g)
    found = F.filter(F.transform(g["parts"], ring_problem), lambda r: r.isNotNull())
    return F.when(g.isNull(), F.lit("no geometry")).when(is_polygon(g), F.get(found, F.lit(0)))


def _drop_spikes(ring: Column) -> Column:
    def clean(body):
        m = F.size(body)

        def keep(p, i):
            a, b = F.get(body, (i + m - 1) % m), F.get(body, (i + 1) % m)
            cross = (p["x"] - a["x"]) * (b["y"] - p["y"]) - (p["y"] - a["y"]) * (b["x"] - p["x"])
            back = (p["x"] - a["x"]) * (b["x"] - p["x"]) + (p["y"] - a["y"]) * (b["y"] - p["y"])
            return ~((F.abs(cross) < 1e-9) & (back < 0))

        return let(F.filter(body, keep), lambda kept: F.concat(kept, F.slice(kept, 1, 1)))

    return F.when(F.size(ring) > 1, let(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), clean)).otherwise(ring)


def repaired(g, passes: int = 2) -> Column:
    """Close rings, drop repeated vertices and spikes, orient; rings without area go."""
    g = col(g)

    def shut(ring):
        first, last = start_vertex(ring), end_vertex(ring)
        return F.when((first["x"] != last["x"]) | (first["y"] != last["y"]),
                      F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)

    def fix(ring, i):
        out = let(shut(ring), drop_repeated)
        for _ in range(passes):
            out = let(let(out, _drop_spikes), drop_repeated)
        return let(out, lambda r: F.when(i == 0, oriented(r)).otherwise(r))

    rings = F.filter(F.transform(g["parts"], fix), lambda r: (F.size(r) >= 4) & (F.abs(ring_area2(r)) > 1e-9))
    fixed = let(rings, lambda parts: F.when(F.size(parts) > 0, F.struct(
        g["kind"].alias("kind"), g["srid"].alias("srid"), parts.alias("parts"))))
    return F.when(is_polygon(g), fixed).otherwise(g)


# -- text and WKB ---------------------------------------------------------

def wkt(g, digits: int = 3) -> Column:
    """Plain text form, one bracket per part."""
    g = col(g)
    one = lambda p: F.concat_ws(" ", F.round(p["x"], digits).cast("decimal(20,3)").cast("string"),
                                F.round(p["y"], digits).cast("decimal(20,3)").cast("string"))
    body = F.array_join(F.transform(g["parts"], lambda part: F.concat(
        F.lit("("), F.array_join(F.transform(part, one), ","), F.lit(")"))), ",")
    return F.when(g.isNotNull(), F.concat(g["kind"], F.lit("("), body, F.lit(")")))


_CODES = {"POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTIPOINT": 4, "MULTILINESTRING": 5, "MULTIPOLYGON": 6}


def _signed(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1]))


def _read_wkb(buf: bytes):
    """Kind and list of (n, 2) arrays; extra ordinates are dropped."""
    pos, parts = 0, []

    def head():
        nonlocal pos
        order = "<" if buf[pos] == 1 else ">"
        code = _struct.unpack_from(order + "I", buf, pos + 1)[0]
        pos += 5
        dims = 2
        if code & 0x20000000:
            pos += 4
        if code & 0x80000000 or (code & 0xFFFF) // 1000 in (1, 3):
            dims += 1
        if code & 0x40000000 or (code & 0xFFFF) // 1000 in (2, 3):
            dims += 1
        return order, (code & 0xFFFF) % 1000, dims

    def count(order):
        nonlocal pos
        pos += 4
        return _struct.unpack_from(order + "I", buf, pos - 4)[0]

    def coords(order, n, dims):
        nonlocal pos
        a = np.frombuffer(buf, order + "f8", n * dims, pos).reshape(n, dims)[:, :2]
        pos += n * dims * 8
        return a

    def one():
        order, code, dims = head()
        if code == 1:
            parts.append(coords(order, 1, dims))
        elif code == 2:
            parts.append(coords(order, count(order), dims))
        elif code == 3:
            for i in range(count(order)):
                ring = coords(order, count(order), dims)
                want = 1 if i == 0 else -1
                parts.append(ring if _signed(ring) * want >= 0 else ring[::-1])
        else:
            for _ in range(count(order)):
                one()
        return code

    code = one()
    kinds = {v: k for k, v in _CODES.items()}
    return kinds.get(code, "GEOMETRYCOLLECTION"), parts


def _write_wkb(kind_: str, rings: list[np.ndarray]) -> bytes:
    head = lambda code: _struct.pack("<BI", 1, code)
    flat = lambda a: _struct.pack("<I", len(a)) + np.ascontiguousarray(a, "<f8").tobytes()
    if kind_ in ("POINT", "MULTIPOINT"):
        body = [head(1) + np.ascontiguousarray(a[0], "<f8").tobytes() for a in rings]
    elif kind_ in ("LINESTRING", "MULTILINESTRING"):
        body = [head(2) + flat(a) for a in rings]
    else:
        groups: list[list[np.ndarray]] = []
        for a in rings:
            if _signed(a) > 0 or not groups:
                groups.append([a])
            else:
                groups[-1].append(a)
        body = [head(3) + _struct.pack("<I", len(gr)) + b"".join(flat(a) for a in gr) for gr in groups]
    if not kind_.startswith("MULTI"):
        return body[0]
    return head(_CODES[kind_]) + _struct.pack("<I", len(body)) + b"".join(body)


def unpack(g: pa.Array):
    """Per row: kind, srid, list of (n, 2) vertex arrays; None for a missing geometry."""
    parts = pc.struct_field(g, "parts")
    kinds, srids = pc.struct_field(g, "kind").to_pylist(), pc.struct_field(g, "srid").to_pylist()
    valid = parts.is_valid().to_pylist()
    outer, rings = parts.offsets.to_numpy(), parts.values
    inner, verts = rings.offsets.to_numpy(), rings.values
    xy = np.column_stack([verts.field("x").to_numpy(zero_copy_only=False), verts.field("y").to_numpy(zero_copy_only=False)])
    for i, ok in enumerate(valid):
        if not ok or kinds[i] is None:
            yield None
        else:
            yield kinds[i], srids[i], [xy[inner[j]:inner[j + 1]] for j in range(outer[i], outer[i + 1])]


def pack(rows: list) -> pa.Array:
    """Geometry array from rows as ``unpack`` gives them."""
    flat = [p for r in rows if r is not None for p in r[2]]
    xy = np.concatenate(flat) if flat else np.zeros((0, 2))
    verts = pa.StructArray.from_arrays([pa.array(xy[:, 0], pa.float64()), pa.array(xy[:, 1], pa.float64())], ["x", "y"])
    inner = np.concatenate([[0], np.cumsum([len(p) for p in flat], dtype=np.int64)]) if flat else np.zeros(1)
    rings = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), verts)
    outer, at = [], 0
    for r in rows:
        outer.append(None if r is None else at)
        at += 0 if r is None else len(r[2])
    parts = pa.ListArray.from_arrays(pa.array([*outer, at], pa.int32()), rings)
    kinds = pa.array([None if r is None else r[0] for r in rows], pa.string())
    srids = pa.array([None if r is None else r[1] for r in rows], pa.int32())
    return pa.StructArray.from_arrays([kinds, srids, parts], ["kind", "srid", "parts"],
                                      mask=pa.array([r is None for r in rows], pa.bool_()))


@F.arrow_udf(GEOM_TYPE)
def from_wkb(buf: pa.Array) -> pa.Array:
    out = []
    for b in buf.to_pylist():
        if b is None:
            out.append(None)
        else:
            k, parts = _read_wkb(b)
            out.append((k, 25832, parts))
    return pack(out)


@F.arrow_udf(T.BinaryType())
def to_wkb(g: pa.Array) -> pa.Array:
    return pa.array([None if r is None else _write_wkb(r[0], r[2]) for r in unpack(g)], pa.binary())
