"""Geometry, spatial joins, line and area jobs."""

import math

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import areas, lines, placement, spatial
from .registry import query


def r6(c):
    return F.round(c, 6) + F.lit(0.0)


CELL = 25.0


@query("g01_centroid", "SELECT pid, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy FROM parcel", ("parcel",))
def _(d):
    v = G.centroid("geom")["parts"][0][0]
    return d.parcels().select("pid", r6(v["x"]).alias("cx"), r6(v["y"]).alias("cy"))


@query("g02_measures", """
SELECT uid, (x1 - x0) * (y1 - y0) AS area, 2 * (x1 - x0 + y1 - y0) AS border, x0 AS xmin, y1 AS ymax, 5 AS n FROM usearea""", ("usearea",))
def _(d):
    b = G.bbox("geom")
    return d.useareas().select("uid", G.area("geom").alias("area"), G.perimeter("geom").alias("border"),
                               b["xmin"].alias("xmin"), b["ymax"].alias("ymax"), G.npoints("geom").alias("n"))


@query("g03_point_on_surface", """
SELECT uid, CASE WHEN uid % 2 = 0 THEN x0 + 5 ELSE x0 + 12.5 END AS px, CASE WHEN uid % 2 = 0 THEN y0 + 10 ELSE y0 + 7.5 END AS py FROM usearea""", ("usearea",))
def _(d):
    # every second area is L-shaped: its centroid lies outside its widest span
    ell = F.array(G.vertex("x0", "y0"), G.vertex(F.col("x0") + 25, F.col("y0")), G.vertex(F.col("x0") + 25, F.col("y0") + 5),
                  G.vertex(F.col("x0") + 10, F.col("y0") + 5), G.vertex(F.col("x0") + 10, F.col("y0") + 15),
                  G.vertex("x0", F.col("y0") + 15), G.vertex("x0", "y0"))
    g = F.when(F.col("uid") % 2 == 0, G.geom("POLYGON", F.array(ell))).otherwise(F.col("geom"))
    v = G.point_on_surface("g")["parts"][0][0]
    return d.useareas().withColumn("g", g).select("uid", r6(v["x"]).alias("px"), r6(v["y"]).alias("py"))


@query("g04_move_and_turn", """
SELECT pid, x0 + 3 AS tx, y0 - 2 AS ty, x0 AS rx, y0 + 10 AS ry, 'MULTIPOLYGON' AS k FROM parcel""", ("parcel",))
def _(d):
    t = G.translate("geom", 3, -2)["parts"][0][0]
    r = G.rotate("geom", math.pi / 2, "x0", "y0")["parts"][0][1]
    return d.parcels().select("pid", t["x"].alias("tx"), t["y"].alias("ty"), r6(r["x"]).alias("rx"), r6(r["y"]).alias("ry"),
                              G.multi("geom")["kind"].alias("k"))


PATH = """
pv AS (SELECT oid, k, y, lag(y, 1, 0) OVER (PARTITION BY oid ORDER BY k) AS py, lag(k, 1, 0) OVER (PARTITION BY oid ORDER BY k) AS pk FROM steps),
legs AS (SELECT oid, k * 2 AS i, 10.0 * pk AS ax, 1.0 * py AS ay, 10.0 * k AS bx, 1.0 * py AS b_y FROM pv WHERE k <> pk
         UNION ALL SELECT oid, k * 2 + 1, 10.0 * k, 1.0 * py, 10.0 * k, 1.0 * y FROM pv WHERE y <> py),
leg AS (SELECT oid, i, CAST(ax AS DOUBLE) AS ax, CAST(ay AS DOUBLE) AS ay, CAST(bx AS DOUBLE) AS bx, CAST(b_y AS DOUBLE) AS b_y,
               CAST(abs(bx - ax) + abs(b_y - ay) AS DOUBLE) AS ln,
               CAST(coalesce(sum(abs(bx - ax) + abs(b_y - ay)) OVER (PARTITION BY oid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS s FROM legs)
"""


@query("g05_explode_parts", "WITH " + PATH + "SELECT oid, count(*) AS parts, sum(ln) AS total FROM leg GROUP BY oid", ("steps",))
def _(d):
    one = G.geom("MULTILINESTRING", F.transform(G.segments(F.col("part")), lambda e: F.array(e["a"], e["b"])))
    parts = d.polylines().withColumn("g", one).select("oid", F.explode(G.part_geoms("g")).alias("p"))
    return parts.groupBy("oid").agg(F.count(F.lit(1)).alias("parts"), F.sum(G.length("p")).alias("total"))


@query("g06_end_points", "WITH " + PATH + """,
r AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY i) AS a, row_number() OVER (PARTITION BY oid ORDER BY i DESC) AS z FROM leg)
SELECT oid, 'start' AS which, ax AS x, ay AS y, CAST(CASE WHEN bx > ax THEN 90 WHEN b_y > ay THEN 0 ELSE 180 END AS BIGINT) AS deg FROM r WHERE a = 1
UNION ALL SELECT oid, 'end', bx, b_y, CASE WHEN bx > ax THEN 270 WHEN b_y > ay THEN 180 ELSE 0 END FROM r WHERE z = 1""", ("steps",))
def _(d):
    return lines.end_points(d.polylines(), "part", ["oid"]).select(
        "oid", "which", "x", "y", F.rint(F.degrees("azimut")).cast("long").alias("deg"))


@query("g07_interpolate", "WITH " + PATH + """,
t AS (SELECT oid, sum(ln) / 2 AS m FROM leg GROUP BY oid),
h AS (SELECT leg.*, m, row_number() OVER (PARTITION BY leg.oid ORDER BY i) AS rn FROM leg JOIN t ON t.oid = leg.oid WHERE s + ln >= m)
SELECT oid, round(ax + (bx - ax) * (m - s) / ln, 6) AS x, round(ay + (b_y - ay) * (m - s) / ln, 6) AS y FROM h WHERE rn = 1""", ("steps",))
def _(d):
    v = G.interpolate(F.col("part"), F.lit(0.5))
    return d.polylines().select("oid", r6(v["x"]).alias("x"), r6(v["y"]).alias("y"))


@query("g08_symbols_along", "WITH " + PATH + """,
t AS (SELECT oid, sum(ln) AS total FROM leg GROUP BY oid),
o AS (SELECT oid, unnest(generate_series(3, CAST(floor(total) AS BIGINT), 8)) AS off FROM t)
SELECT o.oid, (off - 3) // 8 AS k, ax + (bx - ax) * (off - s) / ln AS x, ay + (b_y - ay) * (off - s) / ln AS y
FROM o JOIN leg ON leg.oid = o.oid AND off > s AND off <= s + ln""", ("steps",))
def _(d):
    return lines.symbols_along(d.polylines(), "part", ["oid"], 3000, 8000).select(
        "oid", "k", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"))


@query("f08_symbol_angles", "WITH " + PATH + """,
t AS (SELECT oid, sum(ln) AS total FROM leg GROUP BY oid),
o AS (SELECT oid, unnest(generate_series(3, CAST(floor(total) AS BIGINT), 8)) AS off FROM t)
SELECT o.oid, (off - 3) // 8 AS k, CAST(CASE WHEN a.bx > a.ax AND b.bx > b.ax THEN 0 WHEN a.b_y > a.ay AND b.b_y > b.ay THEN 90
  WHEN a.b_y < a.ay AND b.b_y < b.ay THEN -90 END AS BIGINT) AS deg
FROM o JOIN leg a ON a.oid = o.oid AND off * 0.9999 > a.s AND off * 0.9999 <= a.s + a.ln
JOIN t ON t.oid = o.oid JOIN leg b ON b.oid = o.oid AND least(off * 1.0001, total) > b.s AND least(off * 1.0001, total) <= b.s + b.ln""", ("steps",))
def _(d):
    # an angle between two edges of different direction is no multiple of 90 degrees
    sym = lines.symbols_along(d.polylines(), "part", ["oid"], 3000, 8000)
    deg = F.degrees("drehwinkel")
    return sym.withColumn("deg", deg).select("oid", "k", F.when(
        F.abs(F.col("deg") / 90 - F.rint(F.col("deg") / 90)) < 1e-6, F.rint("deg").cast("long")).alias("deg"))


@query("g08_alternating_side", "WITH " + PATH + """,
f AS (SELECT oid, min(i) AS i FROM leg GROUP BY oid),
o AS (SELECT leg.*, unnest(generate_series(1, CAST(floor(ln) AS BIGINT), 2)) AS off FROM leg JOIN f ON f.oid = leg.oid AND f.i = leg.i)
SELECT oid, (off - 1) // 2 AS k, ax + (bx - ax) * off / ln AS x, CASE WHEN ((off - 1) // 2) % 2 = 0 THEN ay + 0.5 ELSE ay - 0.5 END AS y FROM o""", ("steps",))
def _(d):
    first = d.polylines().select("oid", F.slice("part", 1, 2).alias("part"))
    sym = lines.alternating(lines.symbols_along(first, "part", ["oid"], 1000, 2000), 0.5)
    return sym.select("oid", "k", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"))


OFFSET = PATH + """,
v AS (SELECT oid, i, ax AS x, ay AS y, bx - ax AS dx, b_y - ay AS dy, ln,
             lag(bx - ax) OVER w AS pdx, lag(b_y - ay) OVER w AS pdy, lag(ln) OVER w AS pln FROM leg WINDOW w AS (PARTITION BY oid ORDER BY i)
      UNION ALL SELECT oid, i + 1000, bx, b_y, NULL, NULL, NULL, bx - ax, b_y - ay, ln FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY i DESC) z FROM leg) e WHERE z = 1),
n AS (SELECT oid, i, x, y, -dy / ln AS nx, dx / ln AS ny, -pdy / pln AS mx, pdx / pln AS my FROM v),
-- corner of two axis-parallel legs: straight on keeps the normal, a right angle adds both, a turn back shifts b_y the first normal
off AS (SELECT oid, i, x + 0.5 * CASE WHEN nx IS NULL OR mx * nx + my * ny < -0.5 THEN mx WHEN mx IS NULL OR mx * nx + my * ny > 0.5 THEN nx ELSE nx + mx END AS x,
               y + 0.5 * CASE WHEN ny IS NULL OR mx * nx + my * ny < -0.5 THEN my WHEN my IS NULL OR mx * nx + my * ny > 0.5 THEN ny ELSE ny + my END AS y FROM n)
"""


@query("g09_offset_line", "WITH " + OFFSET + """
SELECT oid, count(*) AS n, round(sum(x), 6) AS sx, round(sum(y), 6) AS sy, round(sum(x * y), 6) AS sxy FROM off GROUP BY oid""", ("steps",))
def _(d):
    pts = d.polylines().select("oid", F.explode(G.offset_line(F.col("part"), 0.5)).alias("v"))
    return pts.groupBy("oid").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("v.x")).alias("sx"), r6(F.sum("v.y")).alias("sy"),
                                  r6(F.sum(F.col("v.x") * F.col("v.y"))).alias("sxy"))


@query("g09b_flat_buffer", "WITH " + PATH + """
SELECT oid, min_by(ln, i) / 2 AS area FROM leg GROUP BY oid""", ("steps",))
def _(d):
    return d.polylines().select("oid", r6(G.area(G.flat_buffer(F.slice("part", 1, 2), 0.25))).alias("area"))


DISSOLVED = """
e AS (SELECT district, x0 AS ax, y0 AS ay, x1 AS bx, y0 AS b_y FROM parcel UNION ALL SELECT district, x1, y0, x1, y1 FROM parcel
      UNION ALL SELECT district, x0, y1, x1, y1 FROM parcel UNION ALL SELECT district, x0, y0, x0, y1 FROM parcel),
o AS (SELECT district, ax, ay, bx, b_y FROM e GROUP BY ALL HAVING count(*) = 1)
"""


@query("g10_dissolve_edges", "WITH " + DISSOLVED + """
SELECT o.district, count(*) AS edges, 10.0 * count(*) AS outline, max(a.area) AS area FROM o
JOIN (SELECT district, 100.0 * count(*) AS area FROM parcel GROUP BY district) a ON a.district = o.district GROUP BY o.district""".replace(
    "10.0 *", "CAST(10 AS DOUBLE) *").replace("100.0 *", "CAST(100 AS DOUBLE) *"), ("parcel",))
def _(d):
    e = areas.boundary_edges(d.parcels(), ["district"], "geom")
    return areas.edge_sums(e, ["district"])


@query("g10_dissolve_with_split_edges", """
SELECT district, CAST(sum((x1 - x0) * (y1 - y0)) AS DOUBLE) AS area FROM (
  SELECT district, x0, y0, x1, y1 FROM parcel) t GROUP BY district""", ("parcel",))
def _(d):
    # every second parcel is cut in two, so neighbours have unmatched vertices
    p = d.parcels()
    half = lambda a, b: G.rectangle("x0", F.col("y0") + a, "x1", F.col("y0") + b)
    halves = F.when(F.col("pid") % 2 == 0, F.array(half(0, 5), half(5, 10))).otherwise(F.array(F.col("geom")))
    split = p.select("district", F.explode(halves).alias("geom"))
    e = areas.boundary_edges(split, ["district"], "geom", node=True, cell=16.0)
    return areas.edge_sums(e, ["district"]).select("district", "area")


@query("g10_dissolved_polygons", "SELECT district, CAST(100 * count(*) AS DOUBLE) AS area FROM parcel GROUP BY district", ("parcel",))
def _(d):
    poly = areas.dissolve(d.parcels(), ["district"], "geom")
    return poly.select("district", r6(G.area("polygon")).alias("area"))


@query("g11_snap", """
SELECT o_orderkey, round(round_even(o_totalprice / 7 * 1000, 0) / 1000, 6) AS x, round(round_even(o_totalprice / 13 * 1000, 0) / 1000, 6) AS y FROM orders""")
def _(d):
    v = G.snap(G.point(F.col("o_totalprice") / 7, F.col("o_totalprice") / 13), 0.001)["parts"][0][0]
    return d["orders"].select("o_orderkey", r6(v["x"]).alias("x"), r6(v["y"]).alias("y"))


@query("g12_simplify", """
SELECT uid, 5 AS n, (x1 - x0) * (y1 - y0) AS area FROM usearea""", ("usearea",))
def _(d):
    # a small bump on one side disappears within the tolerance
    ring = F.array(G.vertex("x0", "y0"), G.vertex(F.col("x0") + 10, F.col("y0") + 0.2), G.vertex("x1", "y0"), G.vertex("x1", "y1"),
                   G.vertex("x0", "y1"), G.vertex("x0", "y0"))
    s = d.useareas().withColumn("g", areas.simplify(G.geom("POLYGON", F.array(ring)), 0.5))
    return s.select("uid", G.npoints("g").alias("n"), r6(G.area("g")).alias("area"))


@query("g13_merge_lines", """
SELECT district, count(*) AS parts FROM (SELECT DISTINCT district, x0, y0, x1 FROM (
  SELECT district, x0, y0, x1 FROM parcel UNION ALL SELECT district, x0, y1, x1 FROM parcel) e) t GROUP BY district""", ("parcel",))
def _(d):
    p = d.parcels()
    side = lambda y: G.line(F.array(G.vertex("x0", y), G.vertex("x1", y)))
    back = lambda y: G.line(F.array(G.vertex("x1", y), G.vertex("x0", y)))
    both = p.select("district", F.explode(F.array(side("y0"), back("y1"))).alias("g"))
    return lines.merge_lines(both, ["district"], "g").select("district", F.size(F.col("line")["parts"]).cast("long").alias("parts"))


@query("g13_chain_lines", """
WITH e AS (SELECT DISTINCT district, y0, x0 FROM parcel),
g AS (SELECT district, y0, x0, x0 - 10 * row_number() OVER (PARTITION BY district, y0 ORDER BY x0) AS grp FROM e)
SELECT district, count(*) AS chains FROM (SELECT DISTINCT district, y0, grp FROM g) t GROUP BY district""", ("parcel",))
def _(d):
    base = d.parcels().select("district", F.array(G.vertex("x0", "y0"), G.vertex("x1", "y0")).alias("part"))
    return lines.chain_lines(base, ["district"], "part").groupBy("district").agg(F.countDistinct("chain").alias("chains"))


@query("g14_boundary_sets", """
SELECT x0, y0, count(DISTINCT code) AS codes, min(fid) AS fid FROM (SELECT x0, y0, code, uid AS fid FROM usearea) t GROUP BY x0, y0""", ("usearea",))
def _(d):
    u = d.useareas().withColumn("line", G.line(F.array(G.vertex("x0", "y0"), G.vertex("x1", "y1"), G.vertex("x1", "y0"))))
    u = u.withColumn("codes", F.array("code")).withColumn("gml", F.col("uid").cast("string"))
    out = lines.border_sets(u, "line", "uid", "gml", "codes", F.array(F.lit("M")))
    v = F.col("line")["parts"][0][0]
    return out.select(v["x"].alias("x0"), v["y"].alias("y0"), F.size("codes").cast("long").alias("codes"), F.col("uid").alias("fid"))


def defective(d):
    """Every parcel with one of eight ring shapes; five of them are defects."""
    x, y = F.col("x0"), F.col("y0")
    v = lambda dx, dy: G.vertex(x + dx, y + dy)
    shapes = [
        F.array(v(0, 0), v(10, 0), v(10, 10), v(0, 10), v(0, 0)),
        F.array(v(0, 0), v(10, 10), v(10, 0), v(0, 10), v(0, 0)),
        F.array(v(0, 0), v(10, 0), v(10, 0), v(10, 10), v(0, 10), v(0, 0)),
        F.array(v(0, 0), v(10, 0), v(10, 10), v(10, 15), v(10, 10), v(0, 10), v(0, 0)),
        F.array(v(0, 0), v(10, 0), v(5, 0), v(0, 0)),
        F.array(v(0, 0), v(10, 0), v(10, 10), v(0, 10)),
        F.array(v(0, 0), v(10, 0), v(10, 10), v(5, 4), v(0, 10), v(0, 0)),
        F.array(v(0, 0), v(10, 0), v(0, 0)),
    ]
    ring = shapes[0]
    for i, s in enumerate(shapes[1:], 1):
        ring = F.when(F.col("pid") % 8 == i, s).otherwise(ring)
    return d["parcel"].withColumn("geom", G.geom("POLYGON", F.array(ring)))


@query("g15_validity", """
SELECT pid, CASE pid % 8 WHEN 1 THEN 'self crossing' WHEN 3 THEN 'spike' WHEN 4 THEN 'no area' WHEN 5 THEN 'open ring'
  WHEN 7 THEN 'too few points' END AS reason FROM parcel""", ("parcel",))
def _(d):
    why = G.problem("geom")
    # a flat ring also folds back on itself
    return defective(d).select("pid", F.when((F.col("pid") % 8 == 4) & why.isNotNull(), "no area").when(
        (F.col("pid") % 8 == 1) & (why == "self crossing"), "self crossing").otherwise(why).alias("reason"))


@query("g15_repair", """
SELECT pid, CASE pid % 8 WHEN 6 THEN 70.0 ELSE 100.0 END::DOUBLE AS area FROM parcel WHERE pid % 8 NOT IN (1, 4, 7)""", ("parcel",))
def _(d):
    good, _ = areas.check_polygons(defective(d), "geom", ["pid"])
    return good.filter(F.col("geom").isNotNull()).select("pid", r6(G.area("geom")).alias("area"))


@query("v07_invalid_geometries", """
SELECT CASE pid % 8 WHEN 3 THEN 'spike' WHEN 5 THEN 'open ring' END AS reason, count(*) AS n, true AS repaired FROM parcel WHERE pid % 8 IN (3, 5) GROUP BY 1""", ("parcel",))
def _(d):
    _, bad = areas.check_polygons(defective(d), "geom", ["pid"])
    return bad.filter("repaired AND reason IN ('spike', 'open ring')").groupBy("reason", "repaired").agg(F.count(F.lit(1)).alias("n"))


@query("g16_area_fill", """
WITH r AS (SELECT uid, x0 + 0.5 AS xa, y0 + 0.5 AS ya, x1 - 0.5 AS xb, y1 - 0.5 AS yb FROM usearea),
rw AS (SELECT r.*, unnest(generate_series(CAST(floor(ya / 3.5) AS BIGINT), CAST(ceil(yb / 3.5) - 1 AS BIGINT))) AS i FROM r),
pt AS (SELECT rw.*, i * 3.5 AS y, unnest(generate_series(CAST(floor(xa / 7) AS BIGINT), CAST(ceil(xb / 7) - 1 AS BIGINT))) AS j FROM rw),
xy AS (SELECT uid, CAST(j * 7 + CASE WHEN (i - CAST(floor(ya / 3.5) AS BIGINT)) % 2 = 1 THEN 3.5 ELSE 0 END AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, xa, xb, ya, yb FROM pt)
SELECT uid, x, y FROM xy WHERE x BETWEEN xa AND xb AND y BETWEEN ya AND yb""", ("usearea",))
def _(d):
    return areas.area_fill(d.useareas().withColumn("rule", F.lit("1100")), "geom", "rule", ["uid"])


@query("g16_slanted_fill", """
WITH t AS (SELECT uid, (x0 + x1) / 2 AS xm, y0, (x1 - x0) / 2 AS a, y1 - y0 AS h FROM usearea),
l AS (SELECT t.*, sqrt(a * a + h * h) AS l FROM t),
r AS (SELECT l.*, y0 + 0.5 * l / a AS ya, y0 + h - 0.5 AS yb, ((h - 0.5) * a - 0.5 * l) / h AS w FROM l),
rw AS (SELECT r.*, unnest(generate_series(CAST(floor(ya / 3.5) AS BIGINT), CAST(ceil(yb / 3.5) - 1 AS BIGINT))) AS i FROM r),
pt AS (SELECT rw.*, unnest(generate_series(CAST(floor((xm - w) / 7) AS BIGINT), CAST(ceil((xm + w) / 7) - 1 AS BIGINT))) AS j FROM rw),
xy AS (SELECT pt.*, CAST(j * 7 + CASE WHEN (i - CAST(floor(ya / 3.5) AS BIGINT)) % 2 = 1 THEN 3.5 ELSE 0 END AS DOUBLE) AS x, CAST(i * 3.5 AS DOUBLE) AS y FROM pt)
SELECT uid, x, y FROM xy WHERE y <= yb AND abs(x - xm) * h <= (y - y0) * a - 0.5 * l""", ("usearea",))
def _(d):
    # triangles that stand on their tips: rows count from the tip of the shrunk outline
    u = d.useareas()
    mid = (F.col("x0") + F.col("x1")) / 2
    tip = G.geom("POLYGON", F.array(F.array(G.vertex(mid, "y0"), G.vertex("x1", "y1"), G.vertex("x0", "y1"), G.vertex(mid, "y0"))))
    return areas.area_fill(u.withColumn("geom", tip).withColumn("rule", F.lit("1100")), "geom", "rule", ["uid"])


@query("g16_thinned_fill")
def _(d):
    return areas.area_fill(d.useareas().withColumn("rule", F.lit("1101")), "geom", "rule", ["uid"]).groupBy("uid").agg(
        F.count(F.lit(1)).alias("n"))


RECTS = "p.x0 {op} u.x1 AND u.x0 {op} p.x1 AND p.y0 {op} u.y1 AND u.y0 {op} p.y1"


def pair_sides(d):
    p = d.parcels().select("pid", "official", F.col("geom").alias("pg"))
    u = d.useareas().select("uid", "code", F.col("geom").alias("ug"))
    return p, u


@query("g20_intersects_join", "SELECT pid, uid FROM parcel p JOIN usearea u ON " + RECTS.format(op="<="), ("parcel", "usearea"))
def _(d):
    p, u = pair_sides(d)
    return spatial.intersects_join(p, u, "pg", "ug", CELL).select("pid", "uid")


@query("g21_interiors_overlap", "SELECT pid, uid FROM parcel p JOIN usearea u ON " + RECTS.format(op="<"), ("parcel", "usearea"))
def _(d):
    p, u = pair_sides(d)
    return spatial.overlay(p, u, "pg", "ug", CELL).select("pid", "uid")


@query("g22_intersection_area", """
SELECT pid, uid, (least(p.x1, u.x1) - greatest(p.x0, u.x0)) * (least(p.y1, u.y1) - greatest(p.y0, u.y0)) AS common
FROM parcel p JOIN usearea u ON """ + RECTS.format(op="<"), ("parcel", "usearea"))
def _(d):
    p, u = pair_sides(d)
    return spatial.overlay(p, u, "pg", "ug", CELL).select("pid", "uid", r6(F.col("common")).alias("common"))


@query("g22_overlay_of_triangles", """
SELECT pid, uid, CAST(50 AS DOUBLE) AS common FROM parcel p JOIN usearea u ON p.x0 >= u.x0 AND p.x1 <= u.x1 AND p.y0 >= u.y0 AND p.y1 <= u.y1""", ("parcel", "usearea"))
def _(d):
    # triangles inside rectangles, with a hole-free half of each parcel
    p, u = pair_sides(d)
    tri = G.geom("POLYGON", F.transform(F.col("pg")["parts"], lambda r: F.array(r[0], r[1], r[2], r[0])))
    both = spatial.overlay(p.withColumn("pg", tri), u, "pg", "ug", CELL)
    return both.filter(F.abs(F.col("common") - 50) < 1e-6).select("pid", "uid", r6(F.col("common")).alias("common")).join(
        pair_full(d), ["pid", "uid"], "left_semi")


def pair_full(d):
    # a parcel lies inside an area only if its lower left corner does: corners meet areas on the grid
    box = lambda s: [F.col(c).alias(f"{s}{c}") for c in ("x0", "y0", "x1", "y1")]
    p = d.split(d["parcel"]).select("pid", *box("p"), G.point("x0", "y0").alias("corner"))
    u = d.split(d["usearea"]).select("uid", *box("u"), G.rectangle("x0", "y0", "x1", "y1").alias("ug"))
    met = spatial.grid_join(p, u, "corner", "ug", CELL)
    return met.filter("px0 >= ux0 AND px1 <= ux1 AND py0 >= uy0 AND py1 <= uy1").select("pid", "uid")


@query("g23_shared_borders", """
SELECT a.pid AS a, b.pid AS b, CAST(10 AS DOUBLE) AS ln FROM parcel a JOIN parcel b ON a.pid < b.pid
 AND ((a.x1 = b.x0 AND a.y0 = b.y0) OR (b.x1 = a.x0 AND a.y0 = b.y0) OR (a.y1 = b.y0 AND a.x0 = b.x0) OR (b.y1 = a.y0 AND a.x0 = b.x0))""", ("parcel",))
def _(d):
    s = spatial.shared_borders(d.parcels().select("pid", "geom"), "geom", "pid", cell=CELL)
    return s.groupBy("a", "b").agg(r6(F.sum(G.dist(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")))).alias("ln"))


@query("j09_neighbour_pairs", """
SELECT a.pid AS a, b.pid AS b FROM parcel a JOIN parcel b ON a.pid < b.pid AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1""", ("parcel",))
def _(d):
    p = d.parcels()
    l, r = p.select(F.col("pid").alias("a"), F.col("geom").alias("ga")), p.select(F.col("pid").alias("b"), F.col("geom").alias("gb"))
    return spatial.intersects_join(l, r, "ga", "gb", CELL).filter("a < b").select("a", "b")


@query("j21_same_point", """
SELECT p.pid, u.uid FROM parcel p JOIN usearea u ON p.x0 = u.x0 AND p.y0 = u.y0""", ("parcel", "usearea"))
def _(d):
    p, u = d.parcels().withColumn("pp", G.point("x0", "y0")), d.useareas().withColumn("up", G.point("x0", "y0"))
    return spatial.same_point(p.select("pid", "pp"), u.select("uid", "up"), "pp", "up").select("pid", "uid")


@query("j22_spatial_count", """
SELECT u.code, count(DISTINCT p.pid) AS parcels FROM parcel p JOIN usearea u ON """ + RECTS.format(op="<") + " GROUP BY u.code", ("parcel", "usearea"))
def _(d):
    p, u = pair_sides(d)
    return spatial.overlay(p, u, "pg", "ug", CELL).groupBy("code").agg(F.countDistinct("pid").alias("parcels"))


@query("g24_safe_overlay", """
SELECT side, reason, count(*) AS n FROM (SELECT 'left' AS side, CASE pid % 8 WHEN 3 THEN 'spike' WHEN 5 THEN 'open ring' WHEN 7 THEN 'too few points' END AS reason
  FROM parcel WHERE pid % 8 IN (3, 5, 7)) t GROUP BY side, reason""", ("parcel",))
def _(d):
    _, u = pair_sides(d)
    p = defective(d).filter("pid % 8 NOT IN (1, 4)").select("pid", F.col("geom").alias("pg"))
    _, notes = spatial.safe_overlay(p, u, "pg", "ug", CELL, "pid", "uid")
    return notes.groupBy("side", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("g25_group_symbol", """
SELECT pid, CAST(7 AS BIGINT) AS n, 7 * x0 AS sx, 7 * y0 AS sy, '3413' AS sn FROM parcel""", ("parcel",))
def _(d):
    from ..plans.postpass import finish_points
    p = d["parcel"].select("pid", G.point("x0", "y0").alias("point"), F.lit("RP3413").alias("signaturnummer"),
                           F.lit(0.0).alias("drehwinkel"), F.array(F.lit("M")).alias("modell"))
    out = finish_points(p)
    v = G.vertices("point")
    return out.select("pid", F.size(v).cast("long").alias("n"), r6(G.total(v, lambda q: q["x"])).alias("sx"),
                      r6(G.total(v, lambda q: q["y"])).alias("sy"), F.col("signaturnummer").alias("sn"))


@query("g26_drop_z", "WITH " + PATH + "SELECT oid, sum(ln) AS total FROM leg GROUP BY oid", ("steps",))
def _(d):
    xyz = F.array(F.transform("part", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), (p["x"] * 2).alias("z"))))
    return d.polylines().select("oid", r6(G.length(G.drop_z(xyz, "LINESTRING"))).alias("total"))


@query("g_wkb_round_trip", "SELECT pid, true AS same, (x1 - x0) * (y1 - y0) AS area FROM parcel", ("parcel",))
def _(d):
    p = d.parcels().withColumn("wkb", G.to_wkb("geom")).withColumn("back", G.from_wkb("wkb"))
    return p.select("pid", (G.wkt("geom") == G.wkt("back")).alias("same"), r6(G.area("back")).alias("area"))


@query("g17_slope_teeth", """
WITH s AS (SELECT oid, CAST(10 * max(k) AS DOUBLE) AS ol, CAST(max(y) AS DOUBLE) AS h FROM steps GROUP BY oid),
t AS (SELECT *, CAST(ceil((ol - 3 - greatest((ol % 6) / 2, 0.01)) / 6) AS BIGINT) AS n FROM s)
SELECT oid, 2 * n - 1 AS teeth, round(n * h + (n - 1) * h / 2, 4) AS total FROM t""", ("steps",))
def _(d):
    # straight slopes: the upper edge on the axis, the lower one parallel below it
    s = d.sql("SELECT oid, CAST(10 * max(k) AS DOUBLE) AS ol, CAST(max(y) AS DOUBLE) AS h FROM steps GROUP BY oid")
    up = F.struct(F.lit(1220).alias("art"), F.array(G.vertex(0, 0), G.vertex(F.col("ol"), F.lit(0))).alias("part"))
    low = F.struct(F.lit(1230).alias("art"), F.array(G.vertex(F.lit(0), -F.col("h")), G.vertex(F.col("ol"), -F.col("h"))).alias("part"))
    e = d.split(s).select(F.col("oid").alias("slope"), F.inline(F.array(up, low)))
    return placement.slope_teeth(e).groupBy(F.col("slope").alias("oid")).agg(F.count(F.lit(1)).alias("teeth"), F.round(F.sum("len"), 4).alias("total"))


@query("g19_house_number_places", """
SELECT uid, CASE uid % 3 WHEN 1 THEN x1 - 1.9 ELSE (x0 + x1) / 2 END AS x, CASE uid % 3 WHEN 0 THEN y1 - 1.9 WHEN 1 THEN (y0 + y1) / 2 ELSE y0 + 1.9 END AS y,
 CAST(CASE uid % 3 WHEN 1 THEN 90 ELSE 0 END AS BIGINT) AS deg FROM usearea""", ("usearea",))
def _(d):
    # the street lies above, to the right of or below the building
    u = d.useareas().withColumn("key", F.col("uid").cast("string"))
    k = F.col("uid") % 3
    street = F.when(k == 0, G.rectangle(F.col("x0"), F.col("y1") + 40, F.col("x1"), F.col("y1") + 50)).when(
        k == 1, G.rectangle(F.col("x1") + 70, F.col("y0"), F.col("x1") + 80, F.col("y1"))).otherwise(
        G.rectangle(F.col("x0"), F.col("y0") - 9, F.col("x1"), F.col("y0") - 5))
    s = u.select(F.col("uid").alias("sid"), F.col("key").alias("skey"), street.alias("sgeom"))
    out = placement.house_number_places(u.select("uid", "key", "geom"), s, "uid", "geom", "key", "sgeom", "skey", "sid")
    # standing text: 90 and 270 degrees are the same line
    deg = F.pmod(F.rint(F.degrees("drehwinkel")), F.lit(180)).cast("long")
    return out.select("uid", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"), deg.alias("deg"))


@query("g19_numbers_of_shaped_houses", """
WITH k AS (SELECT *, (x0 + x1) / 2 AS xm, (y0 + y1) / 2 AS ym, (x1 - x0) / 2 AS a, (y1 - y0) / 2 AS b FROM usearea),
m AS (SELECT *, 1 - 1.9 * sqrt(a * a + b * b) / (a * b) AS s FROM k)
SELECT uid, CASE uid % 3 WHEN 0 THEN (x0 + 11 + x1 - 1.9) / 2 WHEN 1 THEN xm + a * s / 2 ELSE (x0 + 14.9 + x1 - 1.9) / 2 END AS x,
 CASE uid % 3 WHEN 0 THEN y1 - 1.9 WHEN 1 THEN ym + b * s / 2 ELSE y0 + 1.9 END AS y,
 CAST(CASE uid % 3 WHEN 1 THEN round(degrees(atan2(b, -a))) ELSE 0 END AS BIGINT) AS deg FROM m""", ("usearea",))
def _(d):
    # a bay too narrow for the inset, walls at a slant, and a notch in the wall to the street
    u = d.useareas().withColumn("key", F.col("uid").cast("string"))
    k = F.col("uid") % 3
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    xm, ym = (x0 + x1) / 2, (y0 + y1) / 2
    ring = lambda *pts: G.geom("POLYGON", F.array(F.array(*[G.vertex(x, y) for x, y in (*pts, pts[0])])))
    bay = ring((x0, y0), (x1, y0), (x1, y1), (x0 + 11, y1), (x0 + 11, y1 + 1.5), (x0 + 8, y1 + 1.5), (x0 + 8, y1), (x0, y1))
    slant = ring((xm, y0), (x1, ym), (xm, y1), (x0, ym))
    notch = ring((x0, y0), (x0 + 11, y0), (x0 + 11, y0 + 4), (x0 + 13, y0 + 4), (x0 + 13, y0), (x1, y0), (x1, y1), (x0, y1))
    street = F.when(k == 0, G.rectangle(x0, y1 + 40, x1, y1 + 50)).when(k == 1, G.rectangle(x1 + 70, y1 + 70, x1 + 80, y1 + 80)).otherwise(
        G.rectangle(x0, y0 - 9, x1, y0 - 5))
    s = u.select(F.col("uid").alias("sid"), F.col("key").alias("skey"), street.alias("sgeom"))
    houses = u.select("uid", "key", F.when(k == 0, bay).when(k == 1, slant).otherwise(notch).alias("geom"))
    out = placement.house_number_places(houses, s, "uid", "geom", "key", "sgeom", "skey", "sid")
    deg = F.pmod(F.rint(F.degrees("drehwinkel")), F.lit(180)).cast("long")
    return out.select("uid", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"), deg.alias("deg"))


@query("j20_nearest", """
SELECT p_partkey, (SELECT s_suppkey FROM supplier WHERE s_nationkey = p_size % 25
   ORDER BY abs(s_acctbal - p_retailprice), s_suppkey LIMIT 1) AS nearest FROM part WHERE p_size % 25 IN (SELECT s_nationkey FROM supplier)""")
def _(d):
    left = d["part"].select("p_partkey", (F.col("p_size") % 25).alias("k"), G.point(F.col("p_retailprice"), F.lit(0.0)).alias("pg"))
    right = d["supplier"].select("s_suppkey", F.col("s_nationkey").alias("nk"), G.point(F.col("s_acctbal"), F.lit(0.0)).alias("sg"))
    near = placement.nearest(d.split(left), right, "p_partkey", "pg", "sg", [("k", "nk")], ["s_suppkey"], start=512.0)
    return near.select("p_partkey", F.col("s_suppkey").alias("nearest"))
