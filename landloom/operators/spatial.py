"""Spatial joins and overlays on a grid of several levels.

Every geometry sits in the cells of the level that fits its own size (at most
four cells), so one large polygon never fills millions of cells.  A pair meets
on the coarser of the two levels, in the cell that holds the lower left corner
of the common box, so it is found exactly once and needs no distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geometry as G
from .skew import HOT_ROWS, salted

MAX_LEVEL = 31


def with_level(df: DataFrame, geom: str, cell: float, box: str, level: str) -> DataFrame:
    b = G.bbox(geom)
    df = df.filter(F.col(geom).isNotNull() & (F.size(F.col(geom)["parts"]) > 0)).withColumn(box, b)
    side = F.greatest(F.col(box)["xmax"] - F.col(box)["xmin"], F.col(box)["ymax"] - F.col(box)["ymin"])
    fit = F.when(side > cell, F.ceil(F.log2(side / F.lit(float(cell))))).otherwise(0)
    return df.withColumn(level, F.least(fit, F.lit(MAX_LEVEL)).cast("int"))


def _size(level: Column, cell: float) -> Column:
    return F.lit(float(cell)) * F.pow(F.lit(2.0), level)


def _spread(df: DataFrame, other_levels: DataFrame, box: str, level: str, cell: float) -> DataFrame:
    """One row per cell, on the own level and on the coarser levels of the other side."""
    # at most MAX_LEVEL + 1 numbers in a single row
    one = F.broadcast(other_levels.agg(F.collect_set(other_levels.columns[0]).alias("_lv")).withColumn("_one", F.lit(1)))
    df = df.withColumn("_one", F.lit(1)).join(one, "_one").drop("_one")
    levels = F.array_distinct(F.concat(F.array(F.col(level)), F.filter("_lv", lambda v: v > F.col(level))))
    df = df.withColumn("_cl", F.explode(levels)).drop("_lv")
    s = _size(F.col("_cl"), cell)
    span = lambda lo, hi: F.sequence(F.floor(F.col(box)[lo] / s), F.floor(F.col(box)[hi] / s))
    return df.withColumn("_cx", F.explode(span("xmin", "xmax"))).withColumn("_cy", F.explode(span("ymin", "ymax")))


def grid_join(left: DataFrame, right: DataFrame, lgeom: str, rgeom: str, cell: float,
              on: list[tuple[str, str]] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pairs whose boxes overlap; both sides need distinct column names.

    ``on`` names further equal columns.  Hot cells of the left side are salted.
    """
    l = with_level(left, lgeom, cell, "_lb", "_ll")
    r = with_level(right, rgeom, cell, "_rb", "_rl")
    l2 = _spread(l, r.select("_rl"), "_lb", "_ll", cell)
    r2 = _spread(r, l.select("_ll"), "_rb", "_rl", cell)
    keys = ["_cl", "_cx", "_cy"]
    for a, b in on or []:
        key = f"_on_{a}"
        l2, r2 = l2.withColumn(key, F.col(a)), r2.withColumn(key, F.col(b))
        keys.append(key)
    l2, r2 = salted(l2, r2, keys, hot_rows)
    pairs = l2.join(r2, [*keys, "_salt"])
    s = _size(F.col("_cl"), cell)
    lb, rb = F.col("_lb"), F.col("_rb")
    meet = ((F.col("_cl") == F.greatest("_ll", "_rl")) & G.bbox_overlaps(lb, rb)
            & (F.floor(F.greatest(lb["xmin"], rb["xmin"]) / s) == F.col("_cx"))
            & (F.floor(F.greatest(lb["ymin"], rb["ymin"]) / s) == F.col("_cy")))
    return pairs.filter(meet).drop(*keys, "_salt", "_ll", "_rl", "_lb", "_rb")


def intersects_join(left: DataFrame, right: DataFrame, lgeom: str, rgeom: str, cell: float, **kw) -> DataFrame:
    """Pairs that share at least one point."""
    return grid_join(left, right, lgeom, rgeom, cell, **kw).filter(G.intersects(lgeom, rgeom))


def overlay(left: DataFrame, right: DataFrame, lgeom: str, rgeom: str, cell: float,
            out: str = "common", eps: float = 1e-6, **kw) -> DataFrame:
    """Pairs of polygons whose interiors overlap, with the common area."""
    pairs = grid_join(left, right, lgeom, rgeom, cell, **kw)
    return pairs.withColumn(out, G.intersection_area(lgeom, rgeom)).filter(F.col(out) > eps)


def safe_overlay(left: DataFrame, right: DataFrame, lgeom: str, rgeom: str, cell: float,
                 lid: str, rid: str, out: str = "common", **kw) -> tuple[DataFrame, DataFrame]:
    """Overlay that never fails on bad input: pairs, and a table of the geometries left out."""
    bad_l = left.withColumn("reason", G.problem(lgeom))
    bad_r = right.withColumn("reason", G.problem(rgeom))
    notes = (bad_l.filter("reason IS NOT NULL").select(F.col(lid).cast("string").alias("id"), F.lit("left").alias("side"), "reason")
             .unionByName(bad_r.filter("reason IS NOT NULL").select(F.col(rid).cast("string").alias("id"), F.lit("right").alias("side"), "reason")))
    good = overlay(bad_l.filter("reason IS NULL").drop("reason"), bad_r.filter("reason IS NULL").drop("reason"),
                   lgeom, rgeom, cell, out, **kw)
    return good, notes


def edge_table(df: DataFrame, geom: str, keep: list[str], grid: float = 0.001) -> DataFrame:
    """One row per edge, snapped to the grid, in canonical direction with sign."""
    e = F.col("_e")
    inv = float(round(1 / grid))
    on = lambda c: F.rint(c * inv) / inv
    flat = df.select(*keep, F.explode(G.edges(geom)).alias("_e")).select(
        *keep, on(e["a"]["x"]).alias("ax"), on(e["a"]["y"]).alias("ay"),
        on(e["b"]["x"]).alias("bx"), on(e["b"]["y"]).alias("by"))
    flat = flat.filter((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by")))
    return canonical(flat, keep)


def canonical(flat: DataFrame, keep: list[str]) -> DataFrame:
    fwd = (F.col("ax") < F.col("bx")) | ((F.col("ax") == F.col("bx")) & (F.col("ay") < F.col("by")))
    pick = lambda p, q, name: F.when(fwd, F.col(p)).otherwise(F.col(q)).alias(name)
    return flat.select(*keep, pick("ax", "bx", "ax"), pick("ay", "by", "ay"), pick("bx", "ax", "bx"),
                       pick("by", "ay", "by"), F.when(fwd, 1).otherwise(-1).alias("dir"))


EDGE = ["ax", "ay", "bx", "by"]


def shared_borders(df: DataFrame, geom: str, fid: str, grid: float = 0.001, cell: float = 64.0) -> DataFrame:
    """Border pieces common to two polygons: ``a, b, ax, ay, bx, by`` with a before b.

    Equal edges meet in an equi join; edges without an equal partner are
    compared for collinear overlap on the grid.
    """
    edges = edge_table(df, geom, [fid], grid).select(fid, *EDGE).distinct()
    a = edges.withColumnRenamed(fid, "a")
    b = edges.withColumnRenamed(fid, "b")
    l, r = salted(a, b, EDGE)
    equal = l.join(r, [*EDGE, "_salt"]).filter("a < b").select("a", "b", *EDGE)

    # the other edges are compared once per distinct edge, not once per polygon
    line = G.line(F.array(G.vertex("ax", "ay"), G.vertex("bx", "by")))
    once = edges.select(*EDGE).distinct().withColumn("_g", line)
    left = once.select(F.col("_g").alias("_gl"), *[F.col(c).alias(f"l{c}") for c in EDGE])
    right = once.select(F.col("_g").alias("_gr"), *[F.col(c).alias(f"r{c}") for c in EDGE])
    near = grid_join(left, right, "_gl", "_gr", cell).drop("_gl", "_gr")
    near = near.filter(F.struct(*[f"l{c}" for c in EDGE]) < F.struct(*[f"r{c}" for c in EDGE]))
    dx, dy = F.col("lbx") - F.col("lax"), F.col("lby") - F.col("lay")
    ln = F.sqrt(dx * dx + dy * dy)
    off = lambda x, y: (dx * (F.col(y) - F.col("lay")) - dy * (F.col(x) - F.col("lax"))) / ln
    along = lambda x, y: ((F.col(x) - F.col("lax")) * dx + (F.col(y) - F.col("lay")) * dy) / (ln * ln)
    t0, t1 = along("rax", "ray"), along("rbx", "rby")
    lo, hi = F.greatest(F.least(t0, t1), F.lit(0.0)), F.least(F.greatest(t0, t1), F.lit(1.0))
    inv = float(round(1 / grid))
    at = lambda base, d, t: F.rint((F.col(base) + d * t) * inv) / inv
    touching = near.filter((F.abs(off("rax", "ray")) <= grid / 2) & (F.abs(off("rbx", "rby")) <= grid / 2)
                           & ((hi - lo) * ln > grid))
    cut = touching.select(*[f"{s}{c}" for s in "lr" for c in EDGE], at("lax", dx, lo).alias("ax"), at("lay", dy, lo).alias("ay"),
                          at("lax", dx, hi).alias("bx"), at("lay", dy, hi).alias("by"))
    of = lambda side, name: edges.select(F.col(fid).alias(name), *[F.col(c).alias(f"{side}{c}") for c in EDGE])
    owned = cut.join(of("l", "_a"), [f"l{c}" for c in EDGE]).join(of("r", "_b"), [f"r{c}" for c in EDGE]).filter("_a <> _b")
    part = owned.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), *EDGE)
    return equal.unionByName(part)


def same_point(a: DataFrame, b: DataFrame, agx: str, bgx: str, digits: int = 3, how: str = "inner") -> DataFrame:
    """Equi join of point geometries on rounded coordinates."""
    key = lambda g: F.struct(F.round(F.col(g)["parts"][0][0]["x"], digits).alias("x"),
                             F.round(F.col(g)["parts"][0][0]["y"], digits).alias("y"))
    return a.withColumn("_xy", key(agx)).join(b.withColumn("_xy", key(bgx)), "_xy", how).drop("_xy")
