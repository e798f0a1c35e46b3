"""Nearest neighbours, house-number placement, slope hatching."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geometry as G, text as T
from ..session import cut_lineage
from .spatial import grid_join

# Inset of building outlines and shortest edge for a number, in metres.
NUMBER_INSET, NUMBER_EDGE = 1.9, 1.5
#: Grids on which right rows are counted before a search, and how much finer each is than the one before.
STEPS, FINER = 4, 8
# Tooth spacing and tooth limits of slopes, in metres.
TOOTH_STEP, TOOTH_END, TOOTH_FREE = 6.0, 3.0, 0.01


def nearest(left: DataFrame, right: DataFrame, lid: str, lgeom: str, rgeom: str, on: list[tuple[str, str]],
            order: list[str], start: float = 32.0) -> DataFrame:
    """Nearest right row with equal keys for every left row that has any.

    Looks around each left geometry in a window that doubles until something is
    found, so the rows of a key are never paired with each other as a whole.
    The first window fits the number of right rows close by, ``start`` is its
    size where there are none.  Of right rows with one key and one geometry only
    the first in ``order`` is met.
    Adds the right columns and ``distance``; ties go to the smallest ``order``.
    Rows without a geometry are no neighbours and have none: every row that is
    searched for has a partner at a finite distance, so the doubling ends.
    """
    left, right = left.filter(T.col(lgeom).isNotNull()), right.filter(T.col(rgeom).isNotNull())
    have = right.select(*[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(on)]).distinct()
    todo = left.join(have, [F.col(a) == F.col(f"_k{i}") for i, (a, _) in enumerate(on)], "left_semi")
    keep = [c for c in right.columns]
    here = [b for _, b in on] + [rgeom]
    right = cut_lineage(right.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(here)]).agg(
        F.min_by(F.struct(*keep), F.struct(*order)).alias("_r")).select("_r.*"))
    todo = cut_lineage(todo)
    todo = cut_lineage(todo.join(_first_reach(todo, right, lid, lgeom, rgeom, on, float(start)), lid, "left")
                       .withColumn("_reach", F.coalesce("_reach", F.lit(float(start)))))
    found, reach = None, F.col("_reach")
    while (cell := todo.agg(F.min("_reach")).first()[0]) is not None:
        b = F.col("_box")
        window = todo.withColumn("_box", G.bbox(lgeom)).withColumn("_win", G.rectangle(
            b["xmin"] - reach, b["ymin"] - reach, b["xmax"] + reach, b["ymax"] + reach)).drop("_box")
        near = grid_join(window, right, "_win", rgeom, cell, on=on).withColumn("distance", G.distance(lgeom, rgeom))
        best = (near.filter(F.col("distance") <= reach).groupBy(lid)
                .agg(F.min_by(F.struct(*keep, "distance"), F.struct("distance", *order)).alias("_r")))
        best = cut_lineage(best.select(lid, *[F.col(f"_r.{c}").alias(c) for c in keep], F.col("_r.distance").alias("distance")))
        found = best if found is None else found.unionByName(best)
        todo = cut_lineage(todo.join(best.select(lid), lid, "left_anti").withColumn("_reach", reach * 2))
    out = found if found is not None else todo.limit(0).select(lid).join(right.limit(0).withColumn("distance", F.lit(0.0)), F.lit(False))
    return left.join(out, lid, "inner")


def _first_reach(left: DataFrame, right: DataFrame, lid: str, lgeom: str, rgeom: str, on: list[tuple[str, str]], start: float) -> DataFrame:
    """A first window per ``lid`` in the finest of some grids whose cell around it holds a right row.

    It only decides how many right rows are looked at first, not which is found.
    """
    def cells(df, geom, keys):
        b = G.bbox(geom)
        at = df.select(*keys, ((b["xmin"] + b["xmax"]) / 2).alias("_x"), ((b["ymin"] + b["ymax"]) / 2).alias("_y"))
        size = F.lit(start) / F.pow(F.lit(float(FINER)), F.col("_step"))
        return (at.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(STEPS)))).withColumn("_size", size)
                .withColumn("_cx", F.floor(F.col("_x") / F.col("_size"))).withColumn("_cy", F.floor(F.col("_y") / F.col("_size"))))

    names = [f"_on{i}" for i in range(len(on))]
    by = [*names, "_step", "_cx", "_cy"]
    many = cells(right, rgeom, [F.col(b).alias(n) for n, (_, b) in zip(names, on)]).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    met = cells(left, lgeom, [lid, *[F.col(a).alias(n) for n, (a, _) in zip(names, on)]]).join(many, by)
    finest = met.groupBy(lid).agg(F.max(F.struct("_step", "_size", "_n")).alias("_c"))
    side, n = F.col("_c._size"), F.col("_c._n")
    return finest.select(lid, F.least(1.5 * side, F.greatest(side / FINER, 3 * side / F.sqrt(n))).alias("_reach"))


def upright(angle: Column) -> Column:
    """Angle in 0..2 pi turned by half a turn where text would stand on its head."""
    a = F.pmod(angle, F.lit(2 * math.pi))
    return F.when(a.between(0.5 * math.pi, math.pi), a + math.pi).when(a.between(math.pi, 1.5 * math.pi), a - math.pi).otherwise(a)


def house_number_places(buildings: DataFrame, streets: DataFrame, bid: str, bgeom: str, bkey: str, sgeom: str, skey: str, sid: str) -> DataFrame:
    """Place and angle of a house number: the edge of the shrunk outline that faces its street.

    Only edges longer than 1.5 m count; the number stands on the middle of the
    edge whose middle is nearest to the nearest parcel of the street, longer
    edges first.  Notches, slanted walls and wings that are too thin for a
    number change the shrunk outline, yet leave its other edges; it has none,
    and so no number, only where no point lies 1.9 m inside the walls.
    """
    outer = G.let(G.inset_outer_parts(bgeom, NUMBER_INSET), lambda rings: F.filter(
        G.inset_edges(bgeom, NUMBER_INSET), lambda e: F.array_contains(rings, e["part"])))
    spots = F.transform(G.inset_corners(bgeom, NUMBER_INSET), lambda p: F.array(p, p))
    parts = F.concat(F.transform(outer, lambda e: F.array(e["a"], e["b"])), spots)
    b = (buildings.filter(G.is_polygon(bgeom)).select(bid, bkey, F.explode(F.filter(F.array(parts), lambda p: F.size(p) > 0)).alias("_parts"))
         .withColumn("_line", G.geom("MULTILINESTRING", F.col("_parts"))).drop("_parts"))
    # read twice by each round of the search
    b = cut_lineage(b)
    s = streets.select(F.col(skey).alias("_skey"), F.col(sid).alias("_sid"), F.explode(G.part_geoms(sgeom)).alias("_sg"))
    hit = nearest(b, s, bid, "_line", "_sg", [(bkey, "_skey")], ["_sid"])
    e = hit.select(bid, "_sg", F.explode(G.edges("_line")).alias("e"))
    mid = lambda ax: (F.col("e")["a"][ax] + F.col("e")["b"][ax]) / 2
    e = e.withColumn("_len", G.seg_length(F.col("e"))).filter(F.col("_len") > NUMBER_EDGE)
    e = e.withColumn("x", mid("x")).withColumn("y", mid("y"))
    e = e.withColumn("_d", G.distance_to_point("_sg", F.col("x"), F.col("y")))
    pick = F.struct(F.round("_d", 6), -F.round("_len", 6), F.round("x", 6), F.round("y", 6))
    best = e.groupBy(bid).agg(F.min_by(F.struct("e", "x", "y"), pick).alias("_b"))
    edge = F.col("_b.e")
    return best.select(bid, F.col("_b.x").alias("x"), F.col("_b.y").alias("y"),
                       upright(F.lit(0.5 * math.pi) - G.azimuth(edge["a"], edge["b"])).alias("drehwinkel"))


# -- slopes ---------------------------------------------------------------

#: Teeth up to which edges with equally many of them are clipped in one go, all pairs of an edge held at once.
TEETH_AT_ONCE = 64
#: Edges of a slope up to which they are held in the rows of its teeth.
EDGES_AT_HAND = 64


def _meet(p: np.ndarray, d: np.ndarray, q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the rays ``p + t d`` and ``q + u e`` cross: whether they do, t and u."""
    cross = d[..., 0] * e[..., 1] - d[..., 1] * e[..., 0]
    rel = q - p
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (rel[..., 0] * e[..., 1] - rel[..., 1] * e[..., 0]) / cross
        u = (rel[..., 0] * d[..., 1] - rel[..., 1] * d[..., 0]) / cross
    return (np.abs(cross) > 1e-12) & (t > TOOTH_FREE) & (u >= 0), t, u


def _clip_edges(p: np.ndarray, d: np.ndarray, ln: np.ndarray) -> np.ndarray:
    """Lengths of the teeth of edges with equally many (edge, tooth), shortened at each other, longest first."""
    ln = ln.copy()
    each = np.arange(len(ln))
    for i in np.argsort(-ln, axis=1, kind="stable").T:
        meets, t, u = _meet(p[each, i][:, None], d[each, i][:, None], p, d)
        hit = meets & (t <= ln[each, i][:, None]) & (u <= ln)
        hit[each, i] = False
        ln[each, i] = np.minimum(ln[each, i], np.where(hit, t, np.inf).min(axis=1))
    return ln


def _clip_teeth(pdf: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
    """Shortens the teeth of whole upper edges at each other; ``first`` are the rows that begin an edge."""
    p, d = pdf[["x", "y"]].to_numpy(), pdf[["nx", "ny"]].to_numpy()
    ln = pdf["len"].to_numpy().copy()
    count = np.diff(np.append(first, len(pdf)))
    for n in np.unique(count[count > 1]):
        at = first[count == n][:, None] + np.arange(n)
        if n <= TEETH_AT_ONCE:
            # teeth only get shorter: an edge where none cross at full length stays as it is
            meets, t, u = _meet(p[at][:, :, None], d[at][:, :, None], p[at][:, None], d[at][:, None])
            hit = meets & (t <= ln[at][:, :, None]) & (u <= ln[at][:, None]) & ~np.eye(n, dtype=bool)
            at = at[hit.any(axis=(1, 2))]
        if len(at):
            ln[at] = _clip_edges(p[at], d[at], ln[at])
    return pdf.assign(len=ln)


def _clip_batches(batches: Iterator[pd.DataFrame], edge: list[str]) -> Iterator[pd.DataFrame]:
    """Clips rows sorted by ``edge``; an edge that is cut by the end of a batch waits for the rest of it."""
    held: list[pd.DataFrame] = []
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        new = np.ones(len(pdf), dtype=bool)
        for k, c in enumerate(edge):
            key = pdf[c].to_numpy()
            new[1:] = (key[1:] != key[:-1]) if k == 0 else new[1:] | (key[1:] != key[:-1])
        new[0] = last is None or last != tuple(pdf[c].iloc[0] for c in edge)
        last = tuple(pdf[c].iloc[-1] for c in edge)
        begins = np.flatnonzero(new)
        if len(begins):
            yield from _clip_held([*held, pdf.iloc[:begins[-1]]], edge)
            held = [pdf.iloc[begins[-1]:]]
        else:
            held.append(pdf)
    yield from _clip_held(held, edge)


def _clip_held(parts: list[pd.DataFrame], edge: list[str]) -> Iterator[pd.DataFrame]:
    if parts and sum(map(len, parts)):
        pdf = pd.concat([x for x in parts if len(x)], ignore_index=True)
        new = (pdf[edge] != pdf[edge].shift()).any(axis=1).to_numpy()
        new[0] = True
        yield _clip_teeth(pdf, np.flatnonzero(new))


def slope_teeth(edges: DataFrame, slope: str = "slope", art: str = "art", part: str = "part", cell: float = 32.0,
                upper: int = 1220, lower: int = 1230) -> DataFrame:
    """Hatching of slopes: ``slope, upper, o, x, y, tx, ty`` with long and short teeth.

    Long teeth stand every 6 m on the upper edge and reach to the first edge of
    the slope in their way; where teeth cross, the longest goes first.  Between
    two long teeth stands a short one of half their mean length.
    """
    # read five times below
    edges = cut_lineage(edges)
    top = edges.filter(F.col(art) == upper).withColumn("upper", F.xxhash64(F.col(part))).withColumn("_ol", G.part_length(F.col(part)))
    top = top.filter(F.col("_ol") >= TOOTH_STEP).select(slope, "upper", "_ol", F.col(part).alias("_p"))
    low = edges.filter(F.col(art) == lower).select(F.col(slope).alias("_s"), F.col(part).alias("_lp"))
    low = low.withColumn("_lg", G.line(F.col("_lp")))

    # side and end connections: distances to the lower edges of the slope, reduced per upper edge
    probe = lambda off: G.line(G.offset_line(F.col("_p"), off))
    ends = top.join(low, F.col(slope) == F.col("_s"))
    first, last = G.start_vertex(F.col("_p")), G.end_vertex(F.col("_p"))
    closest = lambda v: F.array_min(F.transform("_lp", lambda q: F.struct(
        G.dist(q["x"], q["y"], v["x"], v["y"]).alias("d"), q["x"].alias("x"), q["y"].alias("y"))))
    # the probe is worked out once per pair, not once per use in the distance
    away = lambda off: G.let(probe(off), lambda g: G.distance(g, F.col("_lg")))
    info = ends.groupBy(slope, "upper").agg(
        F.min(away(-0.001)).alias("_dr"), F.min(away(0.001)).alias("_dl"),
        F.min(closest(first)).alias("_c0"), F.min(closest(last)).alias("_c1"))
    side = F.when(F.col("_dr") > F.col("_dl"), -1.0).otherwise(1.0)
    # used four times below: one row per upper edge
    top = cut_lineage(top.join(info, [slope, "upper"], "left").withColumn("_side", side).drop("_dr", "_dl"))

    seg = lambda v, c: F.struct(v.alias("a"), G.vertex(c["x"], c["y"]).alias("b"))
    join_up = top.filter("_c0 IS NOT NULL").select(slope, F.explode(F.array(seg(first, F.col("_c0")), seg(last, F.col("_c1")))).alias("_e"))
    cuts = edges.select(slope, F.explode(G.segments(F.col(part))).alias("_e")).unionByName(join_up)
    cuts = cuts.filter(G.seg_length(F.col("_e")) > 0).select(F.col(slope).alias("_cs"), "_e")
    v = F.col("_v")
    far = (edges.select(slope, F.explode(part).alias("_v")).groupBy(slope).agg(
        F.min(v["x"]).alias("x0"), F.max(v["x"]).alias("x1"), F.min(v["y"]).alias("y0"), F.max(v["y"]).alias("y1"))
        .select(slope, (G.dist(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")) * 1.1).alias("_far")))
    # the edges of a slope with few of them travel with its teeth, those of any other are met on the grid
    cuts = cut_lineage(cuts)
    many = cuts.groupBy(F.col("_cs").alias(slope)).agg(F.count(F.lit(1)).alias("_n"))
    few = cuts.join(many.filter(F.col("_n") <= EDGES_AT_HAND), F.col("_cs") == F.col(slope), "left_semi").groupBy(
        F.col("_cs").alias(slope)).agg(F.collect_list("_e").alias("_es"))
    far = far.join(few, slope, "left")

    def stand(df, o):
        """Foot and direction of a tooth at distance ``o``."""
        at = lambda d: G.interpolate(F.col("_p"), (o + d) / F.col("_ol"), F.col("_ol"))
        df = df.withColumn("_a", at(0.0)).withColumn("_b", at(0.001))
        ln = G.dist(F.col("_a.x"), F.col("_a.y"), F.col("_b.x"), F.col("_b.y"))
        return df.select("*", F.col("_a.x").alias("x"), F.col("_a.y").alias("y"),
                         (F.col("_side") * (F.col("_b.y") - F.col("_a.y")) / ln).alias("nx"),
                         (-F.col("_side") * (F.col("_b.x") - F.col("_a.x")) / ln).alias("ny")).drop("_a", "_b")

    begin = F.greatest(F.pmod("_ol", F.lit(TOOTH_STEP)) / 2, F.lit(TOOTH_FREE))
    count = F.ceil((F.col("_ol") - TOOTH_END - begin) / TOOTH_STEP)
    rays = (top.join(far, slope).filter(count > 0).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
            .withColumn("o", begin + F.col("_i") * TOOTH_STEP))
    rays = stand(rays.drop("_c0", "_c1"), F.col("o"))
    end = G.vertex(F.col("x") + F.col("nx") * F.col("_far"), F.col("y") + F.col("ny") * F.col("_far"))

    def crossing(e):
        """Distances along the tooth and along the edge ``e`` where their lines cross; null for parallel ones."""
        ex, ey = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        rx, ry = e["a"]["x"] - F.col("x"), e["a"]["y"] - F.col("y")
        return G.let(F.col("nx") * ey - F.col("ny") * ex, lambda c: F.when(F.abs(c) > 1e-12, F.struct(
            ((rx * ey - ry * ex) / c).alias("t"), ((rx * F.col("ny") - ry * F.col("nx")) / c).alias("u"))))

    meets = lambda c: (c["t"] > TOOTH_FREE) & c["u"].between(-1e-9, 1 + 1e-9)
    reached = lambda e: (F.greatest(e["a"]["x"], e["b"]["x"]) >= F.least(F.col("x"), F.col("_end.x"))) & (
        F.least(e["a"]["x"], e["b"]["x"]) <= F.greatest(F.col("x"), F.col("_end.x"))) & (
        F.greatest(e["a"]["y"], e["b"]["y"]) >= F.least(F.col("y"), F.col("_end.y"))) & (
        F.least(e["a"]["y"], e["b"]["y"]) <= F.greatest(F.col("y"), F.col("_end.y")))
    at_hand = F.array_min(F.transform(F.filter(F.transform(F.filter("_es", reached), crossing), meets), lambda c: c["t"]))
    rays = cut_lineage(rays.withColumn("_end", end).withColumn("len", at_hand).withColumn("_grid", F.col("_es").isNull())
                       .select(slope, "upper", "o", "x", "y", "nx", "ny", "_end", "len", "_grid"))

    apart = rays.filter("_grid").select(slope, "upper", "o", "x", "y", "nx", "ny", G.line(F.array(G.vertex("x", "y"), F.col("_end"))).alias("_ray"))
    large = cuts.join(many.filter(F.col("_n") > EDGES_AT_HAND), F.col("_cs") == F.col(slope), "left_semi")
    met = grid_join(apart, large.withColumn("_cg", G.line(F.array(F.col("_e.a"), F.col("_e.b")))), "_ray", "_cg", cell, on=[(slope, "_cs")])
    hits = met.withColumn("_c", crossing(F.col("_e"))).filter(meets(F.col("_c"))).groupBy(slope, "upper", "o").agg(F.min("_c.t").alias("len"))
    foot = [slope, "upper", "o", "x", "y", "nx", "ny"]
    full = rays.filter("NOT _grid AND len IS NOT NULL").select(*foot, "len").unionByName(
        rays.filter("_grid").select(*foot).join(hits, [slope, "upper", "o"]))
    # a task takes many edges at a time and holds whole edges: as much as a batch, or one edge if that is larger
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in full.schema.fields)
    sorted_ = full.repartition(slope, "upper").sortWithinPartitions(slope, "upper", "o")
    clipped = cut_lineage(sorted_.mapInPandas(lambda batches: _clip_batches(batches, [slope, "upper"]), types))

    from pyspark.sql import Window
    w = Window.partitionBy(slope, "upper").orderBy("o")
    between = clipped.withColumn("_po", F.lag("o").over(w)).withColumn("_pl", F.lag("len").over(w)).filter("_po IS NOT NULL")
    between = between.select(slope, "upper", ((F.col("_po") + F.col("o")) / 2).alias("o"), ((F.col("_pl") + F.col("len")) / 4).alias("len"))
    short = stand(between.join(top.select(slope, "upper", "_ol", "_p", "_side"), [slope, "upper"]), F.col("o"))
    cols = [slope, "upper", "o", "x", "y", "nx", "ny", "len"]
    every = clipped.select(*cols).unionByName(short.select(*cols))
    return every.select(slope, "upper", "o", "x", "y", (F.col("x") + F.col("nx") * F.col("len")).alias("tx"),
                        (F.col("y") + F.col("ny") * F.col("len")).alias("ty"), "len")
