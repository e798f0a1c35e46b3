"""Polygon jobs: dissolve, ring building, simplify, area fill, repair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geometry as G
from ..session import cut_lineage
from .lookups import thin
from .spatial import EDGE, canonical, edge_table, grid_join

# Placing rules (id, spacing, row spacing, row shift, density in percent).
PLACING_RULES = [
    (1100, 7.0, 3.5, 3.5, 100), (1101, 7.0, 3.5, 3.5, 20), (1102, 18.0, 10.0, 9.0, 100), (1103, 18.0, 10.0, 9.0, 20),
    (1104, 24.0, 22.0, 12.0, 100), (1105, 24.0, 22.0, 12.0, 20), (1106, 10.0, 3.0, 5.0, 100), (1107, 10.0, 3.0, 5.0, 20),
    (1108, 8.0, 7.0, 4.0, 100), (1109, 8.0, 7.0, 4.0, 20), (1110, 7.0, 6.0, 3.5, 100), (1111, 7.0, 6.0, 3.5, 20),
    (1112, 3.0, 1.5, 1.5, 100)]
INSET = 0.5


def boundary_edges(df: DataFrame, keys: list[str], geom: str, grid: float = 0.001, node: bool = False,
                   cell: float = 64.0) -> DataFrame:
    """Outline of the union per key as directed edges, the inside on the left.

    An edge run through in both directions within a key is inside and drops
    out; that is one sum with map-side combine.  ``node=True`` first splits
    edges at vertices of the same key that lie on them.
    """
    edges = edge_table(df, geom, keys, grid)
    if node:
        edges = _noded(edges, keys, cell, grid)
    net = edges.groupBy(*keys, *EDGE).agg(F.sum("dir").alias("dir")).filter("dir <> 0")
    fwd = F.col("dir") > 0
    return net.select(*keys, *[F.when(fwd, F.col(p)).otherwise(F.col(q)).alias(p)
                               for p, q in (("ax", "bx"), ("ay", "by"), ("bx", "ax"), ("by", "ay"))])


def _noded(edges: DataFrame, keys: list[str], cell: float, grid: float) -> DataFrame:
    """Split edges at the vertices of the same key that lie on them."""
    merged = edges.groupBy(*keys, *EDGE).agg(F.sum("dir").alias("dir"), F.count(F.lit(1)).alias("_n"))
    verts = (merged.select(*keys, F.explode(F.array(F.struct("ax", "ay"), F.struct(F.col("bx").alias("ax"), F.col("by").alias("ay")))).alias("v"))
             .select(*[F.col(k).alias(f"_v{k}") for k in keys], "v.*").distinct()
             .select(*[f"_v{k}" for k in keys], F.col("ax").alias("_px"), F.col("ay").alias("_py"))
             .withColumn("_gp", G.point("_px", "_py")))
    lines = merged.select(*keys, *EDGE).withColumn("_gl", G.line(F.array(G.vertex("ax", "ay"), G.vertex("bx", "by"))))
    near = grid_join(lines, verts, "_gl", "_gp", cell, on=[(k, f"_v{k}") for k in keys])
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    ln = F.sqrt(dx * dx + dy * dy)
    t = ((F.col("_px") - F.col("ax")) * dx + (F.col("_py") - F.col("ay")) * dy) / (ln * ln)
    off = F.abs(dx * (F.col("_py") - F.col("ay")) - dy * (F.col("_px") - F.col("ax"))) / ln
    cuts = (near.withColumn("_t", t).filter((off <= grid / 2) & (F.col("_t") * ln > grid / 2) & ((1 - F.col("_t")) * ln > grid / 2))
            .groupBy(*keys, *EDGE).agg(F.array_sort(F.collect_list(F.struct("_t", "_px", "_py"))).alias("_c")))
    stops = F.concat(F.array(F.struct(F.lit(0.0).alias("t"), F.col("ax").alias("x"), F.col("ay").alias("y"))),
                     F.transform(F.coalesce("_c", F.slice(F.array(F.struct(F.lit(0.0).alias("_t"), F.lit(0.0).alias("_px"), F.lit(0.0).alias("_py"))), 1, 0)),
                                 lambda c: F.struct(c["_t"].alias("t"), c["_px"].alias("x"), c["_py"].alias("y"))),
                     F.array(F.struct(F.lit(1.0).alias("t"), F.col("bx").alias("x"), F.col("by").alias("y"))))
    pieces = merged.join(cuts, [*keys, *EDGE], "left").select(*keys, "dir", F.explode(F.zip_with(
        F.slice(stops, 1, F.size(stops) - 1), F.slice(stops, 2, F.size(stops) - 1),
        lambda p, q: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), q["x"].alias("bx"), q["y"].alias("by")))).alias("_p"))
    return canonical(pieces.select(*keys, F.col("dir").alias("_dir"), "_p.*"), [*keys, "_dir"]).withColumn(
        "dir", F.col("dir") * F.col("_dir")).drop("_dir")


def edge_sums(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Area, outline length and edge count per key straight from directed edges."""
    strip = (F.col("ax") - F.col("bx")) * (F.col("ay") + F.col("by")) / 2
    return edges.groupBy(*keys).agg(
        F.sum(strip).alias("area"),
        F.sum(G.dist(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))).alias("outline"),
        F.count(F.lit(1)).alias("edges"))


def ring_order(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``ring`` (its first edge) and ``pos`` to directed edges, without collecting a ring.

    Every edge looks ahead 1, 2, 4, ... edges and keeps the smallest edge seen
    and its distance; after log2(length) joins each edge knows the first edge
    of its ring.  Each round is checkpointed.
    """
    start, end = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    eid = F.struct(*EDGE)
    head = F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax"))
    out_edges = edges.select(*keys, start.alias("_at"), eid.alias("_to"), head.alias("_h1"))
    # where several edges start at a node the sharpest left turn keeps rings apart
    turn = F.pmod(F.col("_h1") - F.col("_h0") + F.lit(np.pi), F.lit(2 * np.pi))
    follow = (edges.select(*keys, eid.alias("id"), end.alias("_at"), head.alias("_h0"))
              .join(out_edges, [*keys, "_at"]).groupBy(*keys, "id").agg(F.max_by("_to", turn).alias("nxt")))
    state = cut_lineage(follow.select(*keys, "id", "nxt", F.col("id").alias("first"), F.lit(0).cast("long").alias("ahead")))
    width = 1
    while True:
        ahead = state.select(*keys, F.col("id").alias("nxt"), F.col("nxt").alias("_n2"),
                             F.col("first").alias("_f2"), F.col("ahead").alias("_a2"))
        better = F.col("_f2") < F.col("first")
        state = cut_lineage(state.join(ahead, [*keys, "nxt"]).select(
            *keys, "id", F.col("_n2").alias("nxt"),
            F.when(better, F.col("_f2")).otherwise(F.col("first")).alias("first"),
            F.when(better, F.col("_a2") + width).otherwise(F.col("ahead")).alias("ahead"),
            better.alias("moved")))
        width *= 2
        if state.filter("moved").isEmpty():
            break
        state = state.drop("moved")
    return state.select(*keys, F.col("first").alias("ring"), F.when(F.col("ahead") == 0, 0).otherwise(-F.col("ahead")).alias("pos"), "id.*")


def rings(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Closed rings per key; one output row is one ring."""
    ordered = ring_order(edges, keys)
    # the first edge has distance 0 and comes first, the others follow by shrinking distance
    seq = F.when(F.col("pos") == 0, F.lit(-(1 << 62))).otherwise(F.col("pos"))
    path = F.transform(F.array_sort(F.collect_list(F.struct(seq.alias("o"), F.col("ax").alias("x"), F.col("ay").alias("y")))),
                       lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return (ordered.groupBy(*keys, "ring").agg(path.alias("_p"))
            .select(*keys, F.concat("_p", F.slice("_p", 1, 1)).alias("vertices")))


def straightened(ring: Column) -> Column:
    """Closed ring without vertices inside straight runs."""
    body = F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0)))
    m = F.size(body)

    def corner(p, i):
        a, b = F.get(body, (i + m - 1) % m), F.get(body, (i + 1) % m)
        return F.abs((p["x"] - a["x"]) * (b["y"] - p["y"]) - (p["y"] - a["y"]) * (b["x"] - p["x"])) > 1e-9

    kept = F.filter(body, corner)
    return F.concat(kept, F.slice(kept, 1, 1))


def dissolve(df: DataFrame, keys: list[str], geom: str, out: str = "polygon", srid: int = 25832, node: bool = True, **kw) -> DataFrame:
    """Union of polygons per key as one multi polygon.

    Edges are split where a neighbour has a vertex inside them; ``node=False``
    saves that step where all neighbours share their vertices.
    """
    r = rings(boundary_edges(df, keys, geom, node=node, **kw), keys)
    parts = F.transform(F.array_sort(F.collect_list(F.struct(
        (-G.ring_area2(F.col("vertices"))).alias("o"), F.col("vertices").alias("v")))), lambda p: p["v"])
    return r.groupBy(*keys).agg(G.geom("MULTIPOLYGON", parts, srid).alias(out))


def _douglas_peucker(pts: np.ndarray, tol: float) -> np.ndarray:
    keep = np.zeros(len(pts), bool)
    keep[[0, -1]] = True
    todo = [(0, len(pts) - 1)]
    while todo:
        i, j = todo.pop()
        if j <= i + 1:
            continue
        a, b, mid = pts[i], pts[j], pts[i + 1:j]
        d = b - a
        l2 = float(d @ d)
        t = np.clip(((mid - a) @ d) / l2, 0, 1) if l2 > 0 else np.zeros(len(mid))
        far = np.hypot(*(mid - (a + t[:, None] * d)).T)
        k = int(far.argmax())
        if far[k] > tol:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return pts[keep]


def simplify(geom: str | Column, tolerance: float) -> Column:
    """Douglas-Peucker per part; rings that collapse go."""
    @F.arrow_udf(G.GEOM_TYPE)
    def run(g: pa.Array) -> pa.Array:
        out = []
        for row in G.unpack(g):
            if row is not None:
                small = [_douglas_peucker(p, tolerance) if len(p) > 2 else p for p in row[2]]
                row = (row[0], row[1], [p for p in small if "POLYGON" not in row[0] or len(p) >= 4])
            out.append(row)
        return G.pack(out)

    return run(G.col(geom))


def inset_box(geom: str, d: float) -> Column:
    """Box of the polygon shrunk by ``d``, to the micrometre; null where nothing is left."""
    ends = F.flatten(F.transform(G.inset_edges(geom, d), lambda e: F.array(e["a"], e["b"])))
    least = lambda ax, pick: lambda vs: F.round(pick(F.transform(vs, lambda v: v[ax])), 6)
    box = lambda vs: F.struct(*[least(ax, pick)(vs).alias(ax + n) for n, pick in (("min", F.array_min), ("max", F.array_max)) for ax in "xy"])
    return G.let(F.concat(ends, G.inset_corners(geom, d)), box)


def area_fill(df: DataFrame, geom: str, rule: str, keep: list[str], rules: list[tuple] | None = None) -> DataFrame:
    """Points of a staggered lattice inside a polygon shrunk by half a metre.

    Rows of the lattice lie on multiples of the row spacing, every second one
    from the lowest row of the shrunk polygon is shifted.  Lattice rows are spread over tasks before the points of a row
    are made, so one huge polygon is not filled by a single task.  Thinning
    below 100 percent is by hash, so a rerun gives the same points.
    """
    spark = df.sparkSession
    dim = F.broadcast(spark.createDataFrame(rules or PLACING_RULES, "_rid int, _dx double, _dy double, _off double, _dens int"))
    src = df.filter((G.kind(geom) == "POLYGON") & F.col(rule).isNotNull()).join(dim, F.col(rule).cast("int") == F.col("_rid"))
    # exploded, so that what follows reads the box and does not work it out again
    src = src.withColumn("_b", F.explode(F.filter(F.array(inset_box(geom, INSET)), lambda b: b["xmin"].isNotNull())))
    row0 = F.floor(F.col("_b.ymin") / F.col("_dy"))
    rows = F.sequence(row0, F.greatest(row0, F.ceil(F.col("_b.ymax") / F.col("_dy")) - 1))
    src = src.withColumn("_row0", row0).withColumn("_r", F.explode(rows)).withColumn("_y", F.col("_r") * F.col("_dy"))
    shift = F.when((F.col("_r") - F.col("_row0")) % 2 == 1, F.col("_off")).otherwise(0.0)
    col0 = F.floor(F.col("_b.xmin") / F.col("_dx"))
    cols = F.sequence(col0, F.greatest(col0, F.ceil(F.col("_b.xmax") / F.col("_dx")) - 1))
    pts = (src.withColumn("_shift", shift).withColumn("_c", F.explode(cols))
           .withColumn("x", F.col("_c") * F.col("_dx") + F.col("_shift")).withColumn("y", F.col("_y")))
    x, y = F.col("x"), F.col("y")
    near = F.array_min(F.transform(G.edges(geom), lambda e: G.segment_distance(e, x, y)))
    inside = pts.filter(x.between(F.col("_b.xmin"), F.col("_b.xmax")) & y.between(F.col("_b.ymin"), F.col("_b.ymax"))
                        & G.covers_point(geom, x, y) & (near >= INSET))
    return thin(inside, [*keep, "_r", "_c"], F.col("_dens")).select(*keep, "x", "y")


def check_polygons(df: DataFrame, geom: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Valid or repaired rows, and a quarantine table with the originals and the reason."""
    tested = df.withColumn("_why", G.problem(geom))
    fixed = tested.withColumn("_fix", F.when(F.col("_why").isNull(), F.col(geom)).otherwise(G.repaired(geom)))
    left = F.when(F.col("_why").isNotNull(), G.problem("_fix"))
    good = fixed.filter(left.isNull()).withColumn(geom, F.col("_fix")).drop("_why", "_fix")
    quarantine = fixed.filter(F.col("_why").isNotNull()).select(
        *keep, F.col(geom), F.col("_why").alias("reason"), left.isNull().alias("repaired"))
    return good, quarantine
