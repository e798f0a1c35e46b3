"""Polygons shrunk by a distance, held against plain distances."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landloom.functions import geometry as G
from landloom.operators import areas, placement


def shapes():
    """(name, rings): outer rings and holes in either direction."""
    rng = np.random.default_rng(5)
    turn = lambda pts, a, dx, dy: [(dx + x * math.cos(a) - y * math.sin(a), dy + x * math.sin(a) + y * math.cos(a)) for x, y in pts]
    bay = [(0, 0), (20, 0), (20, 12), (12, 12), (12, 13.5), (9, 13.5), (9, 12), (0, 12)]
    out = {"square": [[(0, 0), (10, 0), (10, 10), (0, 10)]],
           "bay": [bay], "bay clockwise": [bay[::-1]], "bay turned": [turn(bay, 0.7, 3.5e6, 5.9e6)],
           "notch": [[(0, 0), (20, 0), (20, 12), (11, 12), (11, 7), (9, 7), (9, 12), (0, 12)]],
           "thin wing": [[(0, 0), (10, 0), (10, 4), (22, 4), (22, 6.5), (10, 6.5), (10, 10), (0, 10)]],
           "waist": [[(0, 0), (10, 0), (10, 4), (14, 4), (14, 0), (24, 0), (24, 10), (14, 10), (14, 6.5), (10, 6.5), (10, 10), (0, 10)]],
           "slanted": [[(0, 0), (18, 3), (14, 15), (-3, 9)]],
           "court": [[(0, 0), (30, 0), (30, 30), (0, 30)], [(12, 12), (18, 12), (18, 18), (12, 18)]],
           "court near a wall": [[(0, 0), (30, 0), (30, 30), (0, 30)], [(3, 12), (9, 12), (9, 18), (3, 18)]],
           "spikes": [[(0, 0), (9, 0), (10, 4.6), (11, 0), (20, 0), (20, 20), (11, 20), (10, 7.8), (9, 20), (0, 20)]],
           "nothing": [[(0, 0), (10, 0), (10, 3), (0, 3)]],
           "collinear": [[(0, 0), (5, 0), (5, 0), (10, 0), (10, 10), (0, 10), (0, 4)]]}
    for i in range(6):
        a = np.sort(rng.uniform(0, 2 * math.pi, 14))
        r = rng.uniform(4, 14, 14)
        out[f"star {i}"] = [[(float(q * math.cos(t)), float(q * math.sin(t))) for t, q in zip(a, r)]]
    return out


def edge_list(rings):
    return np.array([(*p, *q) for ring in rings for p, q in zip(ring, ring[1:] + ring[:1]) if p != q])


def clearance(edges, x, y):
    a, d = edges[:, :2], edges[:, 2:] - edges[:, :2]
    t = np.clip((((x, y) - a) * d).sum(1) / (d * d).sum(1), 0, 1)
    return float(np.hypot(*(a + t[:, None] * d - (x, y)).T).min())


def inside(edges, x, y):
    n = 0
    for x0, y0, x1, y1 in edges:
        if (y0 <= y) != (y1 <= y) and x0 + (y - y0) * (x1 - x0) / (y1 - y0) > x:
            n += 1
    return n % 2 == 1


@pytest.fixture(scope="module")
def inset_rows(spark):
    rows = [(name, ("POLYGON", 25832, [[*ring, ring[0]] for ring in rings])) for name, rings in shapes().items()]
    rows += [("none", None), ("empty", ("POLYGON", 25832, [])), ("a line", ("LINESTRING", 25832, [[(0.0, 0.0), (9.0, 0.0)]]))]
    plain = [(n, g if g is None else (g[0], g[1], [[(float(x), float(y)) for x, y in p] for p in g[2]])) for n, g in rows]
    df = spark.createDataFrame(plain, f"name string, geom {G.GEOM}")
    out = df.select("name", G.inset_edges("geom", 1.9).alias("e"), G.inset_corners("geom", 1.9).alias("c"),
                    areas.inset_box("geom", 1.9).alias("b"), G.inset_outer_parts("geom", 1.9).alias("o"))
    return {r["name"]: r for r in out.collect()}


def test_pieces_are_what_is_clear(inset_rows):
    """A point of a moved edge is kept just where nothing else is nearer, and it is inside."""
    for name, rings in shapes().items():
        edges = edge_list(rings)
        area = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(rings[0], rings[0][1:] + rings[0][:1]))
        kept = [(e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]) for e in inset_rows[name]["e"]]
        for x0, y0, x1, y1 in edges[:len(edge_list(rings[:1]))]:
            ln = math.hypot(x1 - x0, y1 - y0)
            s = 1 if area > 0 else -1
            nx, ny = -(y1 - y0) / ln * s, (x1 - x0) / ln * s
            for t in np.linspace(0.003, 0.997, 90):
                x, y = x0 + t * (x1 - x0) + 1.9 * nx, y0 + t * (y1 - y0) + 1.9 * ny
                c = clearance(edges, x, y)
                on = any(clearance(np.array([k]), x, y) < 1e-6 for k in kept)
                if c > 1.9 - 1e-6 and inside(edges, x, y):
                    assert on, (name, x, y, c)
                elif c < 1.9 - 1e-4:
                    assert not on, (name, x, y, c)
        for k in kept:
            assert inside(edges, (k[0] + k[2]) / 2, (k[1] + k[3]) / 2), name


def test_box_of_what_is_left(inset_rows):
    """The box holds every clear point of a fine lattice and reaches no further than one step."""
    for name, rings in shapes().items():
        edges = edge_list(rings)
        lo, hi = edges[:, :2].min(0), edges[:, :2].max(0)
        pts = [(x, y) for x in np.arange(lo[0], hi[0], 0.23) for y in np.arange(lo[1], hi[1], 0.23)]
        clear = np.array([p for p in pts if clearance(edges, *p) >= 1.9 and inside(edges, *p)])
        b = inset_rows[name]["b"]
        if not len(clear):
            assert b["xmin"] is None or b["xmax"] - b["xmin"] < 0.6 or b["ymax"] - b["ymin"] < 0.6, name
            continue
        box = np.array([b["xmin"], b["ymin"], b["xmax"], b["ymax"]])
        near = np.array([*clear.min(0), *clear.max(0)])
        assert (box[:2] <= near[:2] + 1e-6).all() and (box[2:] >= near[2:] - 1e-6).all(), name
        # corners are sharp, so a lattice may miss their tips by some steps
        assert np.abs(box - near).max() < 2.0, (name, box, near)


def test_odd_geometries(inset_rows):
    assert inset_rows["none"]["e"] is None and inset_rows["a line"]["e"] is None
    assert inset_rows["empty"]["e"] == [] and inset_rows["nothing"]["e"] == []
    assert inset_rows["nothing"]["b"]["xmin"] is None
    b = inset_rows["square"]["b"]
    assert (b["xmin"], b["ymin"], b["xmax"], b["ymax"]) == (1.9, 1.9, 8.1, 8.1)


def test_outer_rings(inset_rows):
    assert inset_rows["court"]["o"] == [0]
    assert inset_rows["court near a wall"]["o"] == [0, 1]
    # the grown court leaves four walls around it, which no number faces
    assert {e["part"] for e in inset_rows["court"]["e"]} == {0, 1}


def test_numbers_of_unfriendly_houses(spark):
    names = ["bay", "notch", "thin wing", "waist", "slanted", "court", "nothing"]
    houses = spark.createDataFrame([(n, "k", ("POLYGON", 25832, [[(float(x), float(y)) for x, y in [*r, r[0]]] for r in shapes()[n]]))
                                    for n in names], f"hid string, hkey string, geom {G.GEOM}")
    streets = spark.createDataFrame([(1, "k", -50.0, 40.0, 80.0, 50.0)], "sid int, skey string, x0 double, y0 double, x1 double, y1 double")
    streets = streets.select("sid", "skey", G.rectangle("x0", "y0", "x1", "y1").alias("sgeom"))
    out = {r["hid"]: r for r in placement.house_number_places(houses, streets, "hid", "geom", "hkey", "sgeom", "skey", "sid").collect()}
    assert set(out) == set(names) - {"nothing"}
    # the longer wall beside the bay: from the left inset wall to the inward corner at 9
    assert (round(out["bay"]["x"], 6), round(out["bay"]["y"], 6)) == (round((1.9 + 9) / 2, 6), 10.1)
    assert (round(out["court"]["x"], 6), round(out["court"]["y"], 6)) == (15.0, 28.1)
    for n in names[:-1]:
        assert round(clearance(edge_list(shapes()[n]), out[n]["x"], out[n]["y"]), 5) == 1.9
