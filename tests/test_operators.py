"""Operators on small hand-made inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landloom.functions import arrays as A, fractions as FR, geometry as G, text as T
from landloom.operators import areas, history as H, lookups, shares, skew, spatial
from landloom.sources import crs, deliveries


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_text_helpers(spark):
    r = one(spark, T.pad_number(F.lit(12345), 4), T.pad_number(F.lit(-7), 4), T.roman(F.lit(1994)), T.plain_number(F.lit(1.250)),
            T.truncate_dots(F.lit(" abcdefgh "), 6), T.append_line(F.lit(None).cast("string"), F.lit("b")), T.append_line(F.lit("a"), F.lit("b")),
            T.half_even_int(F.lit(2.5)), T.version_begin(F.lit("DESN00000000000120240101T000007Z")),
            T.code_to_key(F.lit("14000100212345___")))
    assert list(r) == ["####", "-0007", "MCMXCIV", "1.25", "abc...", "b", "a\nb", 2, "2024-01-01T00:00:07Z", "140001-002-12345/000"]


def test_array_concat_takes_null_as_empty(spark):
    r = one(spark, A.arr_cat(F.lit(None).cast("array<int>"), F.array(F.lit(1))), A.arr_cat(F.lit(None).cast("array<int>"), F.lit(None).cast("array<int>")))
    assert list(r) == [[1], None]


def test_fraction_sums(spark):
    from fractions import Fraction
    rng = random.Random(3)
    rows = [(k, rng.randint(1, 9), rng.choice([2, 3, 4, 6, 7, 12, 35])) for k in range(5) for _ in range(40)]
    df = spark.createDataFrame(rows, "k int, n int, d int")
    got = {r.k: r.anteil for r in FR.sum_fractions(df, ["k"], "n", "d", reduce=True).collect()}
    for k in range(5):
        want = sum(Fraction(n, d) for kk, n, d in rows if kk == k)
        assert got[k] == f"{want.numerator}/{want.denominator}"
    plain = {r.k: Fraction(r.anteil) for r in FR.sum_fractions(df, ["k"], "n", "d").collect()}
    assert plain == {k: Fraction(v) for k, v in got.items()}


def test_fractions_past_38_digits(spark):
    from fractions import Fraction
    primes = [p for p in range(1000003, 1002000, 2) if all(p % q for q in range(3, 1002, 2))]
    rows = [(1, 10 ** 37 + p, p) for p in primes] + [(1, None, 7), (2, -5, 3), (2, 10 ** 38 - 1, 3), (2, 10 ** 38 - 1, 3), (None, 1, 2), (None, 1, 2)]
    df = spark.createDataFrame([(k, None if n is None else str(n), str(d)) for k, n, d in rows], "k int, n string, d string")
    for reduce in (False, True):
        got = {r.k: r for r in FR.sum_fractions(df, ["k"], "n", "d", reduce=reduce).collect()}
        for k in (1, 2, None):
            want = sum(Fraction(1 if n is None else n, d) for kk, n, d in rows if kk == k)
            n, d = int(got[k].anteil_parts.n), int(got[k].anteil_parts.d)
            assert Fraction(n, d) == want and got[k].anteil == f"{n}/{d}"
            assert not reduce or (n, d) == (want.numerator, want.denominator)


@pytest.mark.parametrize("reduce", [False, True])
def test_many_denominators_add_up_in_rounds(spark, monkeypatch, reduce):
    from fractions import Fraction
    monkeypatch.setattr(FR, "FOLD", 10)
    rows = [(k, n, d) for k, many in ((1, 90), (None, 45), (2, 9), (3, 11)) for d in range(2, 2 + many) for n in (1, -d * 10 ** 20 - 3)]
    df = spark.createDataFrame([(k, str(n), str(d)) for k, n, d in rows], "k int, n string, d string")
    got = {r.k: (int(r.anteil_parts.n), int(r.anteil_parts.d)) for r in FR.sum_fractions(df, ["k"], "n", "d", reduce=reduce).collect()}
    want = {k: sum(Fraction(n, d) for kk, n, d in rows if kk == k) for k in (1, 2, 3, None)}
    assert {k: Fraction(*v) for k, v in got.items()} == want
    assert not reduce or got == {k: (v.numerator, v.denominator) for k, v in want.items()}


def test_walk_past_38_digits(spark):
    steps = [(f"b{i + 1}", f"b{i}", 99999998, 99999999) for i in range(8)]
    links = spark.createDataFrame(steps, "booking string, refers string, num int, den int")
    roots = spark.createDataFrame([("r", "b0", 99999998, 99999999)], "root string, booking string, num int, den int")
    got = {r.depth: (int(r.num), int(r.den)) for r in shares.walk(roots, links).collect()}
    assert got == {i: (99999998 ** (i + 1), 99999999 ** (i + 1)) for i in range(9)}
    held = spark.createDataFrame([(1, 1000.0, str(99999998 ** 60), str(99999999 ** 60)), (1, 10.0, None, "2"), (1, 5.0, "1", "0")], "k int, a double, n string, d string")
    assert abs(shares.weighted_area(held, ["k"], "a", "n", "d").first().area - (1000 * (99999998 / 99999999) ** 60 + 15)) < 1e-9


def test_salted_join_keeps_every_row(spark):
    big = spark.createDataFrame([(1 if i < 60 else i % 5, i) for i in range(100)], "k int, v int")
    other = spark.createDataFrame([(i, f"x{i}") for i in (0, 1, 1, 2)], "k int, w string")
    plain = sorted(map(tuple, big.join(other, "k").collect()))
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(tuple, big.join(other, ["k"], how).collect()), key=repr)
        got = sorted(map(tuple, skew.salted_join(big, other, ["k"], how, hot_rows=5).collect()), key=repr)
        assert got == want
    assert len(plain) == sum(2 if r.k == 1 else 1 for r in big.collect() if r.k in (0, 1, 2))


def test_walk_ends_on_cycles(spark):
    roots = spark.createDataFrame([("r", "a", 1, 2)], "root string, booking string, num int, den int")
    links = spark.createDataFrame([("b", "a", 1, 3), ("a", "b", 1, 5), ("c", "b", 1, 7)], "booking string, refers string, num int, den int")
    got = {(r.booking, int(r.den), r.depth) for r in shares.walk(roots, links, hot_rows=1).collect()}
    assert got == {("a", 2, 0), ("b", 6, 1), ("c", 42, 2)}


def test_global_number_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    rows = lookups.global_number(df, ["v"]).collect()
    assert sorted((r.v, r.rn) for r in rows) == [(i, i + 1) for i in range(1000)]


def test_overlap_counts_match_pairs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        b, e = rng.randint(0, 40), rng.choice([None, rng.randint(0, 40)])
        rows.append((f"id{i % 7}", i, f"{b:03d}", None if e is None else f"{e:03d}"))
    df = spark.createDataFrame(rows, "gml_id string, ogc_fid int, beginnt string, endet string")
    want = {}
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if a[0] == b[0] and a[3] and b[3] and a[2] < b[3] and a[3] > b[2]:
                want[a[0]] = want.get(a[0], 0) + 1
    assert {r.gml_id: r.pairs for r in H.overlapping(df).collect()} == want


def random_polygon(rng, x, y):
    """Star-shaped polygon, often not convex."""
    angles = sorted(rng.uniform(0, 2 * np.pi) for _ in range(rng.randint(4, 9)))
    return [(x + rng.uniform(2, 10) * np.cos(a), y + rng.uniform(2, 10) * np.sin(a)) for a in angles]


def inside(poly, px, py):
    hit = np.zeros(len(px), bool)
    for (x0, y0), (x1, y1) in zip(poly, poly[1:] + poly[:1]):
        with np.errstate(divide="ignore", invalid="ignore"):
            hit ^= ((y0 <= py) != (y1 <= py)) & (px < x0 + (py - y0) * (x1 - x0) / (y1 - y0))
    return hit


def test_overlay_of_any_polygons(spark):
    rng = random.Random(11)
    a = [random_polygon(rng, rng.uniform(0, 30), rng.uniform(0, 30)) for _ in range(12)]
    b = [random_polygon(rng, rng.uniform(0, 30), rng.uniform(0, 30)) for _ in range(12)]
    frame = lambda polys, i, g: spark.createDataFrame(
        [(k, ("POLYGON", 25832, [[(float(x), float(y)) for x, y in p + p[:1]]])) for k, p in enumerate(polys)], f"{i} int, {g} {G.GEOM}")
    got = {(r.i, r.j): r.common for r in spatial.overlay(frame(a, "i", "ga"), frame(b, "j", "gb"), "ga", "gb", 4.0, hot_rows=3).collect()}
    gx, gy = np.meshgrid(np.arange(-12, 45, 0.05) + 0.013, np.arange(-12, 45, 0.05) + 0.017)
    masks_a, masks_b = ([inside(p, gx.ravel(), gy.ravel()) for p in polys] for polys in (a, b))
    for i, ma in enumerate(masks_a):
        for j, mb in enumerate(masks_b):
            area = (ma & mb).sum() * 0.0025
            assert got.get((i, j), 0.0) == pytest.approx(area, abs=0.6)


def test_hole_is_not_area(spark):
    outer = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    hole = [(2.0, 2.0), (2.0, 4.0), (4.0, 4.0), (4.0, 2.0), (2.0, 2.0)]
    df = spark.createDataFrame([(("POLYGON", 25832, [outer, hole]),)], f"g {G.GEOM}")
    r = df.select(G.area("g"), G.intersection_area("g", G.rectangle(F.lit(1), F.lit(1), F.lit(5), F.lit(5))), G.covers_point("g", F.lit(3.0), F.lit(3.0)),
                  F.size(G.part_geoms("g"))).first()
    assert list(r) == [96.0, 12.0, False, 1]


def test_unequal_neighbours_share_a_border(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "fid int").withColumn("g", F.when(F.col("fid") == 1, G.rectangle(F.lit(0), F.lit(0), F.lit(10), F.lit(10))).when(
        F.col("fid") == 2, G.rectangle(F.lit(10), F.lit(0), F.lit(20), F.lit(4))).otherwise(G.rectangle(F.lit(10), F.lit(4), F.lit(20), F.lit(10))))
    s = spatial.shared_borders(df, "g", "fid", cell=8.0)
    got = {(r.a, r.b): r.l for r in s.groupBy("a", "b").agg(F.sum(G.dist(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))).alias("l")).collect()}
    assert got == {(1, 2): 4.0, (1, 3): 6.0, (2, 3): 10.0}


def test_dissolve_with_hole_and_split_edges(spark):
    cells = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    df = spark.createDataFrame(cells, "x int, y int").select(F.lit("k").alias("k"), G.rectangle(F.col("x") * 10, F.col("y") * 10, F.col("x") * 10 + 10, F.col("y") * 10 + 10).alias("g"))
    r = areas.dissolve(df, ["k"], "g").select(G.area("polygon").alias("a"), F.size("polygon.parts").alias("n")).first()
    assert (r.a, r.n) == (800.0, 2)


def test_zone_change_against_known_point(spark):
    # a point on the central meridian of zone 33 has easting 500000 there
    r = one(spark, crs.to_zone(G.point(F.lit(918078.6), F.lit(5675000.0)), F.lit("DENW0000000001"), 33)["parts"][0][0])[0]
    back = one(spark, crs.rezone(G.vertex(F.lit(float(r.x)), F.lit(float(r.y))), F.lit(33.0), 32))[0]
    assert back.x == pytest.approx(918078.6, abs=1e-4) and back.y == pytest.approx(5675000.0, abs=1e-4)
    mid = one(spark, crs.rezone(G.vertex(F.lit(500000.0), F.lit(5650000.0)), F.lit(33.0), 32))[0]
    mirrored = one(spark, crs.rezone(G.vertex(F.lit(500000.0), F.lit(5650000.0)), F.lit(32.0), 33))[0]
    assert mid.x - 500000 == pytest.approx(500000 - mirrored.x, abs=1e-6) and mid.y == pytest.approx(mirrored.y, abs=1e-6)
    assert 900000 < mid.x < 930000


def test_manifest_and_delivery_date(spark):
    lines = spark.createDataFrame([("# note",), ("",), ("a.xml.gz",), ("B.ZIP",), ("epsg 25833",)], "value string")
    assert [(r.kind, r.command) for r in deliveries.manifest(lines).collect()] == [("file", None), ("file", None), ("directive", "epsg")]
    late = "<a><geaenderteObjekte>x</geaenderteObjekte><AX_Portionskennung><datum>2024-05-06T07:08:09.5Z</datum></AX_Portionskennung></a>"
    assert one(spark, deliveries.delivery_date(F.lit(late)))[0] == "2024-05-06T07:08:09Z"
    frame = "<AX_Portionskennung><datum>2024-05-06T07:08:09Z</datum></AX_Portionskennung>"
    bulk = "<geaenderteObjekte><datum>1900-01-01T00:00:00Z</datum>aaa.xsd</geaenderteObjekte>"
    far = ["x" * 200_000 + frame + "x" * 9 + bulk, bulk + "x" * 200_000 + frame + "y" * 200_000, "x" * 200_000 + "aaa.xsd" + bulk, bulk]
    df = spark.createDataFrame([(i, t, t.encode()) for i, t in enumerate(far)], "i int, text string, content binary")
    assert [r[0] for r in df.orderBy("i").select(deliveries.delivery_date("text")).collect()] == ["2024-05-06T07:08:09Z"] * 2 + [None] * 2
    assert [r.i for r in deliveries.recognised(df).collect()] == [2]


def test_zip_members(spark, tmp_path):
    import zipfile
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("a.xml", "<m><id>007</id></m>")
        z.writestr("b.txt", "no")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    rows = deliveries.unzip(files).collect()
    assert [(r.name, r.text) for r in rows] == [("a.xml", "<m><id>007</id></m>")]


def test_gzip_members_keep_zeros_and_broken_ones(spark, tmp_path):
    import gzip
    from pyspark.sql import types as PT
    with gzip.open(tmp_path / "d.xml.gz", "wt") as f:
        f.write("<all><m><id>007</id></m><m><id>8</id></m></all>")
    schema = PT.StructType([PT.StructField("id", PT.StringType()), PT.StructField("_corrupt_record", PT.StringType())])
    got = deliveries.read_members(spark, [str(tmp_path)], "m", schema)
    assert sorted(r.id for r in got.collect()) == ["007", "8"]


def test_running_sum_over_a_hot_key(spark):
    rows = [("hot" if i % 10 else f"k{i % 30}", i, i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    got = {(r.k, r.o): r.s for r in lookups.running(df, ["k"], ["o"], F.col("v"), "s").collect()}
    sums = {}
    for k, o, v in rows:
        sums[k] = sums.get(k, 0) + v
        assert got[(k, o)] == sums[k]


def test_stream_batches_follow_each_other(spark, tmp_path):
    from landloom.streaming import changes as S
    root = str(tmp_path / "table")
    versions = spark.createDataFrame([("DESN000000000001", "2020-01-01T00:00:00Z", None, ["A"]), ("DESN000000000001", "2021-01-01T00:00:00Z", None, ["A"])],
                                     "gml_id string, beginnt string, endet string, anlass array<string>")
    S.start_snapshot(versions, root)
    schema = "seq long, typename string, featureid string, context string, safetoignore string, replacedby string, anlass array<string>, endet string"
    for i in (1, 2):
        # each batch closes the oldest version still open
        spark.createDataFrame([(i, "t", "DESN000000000001", "update", None, None, [f"R{i}"], f"202{i + 4}-01-01T00:00:00Z")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        S.apply_stream(stream, root, "2030-01-01T00:00:00Z").awaitTermination()
    got = sorted(map(tuple, S.snapshot(spark, root).select("beginnt", "endet", F.array_join("anlass", ",")).collect()))
    assert got == [("2020-01-01T00:00:00Z", "2025-01-01T00:00:00Z", "A,R1"), ("2021-01-01T00:00:00Z", "2026-01-01T00:00:00Z", "A,R2")]
    S.compact(spark, root, str(tmp_path / "new"))
    assert S.snapshot(spark, str(tmp_path / "new")).count() == 2


def test_layers_of_mixed_objects(spark):
    from landloom.plans import rules
    none = lambda t: F.lit(None).cast(t)
    base = lambda geom, **kw: spark.range(1).select(
        F.lit("DESN1").alias("gml_id"), none("string").alias("endet"), geom.alias("wkb_geometry"), F.array(F.lit("M")).alias("advstandardmodell"),
        none("array<string>").alias("sonstigesmodell"), *[v.alias(k) for k, v in kw.items()])
    square = G.rectangle(F.lit(0), F.lit(0), F.lit(10), F.lit(10))
    tables = {
        "ax_gebaeude": base(square, gebaeudefunktion=F.lit(2030), hochhaus=F.lit("true"), zustand=none("int"), lagezurerdoberflaeche=none("int"), bauweise=none("int")),
        "ax_fliessgewaesser": base(square, zustand=F.lit(4000), funktion=F.lit(8300)),
        "ax_leitung": base(G.line(F.array(G.vertex(0, 0), G.vertex(4, 0))), bauwerksfunktion=F.lit(1111)),
        "ax_einrichtungenfuerdenschiffsverkehr": base(G.point(F.lit(3.0), F.lit(4.0)), art=F.lit(1440), kilometerangabe=F.lit("12,5"), name=none("string")),
    }
    look = dict(art=none("string"), signaturnummer=none("string"), drehwinkel=none("double"), horizontaleausrichtung=none("string"), vertikaleausrichtung=none("string"),
                skalierung=none("double"), fontsperrung=none("int"), schriftinhalt=none("string"), positionierungsregel=none("string"),
                dientzurdarstellungvon=none("array<string>"))
    empty = base(square, **look).limit(0)
    tables |= {"ap_ppo": empty, "ap_pto": empty, "ap_darstellung": empty}
    enums = spark.createDataFrame([], "domain string, code string, label string")
    catalogue = spark.createDataFrame([], "katalogschluessel string, bezeichnung string, beginnt string")
    out = rules.derive(tables, enums, catalogue)
    styles = lambda layer: sorted((r.layer, r.signaturnummer) for r in out[layer].collect())
    assert styles("po_polygons") == [("ax_fliessgewaesser", "2519"), ("ax_gebaeude", "26231304")]
    assert styles("po_lines") == [("ax_leitung", "2523")]
    assert styles("po_points") == [("ax_einrichtungenfuerdenschiffsverkehr", "3583"), ("ax_fliessgewaesser", "3490"), ("ax_gebaeude", "3300")]
    assert sorted(r.text for r in out["po_labels"].collect()) == ["12,5", "Erdkabel"]


def test_symbols_fill_an_area_by_placing_rule(spark):
    from landloom.plans import rules
    none = lambda t: F.lit(None).cast(t)
    wood = spark.range(1).select(F.lit("DESN1").alias("gml_id"), none("string").alias("endet"), none("int").alias("vegetationsmerkmal"),
                                 G.rectangle(F.lit(0), F.lit(0), F.lit(30), F.lit(30)).alias("wkb_geometry"), F.array(F.lit("M")).alias("advstandardmodell"))
    rule = spark.range(1).select(F.array(F.lit("DESN1")).alias("dientzurdarstellungvon"), F.lit("VEG").alias("art"), none("string").alias("signaturnummer"),
                                 F.lit("1100").alias("positionierungsregel"), none("string").alias("endet"), none("double").alias("drehwinkel"),
                                 none(G.GEOM).alias("wkb_geometry"))
    out = rules.symbols(rules.unified({"ax_wald": wood}), rules.placed_links(rule.limit(0)), rules.placed_links(rule))
    got = [(r.signaturnummer, r.x, r.y) for r in out.select("signaturnummer", F.col("point")["parts"][0][0]["x"].alias("x"), F.col("point")["parts"][0][0]["y"].alias("y")).collect()]
    want = {(7.0 * c + (3.5 if r % 2 else 0.0), 3.5 * r) for r in range(9) for c in range(5)}
    want = {(x, y) for x, y in want if 0.5 <= x <= 29.5 and 0.5 <= y <= 29.5}
    assert {s for s, _, _ in got} == {"3456"} and {(x, y) for _, x, y in got} == want


def test_rule_data_by_code(spark):
    """Styles for all states and functions of a type, not only the special ones."""
    from landloom.plans import rules, ruleset
    cases = [("ax_strassenverkehr", {"funktion": "5220"}, "25150000"), ("ax_strassenverkehr", {"zustand": "4000", "funktion": "5130"}, "25160000"),
             ("ax_strassenverkehr", {"funktion": "2313"}, "25151406"), ("ax_strassenverkehr", {}, "25150000"),
             ("ax_bahnverkehr", {"zustand": "4000"}, "25160000"), ("ax_bahnverkehr", {"funktion": "2322"}, "25151406"), ("ax_bahnverkehr", {}, "25150000"),
             ("ax_unlandvegetationsloseflaeche", {"funktion": "1300"}, None), ("ax_unlandvegetationsloseflaeche", {"funktion": "1110"}, "25151406"),
             ("ax_unlandvegetationsloseflaeche", {}, "2515")]
    symbols = [("ax_fliessgewaesser", "FKT", {"funktion": "8300"}, None), ("ax_fliessgewaesser", "FKT", {"funktion": "8300", "zustand": "4000"}, "3490"),
               ("ax_fliessgewaesser", "Fließpfeil", {"zustand": "4000"}, None), ("ax_fliessgewaesser", "Fließpfeil", {}, "3488"),
               ("ax_wasserspiegelhoehe", "SYMBOL", {}, None), ("ax_wasserspiegelhoehe", "SYMBOL", {"hoehedeswasserspiegels": "12.5"}, "3623")]
    rows = [(rules._choices(ruleset.FILLS[s]), a, w) for s, a, w in cases] + [(rules._choices(ruleset.SYMBOLS[s, t]), a, w) for s, t, a, w in symbols]
    df = spark.createDataFrame(rows, f"choices {rules.CHOICE}, attrs map<string,string>, want string")
    for r in df.withColumn("got", rules.chosen("choices", "attrs")).collect():
        assert r.got == r.want, r


def square(x0, y0, x1, y1):
    return G.rectangle(*[F.lit(float(v)) for v in (x0, y0, x1, y1)])


def test_dissolve_splits_at_unmatched_vertices(spark):
    """A square beside two halves is one part, though the square has no vertex where the halves meet."""
    from landloom.operators import areas
    base = spark.range(1)
    df = (base.select(F.lit("k").alias("k"), square(0, 0, 10, 10).alias("g")).union(base.select(F.lit("k"), square(10, 0, 20, 5)))
          .union(base.select(F.lit("k"), square(10, 5, 20, 10))))
    r = areas.dissolve(df, ["k"], "g", "p").select(F.size(F.col("p")["parts"]).alias("n"), G.area("p").alias("a")).first()
    assert (r.n, round(r.a, 6)) == (1, 200.0)


def test_nearest_ends_on_missing_geometries(spark):
    from landloom.operators import placement
    base = spark.range(1)
    left = (base.select(F.lit(1).alias("id"), F.lit("a").alias("k"), square(0, 0, 1, 1).alias("g")).union(base.select(F.lit(2), F.lit("a"), F.lit(None)))
            .union(base.select(F.lit(3), F.lit("b"), square(0, 0, 1, 1))))
    right = (base.select(F.lit("a").alias("rk"), F.lit(7).alias("rid"), square(500, 0, 501, 1).alias("rg")).union(base.select(F.lit("a"), F.lit(8), F.lit(None)))
             .union(base.select(F.lit("b"), F.lit(9), F.lit(None))))
    got = placement.nearest(left, right, "id", "g", "rg", [("k", "rk")], ["rid"]).select("id", "rid", "distance").collect()
    assert [(r.id, r.rid, round(r.distance, 6)) for r in got] == [(1, 7, 499.0)]


def plain_clip(p, d, ln):
    """Teeth of one edge, longest first, each cut at the nearest tooth that still crosses it."""
    ln = list(ln)
    for i in sorted(range(len(ln)), key=lambda j: -ln[j]):
        best = ln[i]
        for j in range(len(ln)):
            cross = d[i][0] * d[j][1] - d[i][1] * d[j][0]
            if j == i or abs(cross) <= 1e-12:
                continue
            rx, ry = p[j][0] - p[i][0], p[j][1] - p[i][1]
            t, u = (rx * d[j][1] - ry * d[j][0]) / cross, (rx * d[i][1] - ry * d[i][0]) / cross
            if 0.01 < t <= ln[i] and 0 <= u <= ln[j]:
                best = min(best, t)
        ln[i] = best
    return ln


def test_teeth_of_many_edges_are_clipped_together():
    """Edges come many to a batch, also cut by its end; before, each was a call of its own."""
    import pandas as pd
    from landloom.operators import placement
    rng = np.random.default_rng(4)
    rows, want = [], []
    for edge in range(60):
        n = int(rng.choice([1, 2, 5, 9, 9, 80]))
        a = rng.uniform(0, 2 * np.pi, n) if edge % 3 else np.full(n, 1.0)
        p, d, ln = np.c_[np.arange(n) * 6.0, rng.uniform(0, 1, n)], np.c_[np.cos(a), np.sin(a)], rng.choice([3.0, 10.0, 40.0], n)
        rows += [(edge // 2, edge, i * 6.0, *p[i], *d[i], ln[i]) for i in range(n)]
        want += plain_clip(p, d, ln)
    df = pd.DataFrame(rows, columns=["slope", "upper", "o", "x", "y", "nx", "ny", "len"])
    assert (df["len"].to_numpy() != np.array(want)).any()
    for size in (7, 100, len(df)):
        calls = list(placement._clip_batches((df.iloc[i:i + size] for i in range(0, len(df), size)), ["slope", "upper"]))
        got = pd.concat(calls)
        assert got[["slope", "upper", "o"]].to_numpy().tolist() == df[["slope", "upper", "o"]].to_numpy().tolist()
        assert np.array_equal(got["len"].to_numpy(), np.array(want))
        assert len(calls) <= -(-len(df) // size) + 1


def test_edges_at_hand_or_on_the_grid_cut_the_same_teeth(spark, monkeypatch):
    from landloom.operators import placement
    up = [(0.0, 0.0), (25.0, 3.0), (40.0, -4.0), (61.0, 0.0)]
    low = [(0.0, -20.0), (10.0, -12.0), (30.0, -26.0), (61.0, -18.0)]
    rows = [(s, art, [(x + 7 * s, y * (1 + s / 10)) for x, y in line]) for s in range(6) for art, line in ((1220, up), (1230, low), (1230, low[:2]))]
    edges = spark.createDataFrame(rows, "slope int, art int, part array<struct<x:double,y:double>>")
    teeth = lambda: sorted(tuple(r) for r in placement.slope_teeth(edges).collect())
    near = teeth()
    monkeypatch.setattr(placement, "EDGES_AT_HAND", 0)
    assert len(near) > 80 and teeth() == near


def test_ownership_walks_each_booking_once(spark, monkeypatch):
    """Parcels share bookings, keys hold several parcels (one key is missing); numbers run on across sheets' lists."""
    from fractions import Fraction
    from landloom.checks import q_register
    from landloom.checks.fixtures import Data
    from landloom.plans import register as R
    p = q_register.parcels(Data(spark, "/root/testdata/sf0.001")).filter("psize < 30")
    p = p.withColumn("istgebucht", F.concat(F.lit("K"), (F.col("ogc_fid") % 7).cast("string")))
    p = p.unionByName(p.filter("psize % 3 = 0").withColumn("istgebucht", F.lit("K1"))).withColumn(
        "gemarkungsnummer", F.when(F.col("psize") != 7, F.col("gemarkungsnummer")))
    rng = random.Random(8)
    # K0..K5 belong to parcels (K6 is no booking), the others hang below one or two of those before them
    rows = [(f"K{i}", f"S{rng.randrange(5)}", None if i < 6 else [f"K{rng.randrange(i)}" for _ in range(rng.choice([1, 2]))], rng.randint(1, 3),
             rng.randint(2, 7), rng.choice([1, 2, None]), rng.choice(["1", "2", "10", None]), None) for i in range(30) if i != 6]
    bookings = spark.createDataFrame(rows, "gml_id string, istbestandteilvon string, an array<string>, zaehler int, nenner int, buchungsart int, "
                                           "laufendenummer string, endet string")
    sheets = spark.createDataFrame([(f"S{i}", "14", str(10 + i), str(i), "5000" if i == 4 else "1000", None) for i in range(5)],
                                   "gml_id string, land string, bezirk string, buchungsblattnummermitbuchstabenerweiterung string, blattart string, endet string")
    roots = []
    walk = shares.walk
    monkeypatch.setattr(shares, "walk", lambda r, *a, **k: roots.append(r.count()) or walk(r, *a, **k))
    monkeypatch.setattr(R, "COUNT_TOGETHER", 3)
    out = R.ownership(p, bookings, sheets, reduce=True)
    got = sorted(map(tuple, out.select("flsnr", "bestdnr", "b", "auftlnr", "zaehler", "nenner", "bvnr").collect()), key=repr)
    assert roots == [6]
    assert "Window" not in out.select("flsnr", "bestdnr", "anteil")._jdf.queryExecution().optimizedPlan().toString()

    place = {r.istbestandteilvon: r for r in R.open_sheets(sheets).collect()}
    want = {}

    def visit(key, row, share, path):
        at = place[row[1]]
        if at.blattart != "5000":
            k = (key, at.bestdnr, row[5], row[6])
            want[k] = want.get(k, 0) + share
        for nxt in rows:
            if nxt[2] and row[0] in nxt[2] and nxt[0] not in path:
                visit(key, nxt, share * Fraction(nxt[3], nxt[4]), [*path, nxt[0]])

    for r in R.with_keys(p).collect():
        for row in rows:
            if row[0] == r.istgebucht:
                visit(r.flsnr, row, Fraction(row[3], row[4]), [row[0]])
    first = lambda v: (v is not None, v if v is not None else 0)
    listed = []
    for sheet in {k[1] for k in want}:
        mine = sorted((k for k in want if k[1] == sheet), key=lambda k: (k[3] is not None, k[3] or "", k[0] is not None, k[0] or "", first(k[2])))
        listed += [(*k, str(want[k].numerator), str(want[k].denominator), f"{i + 1:04d}") for i, k in enumerate(mine)]
    assert any(k[0] is None for k in want) and got == sorted(listed, key=repr)


def test_nearest_meets_few_of_a_crowd(spark, monkeypatch):
    """Rows far closer than the first window, several at one spot; before, every left row met all of them."""
    from landloom.operators import placement
    rng = random.Random(6)
    spots = [(i, rng.choice("ab"), *rng.choice([(rng.uniform(0, 9), rng.uniform(0, 9)), (3.0, 3.0), (900.0, 4000.0)])) for i in range(400)]
    seek = [(i, rng.choice("ab"), rng.uniform(-2, 11), rng.uniform(-2, 11)) for i in range(150)] + [(150, "a", 3.0, 3.0), (151, "b", -5000.0, 70.0)]
    right = spark.createDataFrame(spots, "rid int, rk string, x double, y double").select("rid", "rk", G.point("x", "y").alias("rg"))
    left = spark.createDataFrame(seek, "id int, k string, x double, y double").select("id", "k", G.point("x", "y").alias("g"))
    met = []
    join = placement.grid_join
    monkeypatch.setattr(placement, "grid_join", lambda *a, **kw: met.append(j := join(*a, **kw).localCheckpoint()) or j)
    got = {r.id: (r.rid, r.distance) for r in placement.nearest(left, right, "id", "g", "rg", [("k", "rk")], ["rid"], start=512.0).collect()}
    for i, k, x, y in seek:
        d, rid = min((float(np.sqrt((q - x) * (q - x) + (v - y) * (v - y))), r) for r, m, q, v in spots if m == k)
        assert got[i] == (rid, d)
    assert sum(j.count() for j in met) < 152 * 400 / 5


def test_parcels_inside_areas_meet_on_the_grid(spark):
    """The pairs are those of the plain condition, without comparing every parcel with every area."""
    from landloom.checks import q_geometry
    from landloom.checks.fixtures import Data
    d = Data(spark, "/root/testdata/sf0.001")
    got = q_geometry.pair_full(d)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the one row of grid levels is joined without a condition
    assert not [line for line in plan.splitlines() if ("NestedLoop" in line or "Cartesian" in line) and "x0" in line]
    want = d.sql("SELECT pid, uid FROM parcel p JOIN usearea u ON p.x0 >= u.x0 AND p.x1 <= u.x1 AND p.y0 >= u.y0 AND p.y1 <= u.y1")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
