"""Presentation rules on object tables derived from parts and line items."""

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..plans import hierarchy, postpass, rules
from .registry import query

# Object tables from parts: four types by key, codes by size.
FIELDS = """'DESN' || lpad(CAST(p_partkey AS STRING), 12, '0') AS gml_id, CAST(NULL AS STRING) AS endet"""
VEG = "CASE p_size % 6 WHEN 1 THEN 1010 WHEN 2 THEN 1011 WHEN 3 THEN 1020 WHEN 4 THEN 1200 WHEN 5 THEN 1013 END"
FKT = "CASE p_size % 4 WHEN 0 THEN 5220 WHEN 1 THEN 5240 WHEN 2 THEN 5250 END"
ZUS = "CASE WHEN p_size % 3 = 0 THEN 4000 END"


def tables(d):
    geo = lambda df: df.withColumn("wkb_geometry", G.rectangle("x0", "y0", "x1", "y1")).withColumn(
        "advstandardmodell", F.array(F.lit("DLKM"))).withColumn("sonstigesmodell", F.lit(None).cast("array<string>"))
    xy = "CAST(10 * (p_partkey % 100) AS DOUBLE) AS x0, CAST(10 * idiv(p_partkey, 100) AS DOUBLE) AS y0, CAST(10 * (p_partkey % 100) + 10 AS DOUBLE) AS x1, CAST(10 * idiv(p_partkey, 100) + 10 AS DOUBLE) AS y1"
    base = lambda i, extra: geo(d.split(d.sql(f"SELECT {FIELDS}, {xy}, {extra} FROM part WHERE p_partkey % 4 = {i}")))
    return {
        "ax_landwirtschaft": base(0, f"{VEG} AS vegetationsmerkmal, CASE WHEN p_size > 20 THEN p_name END AS name"),
        "ax_weg": base(1, f"{FKT} AS funktion"),
        "ax_halde": base(2, "p_size AS lagergut, CASE WHEN p_size > 30 THEN p_name END AS name"),
        "ax_flugverkehr": base(3, f"{ZUS} AS zustand, CASE p_size % 3 WHEN 0 THEN 5530 WHEN 1 THEN 5550 END AS funktion, "
                               "CASE WHEN p_size > 40 THEN p_name END AS unverschluesselt, '14' AS land, '5' AS regierungsbezirk, "
                               "'11' AS kreis, '000' AS gemeinde, lpad(CAST(p_size AS STRING), 5, '0') AS lage"),
    }


PTO = """SELECT CAST(l_partkey AS BIGINT) AS pk, CASE l_linenumber WHEN 1 THEN 'NAM' WHEN 2 THEN 'Halde_LGT' WHEN 3 THEN 'VEG' WHEN 4 THEN 'FKT' ELSE 'ART' END AS art,
 min(l_linestatus) AS txt, CASE WHEN min(l_quantity) > 2 THEN CAST(3000 + min(l_linenumber) * 100 AS STRING) END AS style
 FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2"""
OVR = """SELECT CAST(l_partkey AS BIGINT) AS pk, CASE l_linenumber WHEN 1 THEN 'NAM' WHEN 2 THEN 'Halde_LGT' WHEN 3 THEN 'VEG' WHEN 4 THEN 'FKT' ELSE 'ART' END AS art,
 CAST(5000 + min(l_linenumber) * 100 AS STRING) AS style FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2"""


def placed(d):
    p = d.sql(PTO)
    ids = F.array(F.concat(F.lit("DESN"), F.lpad(F.col("pk").cast("string"), 12, "0")))
    none = lambda t: F.lit(None).cast(t)
    return p.select(
        "art", F.col("txt").alias("schriftinhalt"), F.col("style").alias("signaturnummer"), F.lit(0.5).alias("drehwinkel"),
        F.lit("zentrisch").alias("horizontaleausrichtung"), none("string").alias("vertikaleausrichtung"), none("double").alias("skalierung"),
        none("int").alias("fontsperrung"), G.point(F.col("pk").cast("double"), F.lit(7.0)).alias("wkb_geometry"), none("string").alias("endet"),
        F.array(F.lit("P")).alias("advstandardmodell"), none("array<string>").alias("sonstigesmodell"), ids.alias("dientzurdarstellungvon"))


def overrides(d):
    o = d.sql(OVR)
    ids = F.array(F.concat(F.lit("DESN"), F.lpad(F.col("pk").cast("string"), 12, "0")))
    return o.select("art", F.col("style").alias("signaturnummer"), F.lit(None).cast("string").alias("positionierungsregel"),
                    F.lit(None).cast("string").alias("endet"), F.array(F.lit("D")).alias("advstandardmodell"),
                    F.lit(None).cast("array<string>").alias("sonstigesmodell"), ids.alias("dientzurdarstellungvon"))


def enums(d):
    return d.sql("SELECT 'ax_lagergut_halde' AS domain, CAST(n_nationkey AS STRING) AS code, n_name AS label FROM nation")


def catalogue(d):
    return d.sql("""SELECT '14511000' || lpad(CAST(s_nationkey AS STRING), 5, '0') AS katalogschluessel, s_name AS bezeichnung,
                    lpad(CAST(s_suppkey AS STRING), 8, '0') AS beginnt FROM supplier""")


FILL_SQL = f"""
SELECT gml_id, layer, style FROM (SELECT {FIELDS},
  CASE p_partkey % 4 WHEN 0 THEN 'ax_landwirtschaft' WHEN 1 THEN 'ax_weg' WHEN 2 THEN 'ax_halde' ELSE 'ax_flugverkehr' END AS layer,
  CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_size % 6 IN (0, 1, 2, 5) THEN '25151409' WHEN p_size % 6 = 3 THEN '25151406' ELSE '25151404' END
    WHEN 1 THEN '2515' WHEN 2 THEN '25151403' ELSE CASE WHEN p_size % 3 = 0 THEN '2516' ELSE '25151406' END END AS style FROM part) t"""


@query("f01_area_rule", FILL_SQL)
def _(d):
    return rules.fills(rules.unified(tables(d))).select("gml_id", "layer", F.col("signaturnummer").alias("style"))


@query("f03_symbol_rule", f"""
WITH o AS (SELECT p_partkey AS pk, {FIELDS}, CASE p_partkey % 4 WHEN 0 THEN 'VEG' WHEN 1 THEN 'FKT' ELSE 'ART' END AS art,
  CASE p_partkey % 4 WHEN 0 THEN CASE p_size % 6 WHEN 2 THEN '3440' WHEN 3 THEN '3413' WHEN 5 THEN '3444' END
    WHEN 1 THEN CASE p_size % 4 WHEN 0 THEN '3424' WHEN 1 THEN '3426' WHEN 2 THEN '3428' END
    ELSE CASE p_size % 3 WHEN 0 THEN '3438' WHEN 1 THEN '3439' END END AS rule FROM part WHERE p_partkey % 4 <> 2),
p AS ({PTO}), d AS ({OVR})
SELECT o.gml_id, coalesce(d.style, p.style, o.rule) AS style, CASE WHEN p.pk IS NOT NULL THEN 7.0 ELSE 10 * (o.pk // 100) + 5.0 END::DOUBLE AS y
FROM o LEFT JOIN p ON p.pk = o.pk AND p.art = o.art LEFT JOIN d ON d.pk = o.pk AND d.art = o.art WHERE coalesce(d.style, p.style, o.rule) IS NOT NULL""")
def _(d):
    out = rules.symbols(rules.unified(tables(d)), rules.placed_links(placed(d)), rules.placed_links(overrides(d)).withColumn(
        "positionierungsregel", F.lit(None).cast("string")))
    return out.select("gml_id", F.col("signaturnummer").alias("style"), F.col("point")["parts"][0][0]["y"].alias("y"))


LABEL_SQL = f"""
WITH o AS (SELECT p_partkey AS pk, p_size AS sz, {FIELDS}, CASE p_partkey % 4 WHEN 0 THEN 'ax_landwirtschaft' WHEN 2 THEN 'ax_halde' ELSE 'ax_flugverkehr' END AS layer,
   'NAM' AS art, CASE p_partkey % 4 WHEN 0 THEN '4208' WHEN 2 THEN '4141' ELSE '4200' END AS rule,
   CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_size > 20 THEN p_name END WHEN 2 THEN CASE WHEN p_size > 30 THEN p_name END
     ELSE CASE WHEN p_size > 40 THEN p_name END END AS own FROM part WHERE p_partkey % 4 <> 1
 UNION ALL SELECT p_partkey, p_size, {FIELDS}, 'ax_halde', 'Halde_LGT', '4140',
   coalesce('Halde' || chr(10) || '(' || (SELECT n_name FROM nation WHERE n_nationkey = p_size) || ')', 'Halde') FROM part WHERE p_partkey % 4 = 2),
p AS ({PTO}), d AS ({OVR}),
k AS (SELECT s_nationkey AS lage, arg_max(s_name, s_suppkey) AS nm FROM supplier GROUP BY s_nationkey)
SELECT o.gml_id, o.layer, coalesce(p.txt, o.own, k.nm) AS txt, coalesce(d.style, p.style, o.rule) AS style
FROM o LEFT JOIN p ON p.pk = o.pk AND p.art = o.art LEFT JOIN d ON d.pk = o.pk AND d.art = o.art
LEFT JOIN k ON k.lage = o.sz AND o.layer = 'ax_flugverkehr' WHERE coalesce(p.txt, o.own, k.nm) IS NOT NULL"""


def labels(d):
    return rules.labels(rules.unified(tables(d)), rules.placed_links(placed(d)), rules.placed_links(overrides(d)), enums(d), catalogue(d))


for _name in ("f04_label_rule",):
    @query(_name, LABEL_SQL)
    def _(d):
        return labels(d).select("gml_id", "layer", F.col("text").alias("txt"), F.col("signaturnummer").alias("style"))


@query("f05_enumeration_label", f"""
SELECT gml_id, txt FROM ({LABEL_SQL}) l WHERE txt LIKE 'Halde%'""")
def _(d):
    t = {"ax_halde": tables(d)["ax_halde"]}
    out = rules.labels(rules.unified(t), rules.placed_links(placed(d)), rules.placed_links(overrides(d)), enums(d), catalogue(d))
    return out.filter(F.col("text").startswith("Halde")).select("gml_id", F.col("text").alias("txt"))


@query("f06_catalogue_label", f"""
SELECT l_partkey AS pk, coalesce((SELECT arg_max(s_name, s_suppkey) FROM supplier WHERE s_nationkey = p_size), '(Lagebezeichnung zu ''14511000' || lpad(CAST(p_size AS STRING), 5, '0') || ''' fehlt)') AS txt, '4206' AS style
FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 5) l JOIN part ON p_partkey = l_partkey""")
def _(d):
    objects = d.sql(f"""SELECT {FIELDS}, '14' AS land, '5' AS regierungsbezirk, '11' AS kreis, '000' AS gemeinde, lpad(CAST(p_size AS STRING), 5, '0') AS lage,
                        CAST(NULL AS STRING) AS unverschluesselt FROM part""")
    texts = placed(d).limit(0).drop("dientzurdarstellungvon", "art", "wkb_geometry")
    gew = d.sql("SELECT DISTINCT 'DESN' || lpad(CAST(l_partkey AS STRING), 12, '0') AS gml_id FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 5")
    p = gew.select(F.array("gml_id").alias("dientzurdarstellungvon"), F.lit("Gewanne").alias("art"), G.point(F.lit(1.0), F.lit(2.0)).alias("wkb_geometry"),
                   *[F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in texts.columns])
    out = rules.labels(rules.unified({"ax_lagebezeichnungohnehausnummer": objects}), rules.placed_links(p), rules.placed_links(overrides(d)), enums(d), catalogue(d))
    return out.select(F.substring("gml_id", 5, 12).cast("long").alias("pk"), F.col("text").alias("txt"), F.col("signaturnummer").alias("style"))


def tracks(d):
    """Polylines as tracks with categories by order key."""
    cat = F.element_at(F.array(F.array(F.lit(1201)), F.array(F.lit(1301)), F.array(F.lit(1600)), F.array(F.lit(1100))), (F.col("oid") % 4 + 1).cast("int"))
    lzo = F.when(F.col("oid") % 3 == 1, 1200).when(F.col("oid") % 3 == 2, 1500)
    return d.polylines().select(F.col("oid").cast("string").alias("gml_id"), F.lit(None).cast("string").alias("endet"), cat.alias("bahnkategorie"),
                                lzo.alias("lagezuroberflaeche"), F.lit(None).cast("string").alias("name"), G.line(F.col("part")).alias("wkb_geometry"),
                                F.array(F.lit("DLKM")).alias("advstandardmodell"))


@query("f02_line_rule", "SELECT DISTINCT CAST(oid AS STRING) AS gml_id, CASE oid % 3 WHEN 0 THEN '2525' ELSE '2300' END AS style FROM steps WHERE oid % 3 <> 2", ("steps",))
def _(d):
    return rules.line_layer(rules.unified({"ax_gleis": tracks(d)})).select("gml_id", F.col("signaturnummer").alias("style"))


@query("f08_track_symbols", """
WITH pv AS (SELECT oid, k, y, lag(y, 1, 0) OVER (PARTITION BY oid ORDER BY k) AS py, lag(k, 1, 0) OVER (PARTITION BY oid ORDER BY k) AS pk FROM steps),
t AS (SELECT oid, sum(10 * (k - pk) + abs(y - py)) AS total FROM pv GROUP BY oid)
SELECT CASE oid % 4 WHEN 0 THEN '3646' WHEN 1 THEN '3647' ELSE '3649' END AS style, count(*) AS objects,
  CAST(sum(1 + total // CASE oid % 4 WHEN 0 THEN 16 WHEN 1 THEN 8 ELSE 20 END) AS BIGINT) AS n FROM t WHERE oid % 4 <> 3 GROUP BY 1""", ("steps",))
def _(d):
    out = rules.track_symbols(tracks(d))
    return out.groupBy(F.col("signaturnummer").alias("style")).agg(F.countDistinct("gml_id").alias("objects"), F.count(F.lit(1)).alias("n"))


@query("f09_widened_line", """
SELECT oid, CAST(10 * min(k) * 0.6 AS DOUBLE) AS area FROM steps GROUP BY oid""", ("steps",))
def _(d):
    first = d.polylines().select("oid", F.slice("part", 1, 2).alias("part"))
    return first.select("oid", F.round(G.area(G.flat_buffer(F.col("part"), 0.3)), 6).alias("area"))


@query("f07_text_on_line", """
SELECT oid, CASE WHEN oid % 2 = 0 THEN 'Weg' ELSE 'Gleis' END AS txt, CAST(count(*) AS BIGINT) AS steps FROM steps GROUP BY oid""", ("steps",))
def _(d):
    # labels on a placed line: the line text carries the geometry of the label
    from ..operators.links import link_join, link_table
    lto = d.polylines().select(F.array(F.col("oid").cast("string")).alias("serves"), G.line(F.col("part")).alias("line"),
                               F.when(F.col("oid") % 2 == 0, "Weg").alias("txt"))
    objects = d["steps"].groupBy("oid").agg(F.count(F.lit(1)).alias("steps")).select(F.col("oid").cast("string").alias("gml_id"), "oid", "steps")
    out = link_join(objects, link_table(lto, "serves", "gml_id"), "gml_id")
    return out.filter(G.is_line("line")).select("oid", F.coalesce("txt", F.lit("Gleis")).alias("txt"), "steps")


def flurstuecke(d):
    """Parcels with register and municipality keys."""
    df = d.sql("""SELECT pid AS ogc_fid, 'DESN' || lpad(CAST(pid AS STRING), 12, '0') AS gml_id, CAST(NULL AS STRING) AS endet, '2020' AS beginnt,
        CASE WHEN psize % 5 = 0 THEN 'true' ELSE 'false' END AS abweichenderrechtszustand, '14' AS land, CAST(psize % 4 AS STRING) AS gemarkungsnummer,
        CAST(pid % 3 AS INT) AS flurnummer, '14' AS gemeindezugehoerigkeit_land, '5' AS gemeindezugehoerigkeit_regierungsbezirk,
        CAST(psize % 2 AS STRING) AS gemeindezugehoerigkeit_kreis, CAST(psize % 4 AS STRING) AS gemeindezugehoerigkeit_gemeinde,
        CAST(pid AS STRING) AS zaehler, CASE WHEN psize % 3 <> 0 THEN CAST(psize AS STRING) END AS nenner, x0, y0, x1, y1 FROM parcel""")
    return d.split(df).withColumn("wkb_geometry", G.rectangle("x0", "y0", "x1", "y1")).withColumn("advstandardmodell", F.array(F.lit("DLKM")))


@query("f10_disputed_borders", """
WITH o AS (SELECT * FROM parcel WHERE psize % 5 = 0)
SELECT 'DESN' || lpad(CAST(a.pid AS STRING), 12, '0') AS gml_id, count(*) AS n, CAST(10 * count(*) AS DOUBLE) AS ln FROM o a JOIN o b ON a.pid < b.pid
 AND ((a.x1 = b.x0 AND a.y0 = b.y0) OR (b.x1 = a.x0 AND a.y0 = b.y0) OR (a.y1 = b.y0 AND a.x0 = b.x0) OR (b.y1 = a.y0 AND a.x0 = b.x0)) GROUP BY a.pid""", ("parcel",))
def _(d):
    out = rules.disputed_borders(flurstuecke(d), cell=25.0)
    return out.groupBy("gml_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(G.length("line")), 6).alias("ln"))


@query("v06_disputed_parcels", "SELECT count(*) AS n FROM parcel WHERE psize % 5 = 0", ("parcel",))
def _(d):
    return flurstuecke(d).filter("endet IS NULL AND abweichenderrechtszustand = 'true'").agg(F.count(F.lit(1)).alias("n"))


@query("f10_boundary_points", """
SELECT u.uid, CASE WHEN EXISTS (SELECT 1 FROM parcel p WHERE p.psize % 5 = 0 AND u.x0 BETWEEN p.x0 AND p.x1 AND u.y0 BETWEEN p.y0 AND p.y1)
  THEN CASE u.uid % 3 WHEN 0 THEN '3023' WHEN 1 THEN '3025' ELSE '3021' END ELSE CASE u.uid % 3 WHEN 0 THEN '3022' WHEN 1 THEN '3024' ELSE '3020' END END AS style FROM usearea u""", ("parcel", "usearea"))
def _(d):
    style = F.when(F.col("uid") % 3 == 0, "3022").when(F.col("uid") % 3 == 1, "3024").otherwise("3020")
    pts = d["usearea"].select(F.col("uid").cast("string").alias("gml_id"), G.point("x0", "y0").alias("point"), style.alias("signaturnummer"))
    out = rules.boundary_point_styles(pts, flurstuecke(d), cell=25.0)
    return out.select(F.col("gml_id").cast("long").alias("uid"), F.col("signaturnummer").alias("style"))


for _lvl, _cols in {"flur": "CAST(psize % 4 AS STRING) || CAST(pid % 3 AS STRING)", "gemarkung": "CAST(psize % 4 AS STRING)",
                    "gemeinde": "'5' || CAST(psize % 2 AS STRING) || CAST(psize % 4 AS STRING)", "kreis": "'5' || CAST(psize % 2 AS STRING)"}.items():
    @query(f"f11_outline_{_lvl}", f"""
    WITH p AS (SELECT '14' || {_cols} AS k, * FROM parcel),
    e AS (SELECT k, x0 AS ax, y0 AS ay, x1 AS bx, y0 AS b_y FROM p UNION ALL SELECT k, x1, y0, x1, y1 FROM p UNION ALL SELECT k, x0, y1, x1, y1 FROM p UNION ALL SELECT k, x0, y0, x0, y1 FROM p),
    o AS (SELECT k, ax, ay, bx, b_y FROM e GROUP BY ALL HAVING count(*) = 1)
    SELECT o.k, count(*) AS edges, max(a.area) AS area FROM o JOIN (SELECT k, CAST(100 * count(*) AS DOUBLE) AS area FROM p GROUP BY k) a ON a.k = o.k GROUP BY o.k""", ("parcel",))
    def _(d, level=_lvl):
        from ..operators import areas
        keys = hierarchy.LEVELS[level][0]
        e = hierarchy.outlines(flurstuecke(d), level)
        return areas.edge_sums(e, keys).select(F.concat(*keys).alias("k"), "edges", "area")


@query("f11_county_polygons_and_names", """
SELECT '145' || CASE WHEN pid % 100 < 50 THEN '0' ELSE '1' END AS k, CASE WHEN pid % 100 < 50 THEN 'Kreis 0' ELSE '(Kreis 1451)' END AS txt,
  CAST(100 * count(*) AS DOUBLE) AS area FROM parcel GROUP BY 1, 2""", ("parcel",))
def _(d):
    # two counties side by side, so simplifying keeps their corners
    p = flurstuecke(d).withColumn("gemeindezugehoerigkeit_kreis", F.when(F.col("ogc_fid") % 100 < 50, "0").otherwise("1"))
    poly = hierarchy.polygons(p, "kreis")
    dim = d.spark.createDataFrame([("14", "5", "0", "Kreis 0")], "land string, bezirk string, kreis string, bezeichnung string")
    lab = hierarchy.names(poly, dim, ["land", "bezirk", "kreis"], "bezeichnung", "Kreis")
    return poly.join(lab.select("layer", "text"), "layer").select(
        F.concat("land", "bezirk", "kreis").alias("k"), F.col("text").alias("txt"), F.round(G.area("polygon"), 6).alias("area"))


@query("f12_fraction_numbers", """
WITH p AS (SELECT *, CAST(greatest(length(CAST(pid AS STRING)), length(CAST(psize AS STRING))) AS DOUBLE) AS half FROM parcel WHERE psize % 3 <> 0)
SELECT pid, CAST(pid AS STRING) AS numerator, CAST(psize AS STRING) AS denominator, x0 + 5 - half AS bar_x0, x0 + 5 + half AS bar_x1, y0 + 5 AS y,
  CASE WHEN psize % 5 = 0 THEN '4123' ELSE '4115' END AS style FROM p""", ("parcel",))
def _(d):
    none = rules.placed_links(placed(d)).filter("gml_id = ''")
    n = rules.fraction_numbers(flurstuecke(d), none, rules.placed_links(overrides(d)).filter("gml_id = ''"))
    return n.select(F.substring("gml_id", 5, 12).cast("long").alias("pid"), "numerator", "denominator", "bar_x0", "bar_x1", "y", F.col("signaturnummer").alias("style"))


@query("f12_fraction_bars", """
SELECT pid, CAST(2 * greatest(length(CAST(pid AS STRING)), length(CAST(psize AS STRING))) AS DOUBLE) AS ln, '2001' AS style FROM parcel WHERE psize % 3 <> 0""", ("parcel",))
def _(d):
    none = rules.placed_links(placed(d)).filter("gml_id = ''")
    n = rules.fraction_numbers(flurstuecke(d), none, rules.placed_links(overrides(d)).filter("gml_id = ''"))
    return rules.bar_line(n).select(F.substring("gml_id", 5, 12).cast("long").alias("pid"), F.round(G.length("line"), 6).alias("ln"), F.col("signaturnummer").alias("style"))


@query("f12_slash_numbers", """
SELECT pid, CAST(pid AS STRING) AS txt, CASE WHEN psize % 5 = 0 THEN '4122' ELSE '4113' END AS style FROM parcel WHERE psize % 3 = 0""", ("parcel",))
def _(d):
    none = rules.placed_links(placed(d)).filter("gml_id = ''")
    out = rules.slash_numbers(flurstuecke(d), none, rules.placed_links(overrides(d)).filter("gml_id = ''"))
    return out.select(F.substring("gml_id", 5, 12).cast("long").alias("pid"), F.col("text").alias("txt"), F.col("signaturnummer").alias("style"))


# -- post-pass --------------------------------------------------------------

STYLES = "SELECT p_partkey AS pk, CASE p_size % 5 WHEN 0 THEN '25151406' WHEN 1 THEN '1301' WHEN 2 THEN '2028' WHEN 3 THEN '2031' ELSE 'RP6000' END AS sn FROM part"


@query("f13_split_styles", f"""
SELECT pk, CASE sn WHEN '25151406' THEN '1406' WHEN '1301' THEN '1301' WHEN '2031' THEN '2031' END AS fill,
  CASE sn WHEN '25151406' THEN 'rn25151406' WHEN '2028' THEN '2028' WHEN '2031' THEN '2031' END AS edge FROM ({STYLES}) s WHERE sn <> 'RP6000'""")
def _(d):
    polys = d.sql(STYLES).select("pk", F.col("sn").alias("signaturnummer"), F.array(F.lit("b"), F.lit(None), F.lit("a"), F.lit("b")).alias("modell"))
    known = d.spark.createDataFrame([("2031", None), ("25151406", 7)], "signaturnummer string, randlinie int")
    return postpass.finish_polygons(polys, known).select("pk", F.col("sn_flaeche").alias("fill"), F.col("sn_randlinie").alias("edge"))


@query("f13_finish_labels", """
SELECT p_partkey AS pk, replace(p_name, ' ', chr(10)) AS txt, CAST(90 AS DOUBLE) AS deg, CASE WHEN p_size > 25 THEN 1.0 ELSE 2.0 END::DOUBLE AS scale, 'a,b' AS models
FROM part WHERE p_size <> 6""")
def _(d):
    import math
    lab = d["part"].select(F.col("p_partkey").alias("pk"), F.replace("p_name", F.lit(" "), F.lit("\\n")).alias("text"), F.lit(math.pi / 2).alias("drehwinkel"),
                           F.when(F.col("p_size") <= 25, 2.0).alias("skalierung"), F.when(F.col("p_size") == 6, "6000").otherwise("4113").alias("signaturnummer"),
                           F.array(F.lit("b"), F.lit("a"), F.lit("b")).alias("modell"))
    return postpass.finish_labels(lab).select("pk", F.col("text").alias("txt"), F.round("drehwinkel_grad", 6).alias("deg"), F.col("skalierung").alias("scale"),
                                              F.array_join("modell", ",").alias("models"))


@query("g18_arrow_heads", """
SELECT oid, CAST(0 AS DOUBLE) AS px, CAST(0 AS DOUBLE) AS py, CAST(2.0 AS DOUBLE) AS tipx, CAST(-1.0 AS DOUBLE) AS tipy FROM (SELECT DISTINCT oid FROM steps WHERE oid % 2 = 0) s""", ("steps",))
def _(d):
    ln = d.polylines().select("oid", F.lit("g").alias("gml_id"), G.line(F.col("part")).alias("line"),
                              F.when(F.col("oid") % 2 == 0, "2001").otherwise("2002").alias("signaturnummer"))
    st = d.spark.createDataFrame([("2001", "Pfeil", 200.0, 200.0), ("2002", None, 1.0, 1.0)], "signaturnummer string, abschluss string, pfeillaenge double, pfeilhoehe double")
    v = F.col("line")["parts"][0]
    out = postpass.arrow_heads(ln, st)
    return out.select("oid", F.round(v[1]["x"], 6).alias("px"), F.round(v[1]["y"], 6).alias("py"), (F.round(v[0]["x"], 6) + 0.0).alias("tipx"), (F.round(v[0]["y"], 6) + 0.0).alias("tipy"))


@query("f13_outline_styles", "SELECT 'rn' || CAST(n_nationkey AS STRING) AS sn, r_name AS farbe FROM nation JOIN region ON r_regionkey = n_regionkey")
def _(d):
    fl = d["nation"].select(F.lit(1).alias("katalog"), F.col("n_nationkey").cast("string").alias("signaturnummer"), F.col("n_regionkey").alias("randlinie"))
    ed = d["region"].select(F.col("r_regionkey").alias("id"), *[F.lit(1).alias(c) for c in ("strichart", "abschluss", "scheitel", "strichstaerke")], F.col("r_name").alias("farbe"))
    return postpass.outline_styles(fl, ed).select(F.col("signaturnummer").alias("sn"), "farbe")


@query("f13_shift_untagged", """
SELECT p_partkey AS pk, CASE WHEN p_size % 2 = 0 AND p_partkey % 3 = 0 THEN 3.0 ELSE 0.0 END::DOUBLE AS y, CASE WHEN p_size % 2 = 0 AND p_partkey % 3 = 0 THEN 'ax_flurstueck_nummer_rpnoart' ELSE 'ax_flurstueck_nummer' END AS layer FROM part""")
def _(d):
    pre = F.when(F.col("p_size") % 2 == 0, "DERP").otherwise("DESN")
    lab = d["part"].select(F.concat(pre, F.col("p_partkey").cast("string")).alias("gml_id"), F.lit("ax_flurstueck_nummer").alias("layer"),
                           G.point(F.col("p_partkey").cast("double"), F.lit(0.0)).alias("point"))
    txt = d["part"].filter("p_partkey % 3 = 0").select(F.lit(None).cast("string").alias("art"), F.lit(None).cast("string").alias("endet"),
                                                       F.array(F.concat(pre, F.col("p_partkey").cast("string"))).alias("dientzurdarstellungvon"))
    out = postpass.shift_untagged_numbers(lab, txt, "point")
    return out.select(F.substring("gml_id", 5, 20).cast("long").alias("pk"), F.col("point")["parts"][0][0]["y"].alias("y"), "layer")


@query("v01_missing_styles", """
SELECT 'Punkt' AS kind, count(*) AS n, string_agg(DISTINCT CAST(p_size AS STRING), ',' ORDER BY CAST(p_size AS STRING)) AS styles FROM part WHERE p_size > 25
UNION ALL SELECT 'Beschriftungen', count(*), string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) FROM part WHERE p_brand NOT LIKE 'Brand#1%'""")
def _(d):
    pts = d["part"].select(F.col("p_size").cast("string").alias("signaturnummer"))
    lab = d["part"].select(F.col("p_brand").alias("signaturnummer"))
    poly = d["part"].select(F.lit("1").alias("sn_flaeche"), F.lit("2").alias("sn_randlinie"))
    known = {"points": pts.filter("CAST(signaturnummer AS INT) <= 25"), "lines": d.spark.createDataFrame([("2",)], "signaturnummer string"),
             "fills": d.spark.createDataFrame([("1",)], "signaturnummer string"), "fonts": lab.filter("signaturnummer LIKE 'Brand#1%'")}
    return postpass.missing_styles(pts, pts.limit(0), poly, lab, known)


@query("v02_model_histogram", """
SELECT modell, count(*) AS n FROM (SELECT p_brand AS modell FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT s_name FROM supplier) u GROUP BY modell""")
def _(d):
    a = d["part"].select(F.array("p_brand", "p_type").alias("modell"))
    return postpass.model_histogram([a, d["supplier"].select(F.array("s_name").alias("modell"))])


@query("v04_objects_without_style", "SELECT p_size AS code, count(*) AS n FROM part WHERE p_partkey % 4 = 1 AND p_size % 4 = 3 GROUP BY p_size")
def _(d):
    from ..plans.ruleset import SYMBOLS
    t = {"ax_weg": tables(d)["ax_weg"]}
    empty = rules.placed_links(placed(d)).filter("gml_id = ''")
    drawn = rules.symbols(rules.unified(t), empty, rules.placed_links(overrides(d)).filter("gml_id = ''").withColumn("positionierungsregel", F.lit(None).cast("string")))
    objs = d["part"].filter("p_partkey % 4 = 1").select(F.concat(F.lit("DESN"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("gml_id"), F.col("p_size").alias("code"))
    return rules.unstyled(objs, drawn, "code")


BORDER = """SELECT l_orderkey AS oid, CASE l_linenumber WHEN 1 THEN 7101 WHEN 2 THEN 7102 WHEN 3 THEN 2500 WHEN 4 THEN 7104 WHEN 5 THEN 7003 WHEN 6 THEN 1 ELSE 7106 END AS code FROM lineitem"""


def borders(d):
    codes = d.sql(BORDER).groupBy("oid").agg(F.collect_set("code").alias("artderflurstuecksgrenze"))
    return codes.join(d.polylines(), "oid").select(F.col("oid").alias("ogc_fid"), F.col("oid").cast("string").alias("gml_id"), F.lit(None).cast("string").alias("endet"),
                                                  "artderflurstuecksgrenze", G.line(F.col("part")).alias("wkb_geometry"), F.array(F.lit("DLKM")).alias("advstandardmodell"))


BCOUNT = f"""SELECT sn, count(DISTINCT oid) AS n FROM ({BORDER}) b JOIN (VALUES ('2016', 7101), ('2018', 7102), ('2010', 2500), ('2010', 7104), ('2014', 7003), ('2022', 7106)) r(sn, c) ON r.c = b.code GROUP BY sn"""


@query("v05_border_counts", BCOUNT)
def _(d):
    return rules.border_counts(borders(d))


@query("f10_political_borders", f"""
WITH v AS (SELECT oid, string_agg(CAST(k AS STRING) || ':' || CAST(y AS STRING), ',' ORDER BY k) AS shape FROM steps GROUP BY oid),
h AS (SELECT DISTINCT v.shape, r.sn FROM ({BORDER}) b JOIN v ON v.oid = b.oid JOIN (VALUES ('2016', 7101), ('2018', 7102), ('2010', 2500), ('2010', 7104), ('2014', 7003), ('2022', 7106)) r(sn, c) ON r.c = b.code)
SELECT sn, count(*) AS n FROM h GROUP BY sn""", ("steps",))
def _(d):
    # equal shapes are one border that carries all codes
    return rules.border_layer(borders(d)).groupBy(F.col("signaturnummer").alias("sn")).agg(F.count(F.lit(1)).alias("n"))
