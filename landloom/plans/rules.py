"""Map layers from object tables by data-driven rules.

All object types of a family go through one plan: the tables are brought to one
shape (id, type, geometry, models, attributes), the rules of a type arrive by a
broadcast of the fixed rule table, and placed objects and style overrides by
one equi join each on (id, tag).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import arrays as A, geometry as G, text as T
from ..operators import areas, lines, links, lookups, spatial
from . import ruleset as R

COND = "struct<attr:string,negated:boolean,nul:boolean,ranges:array<struct<lo:int,hi:int>>>"
CHOICE = f"array<struct<conds:array<{COND}>,value:string>>"
PLACED = ["art", "signaturnummer", "drehwinkel", "horizontaleausrichtung", "vertikaleausrichtung", "skalierung",
          "fontsperrung", "schriftinhalt", "positionierungsregel"]
TEXT_LOOK = ["drehwinkel", "horizontaleausrichtung", "vertikaleausrichtung", "skalierung", "fontsperrung"]


# -- rule data as columns -------------------------------------------------

def _condition(attr: str, codes: str):
    negated, codes = codes.startswith("!"), codes.lstrip("!")
    tokens = codes.split()
    spans = [tuple(map(int, t.split("-"))) if "-" in t else (int(t), int(t)) for t in tokens if t != "null"]
    return (attr, negated, ("null" in tokens) != negated, spans)


def _choices(pairs) -> list:
    return [([_condition(a, c) for a, c in conds.items()], str(value)) for conds, value in pairs]


def _holds(cond: Column, attrs: Column) -> Column:
    # a value that is no whole number is there, but in no range
    among = lambda v: F.coalesce(F.exists(cond["ranges"], lambda r: v.try_cast("int").between(r["lo"], r["hi"])), F.lit(False))
    return G.let(F.try_element_at(attrs, cond["attr"]),
                 lambda v: F.when(v.isNull(), cond["nul"]).otherwise(among(v) != cond["negated"]))


def chosen(choices: Column | str, attrs: Column | str) -> Column:
    """Value of the first choice whose conditions all hold."""
    choices, attrs = T.col(choices), T.col(attrs)
    hits = F.filter(choices, lambda c: F.forall(c["conds"], lambda k: _holds(k, attrs)))
    return F.get(hits, F.lit(0))["value"]


def used_attributes() -> set[str]:
    names = {a for rules in [*R.FILLS.values(), *R.SYMBOLS.values(), *R.LINES.values()] for conds, _ in rules for a in conds}
    for spec in R.LABELS.values():
        names |= {a for conds, _ in [*spec.get("constant", []), *spec.get("styles", [])] for a in conds}
        names |= {*spec.get("when", {}), *spec.get("enum_when", {})}
        names |= {spec["text"]} if "text" in spec else set()
        names |= {spec["enum"][1]} if "enum" in spec else set()
    return names


# -- objects in one shape -------------------------------------------------

def models(df: DataFrame) -> Column:
    have = [c for c in ("advstandardmodell", "sonstigesmodell") if c in df.columns]
    return A.arr_cat(*have) if have else F.lit(None).cast("array<string>")


def unified(tables: dict[str, DataFrame], names: list[str] | None = None) -> DataFrame:
    """Open objects of many types: gml_id, source, geom, modell, attrs, katalogschluessel."""
    wanted = used_attributes()

    def shape(name, df):
        have = [c for c in df.columns if c in wanted]
        as_text = lambda c: F.when(F.col(c) == "true", "1").otherwise(F.col(c).cast("string")) if c == "hochhaus" else F.col(c).cast("string")
        pairs = [x for c in have for x in (F.lit(c), as_text(c))]
        dim = F.when(G.is_point("wkb_geometry"), "1").when(G.is_line("wkb_geometry"), "2").when(G.is_polygon("wkb_geometry"), "3") \
            if "wkb_geometry" in df.columns else F.lit(None).cast("string")
        attrs = F.create_map(F.lit("_dim"), dim, *pairs)
        parts = ("land", "regierungsbezirk", "kreis", "gemeinde", "lage")
        key = T.catalogue_key(*parts) if all(p in df.columns for p in parts) else F.lit(None).cast("string")
        geom = F.col("wkb_geometry") if "wkb_geometry" in df.columns else F.lit(None).cast(G.GEOM)
        return links.open_rows(df).select("gml_id", F.lit(name).alias("source"), geom.alias("geom"),
                                          models(df).alias("modell"), attrs.alias("attrs"), key.alias("katalogschluessel"))

    picked = {n: t for n, t in tables.items() if names is None or n in names}
    return lookups.unify(picked, shape)


def placed_links(table: DataFrame) -> DataFrame:
    """Placed objects as ``(gml_id, art)`` with their look; one row per reference."""
    cols = [c for c in PLACED if c in table.columns]
    rows = links.open_rows(table).select(
        *cols, *([F.col("wkb_geometry").alias("geom")] if "wkb_geometry" in table.columns else []),
        models(table).alias("modell"), "dientzurdarstellungvon")
    return links.link_table(rows, "dientzurdarstellungvon", "gml_id")


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c) if c in ("gml_id", "art") else F.col(c).alias(prefix + c) for c in df.columns])


def rule_table(spark: SparkSession, rows: list, columns: str) -> DataFrame:
    """The rules are program text of fixed size, hence broadcast."""
    return F.broadcast(spark.createDataFrame(rows, columns))


# -- families -------------------------------------------------------------

def fills(objects: DataFrame) -> DataFrame:
    """Area rules: polygons with a style by type and codes."""
    rows = [(s, R.theme_of(s), _choices(c)) for s, c in R.FILLS.items()]
    rules = rule_table(objects.sparkSession, rows, f"source string, thema string, choices {CHOICE}")
    out = objects.filter(G.is_polygon("geom")).join(rules, "source")
    return out.select("gml_id", "thema", F.col("source").alias("layer"), G.multi("geom").alias("polygon"),
                      chosen("choices", "attrs").alias("signaturnummer"), "modell").filter("signaturnummer IS NOT NULL")


def line_layer(objects: DataFrame) -> DataFrame:
    """Line rules: lines with a style by type and codes."""
    rows = [(s, R.theme_of(s), _choices(c)) for s, c in R.LINES.items()]
    rules = rule_table(objects.sparkSession, rows, f"source string, thema string, choices {CHOICE}")
    out = objects.filter(G.is_line("geom")).join(rules, "source")
    return out.select("gml_id", "thema", F.col("source").alias("layer"), G.multi("geom").alias("line"),
                      chosen("choices", "attrs").alias("signaturnummer"), "modell").filter("signaturnummer IS NOT NULL")


def symbols(objects: DataFrame, placed: DataFrame, overrides: DataFrame) -> DataFrame:
    """Symbol rules: placed symbol, else area fill by placing rule, else centroid."""
    rows = [(s, tag, R.theme_of(s), (s, tag) in R.PLACED_SYMBOLS, _choices(c)) for (s, tag), c in R.SYMBOLS.items()]
    rules = rule_table(objects.sparkSession, rows, f"source string, art string, thema string, needs_placed boolean, choices {CHOICE}")
    base = objects.join(rules, "source").withColumn("rule_style", chosen("choices", "attrs")).drop("choices")
    ov = overrides.select("gml_id", "art", "signaturnummer", "positionierungsregel", "modell")
    out = (base.join(_prefixed(placed.select("gml_id", "art", "geom", "drehwinkel", "signaturnummer", "modell"), "p_"), ["gml_id", "art"], "left")
           .join(_prefixed(ov, "d_"), ["gml_id", "art"], "left"))
    style = links.style_priority("d_signaturnummer", "p_signaturnummer", "rule_style")
    out = out.withColumn("signaturnummer", style).filter("signaturnummer IS NOT NULL AND (NOT needs_placed OR p_geom IS NOT NULL)")
    look = ["gml_id", "thema", F.col("source").alias("layer"), F.coalesce("p_drehwinkel", F.lit(0.0)).alias("drehwinkel"),
            "signaturnummer", F.coalesce(A.arr_cat("p_modell", "d_modell"), F.col("modell")).alias("modell")]
    fills_ = F.col("p_geom").isNull() & F.col("d_positionierungsregel").isNotNull() & (G.kind("geom") == "POLYGON")
    anchor = F.coalesce(F.col("p_geom"), G.centroid("geom"))
    single = out.filter(~F.coalesce(fills_, F.lit(False))).select(*look, G.multi(anchor).alias("point"))
    lattice = areas.area_fill(out.filter(fills_).withColumn("layer", F.col("source")).withColumn("drehwinkel", F.coalesce("p_drehwinkel", F.lit(0.0)))
                              .withColumn("modell", F.coalesce(A.arr_cat("p_modell", "d_modell"), F.col("modell"))),
                              "geom", "d_positionierungsregel", ["gml_id", "thema", "layer", "drehwinkel", "signaturnummer", "modell"])
    dots = lattice.select("gml_id", "thema", "layer", "drehwinkel", "signaturnummer", "modell",
                          G.multi(G.point("x", "y")).alias("point"))
    return single.filter("point IS NOT NULL").unionByName(dots)


def labels(objects: DataFrame, placed: DataFrame, overrides: DataFrame, enums: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Label rules: placed text, attribute, enumeration, catalogue name, constant, missing text.

    ``enums`` has domain, code, label; ``catalogue`` has katalogschluessel, bezeichnung, beginnt.
    """
    rows = []
    for (s, tag), spec in R.LABELS.items():
        domain, attr, before, after = spec.get("enum", (None, None, None, None))
        m0, m1 = spec.get("missing", (None, None))
        rows.append((s, tag, spec.get("theme") or R.theme_of(s), spec["style"], spec.get("placed", False), spec.get("text"),
                     domain, attr, before, after, spec.get("catalogue", False), m0, m1, _choices(spec.get("constant", [])),
                     _choices([(spec.get("when", R.ANY), 1)]), _choices([(spec.get("enum_when", R.ANY), 1)]), _choices(spec.get("styles", [])),
                     spec.get("unless")))
    rules = rule_table(objects.sparkSession, rows, (
        "source string, art string, thema string, rule_style string, needs_placed boolean, text_attr string, domain string, "
        f"enum_attr string, before string, after string, from_catalogue boolean, m0 string, m1 string, choices {CHOICE}, "
        f"whens {CHOICE}, enum_whens {CHOICE}, styles {CHOICE}, unless string"))
    attr = lambda name: F.when(F.col(name).isNotNull(), F.try_element_at("attrs", F.col(name)))
    base = objects.join(rules, "source").filter(chosen("whens", "attrs").isNotNull()).select(
        "gml_id", "source", "art", "thema", F.coalesce(chosen("styles", "attrs"), "rule_style").alias("rule_style"), "needs_placed", "geom",
        "modell", "before", "after", "domain", "m0", "m1", "unless",
        attr("text_attr").alias("own_text"), F.when(chosen("enum_whens", "attrs").isNotNull(), attr("enum_attr")).alias("code"),
        F.when(F.col("from_catalogue"), F.col("katalogschluessel")).alias("katalogschluessel"),
        chosen("choices", "attrs").alias("constant"))
    dim = enums.groupBy("domain", "code").agg(F.min("label").alias("label"))
    names = lookups.latest(catalogue, ["katalogschluessel"], "bezeichnung", "beginnt", "kat_name")
    texts = _prefixed(placed.select("gml_id", "art", "geom", "schriftinhalt", "signaturnummer", "modell", *TEXT_LOOK), "t_")
    # only labels that give way to another tag look for its texts
    others = placed.filter("schriftinhalt IS NOT NULL").select("gml_id", F.col("art").alias("unless"))
    base = base.filter("unless IS NULL").unionByName(base.filter("unless IS NOT NULL").join(others, ["gml_id", "unless"], "left_anti")).drop("unless")
    out = (base.join(texts, ["gml_id", "art"], "left")
           .join(_prefixed(overrides.select("gml_id", "art", "signaturnummer"), "d_"), ["gml_id", "art"], "left")
           .join(dim, ["domain", "code"], "left").join(names, "katalogschluessel", "left"))
    text = F.coalesce("t_schriftinhalt", "own_text", F.concat("before", "label", "after"), "kat_name", "constant",
                      F.concat("m0", "katalogschluessel", "m1"))
    has_placed = F.col("t_geom").isNotNull()
    return (out.filter(~F.col("needs_placed") | has_placed).select(
        "gml_id", "thema", F.col("source").alias("layer"), F.coalesce("t_geom", G.centroid("geom")).alias("point"),
        text.alias("text"), links.style_priority("d_signaturnummer", "t_signaturnummer", "rule_style").alias("signaturnummer"),
        *[F.col("t_" + c).alias(c) for c in TEXT_LOOK], F.coalesce("t_modell", "modell").alias("modell"))
        .filter("text IS NOT NULL"))


# -- rules with a shape of their own --------------------------------------

def further_functions(buildings: DataFrame, codes: dict[int, str]) -> DataFrame:
    """One row per further function of a building with the symbol of that function."""
    rows = links.open_rows(buildings).select("gml_id", F.col("wkb_geometry").alias("geom"), models(buildings).alias("modell"),
                                             F.explode("weiteregebaeudefunktion").alias("funktion"))
    return rows.withColumn("signaturnummer", lookups.mapped(F.col("funktion"), codes)).filter("signaturnummer IS NOT NULL")


def _first_set(codes: Column, table) -> Column:
    out = None
    for values, result in table:
        hit = F.arrays_overlap(codes, F.array(*[F.lit(v) for v in values]))
        out = F.when(hit, result) if out is None else out.when(hit, result)
    return out


def track_symbols(tracks: DataFrame) -> DataFrame:
    """Symbols at intervals along tracks by track category."""
    rows = links.open_rows(tracks).select("gml_id", "bahnkategorie", models(tracks).alias("modell"), "wkb_geometry")
    rows = rows.withColumn("signaturnummer", _first_set(F.col("bahnkategorie"), R.TRACK_SYMBOLS)).withColumn(
        "_step", _first_set(F.col("bahnkategorie"), R.TRACK_SPACING)).filter("signaturnummer IS NOT NULL")
    parts = lines.line_parts(rows, "wkb_geometry", ["gml_id", "signaturnummer", "modell", "_step"])
    sym = lines.symbols_along(parts, "part", ["gml_id", "signaturnummer", "modell"], 0, F.col("_step"))
    return sym.select("gml_id", F.lit("Verkehr").alias("thema"), F.lit("ax_gleis").alias("layer"),
                      G.multi(G.point("x", "y")).alias("point"), "drehwinkel", "signaturnummer", "modell")


def border_layer(borders: DataFrame) -> DataFrame:
    """Political borders: equal geometries once, then one line per object, style and model set."""
    sets = lines.border_sets(links.open_rows(borders), "wkb_geometry", "ogc_fid", "gml_id", "artderflurstuecksgrenze", models(borders))
    styles = borders.sparkSession.createDataFrame([(s, list(c)) for s, c in R.BORDER_STYLES], "signaturnummer string, adfs array<int>")
    hits = links.overlap_join(sets, "artderflurstuecksgrenze", F.broadcast(styles), "adfs", ["ogc_fid", "signaturnummer"])
    merged = lines.merge_lines(hits, ["gml_id", "signaturnummer", "modell"], "wkb_geometry")
    return merged.select("gml_id", F.lit("Politische Grenzen").alias("thema"), F.lit("ax_besondereflurstuecksgrenze").alias("layer"),
                         "line", "signaturnummer", "modell")


def border_counts(borders: DataFrame) -> DataFrame:
    """Number of borders per code set."""
    sets = links.open_rows(borders).select("gml_id", "artderflurstuecksgrenze")
    styles = borders.sparkSession.createDataFrame([(s, list(c)) for s, c in R.BORDER_STYLES], "sn string, adfs array<int>")
    hits = links.overlap_join(sets, "artderflurstuecksgrenze", F.broadcast(styles), "adfs", ["gml_id", "sn"])
    return hits.groupBy("sn").agg(F.count(F.lit(1)).alias("n"))


def disputed_borders(parcels: DataFrame, cell: float = 64.0, style: str = "2029") -> DataFrame:
    """Border pieces between two parcels of deviating legal state."""
    rows = links.open_rows(parcels).filter("abweichenderrechtszustand = 'true'").select("ogc_fid", "gml_id", "wkb_geometry", models(parcels).alias("modell"))
    pieces = spatial.shared_borders(rows.select("ogc_fid", "wkb_geometry"), "wkb_geometry", "ogc_fid", cell=cell)
    line = F.transform(F.array_sort(F.collect_list(F.struct("ax", "ay", "bx", "by"))),
                       lambda e: F.array(G.vertex(e["ax"], e["ay"]), G.vertex(e["bx"], e["by"])))
    pairs = pieces.groupBy("a", "b").agg(G.geom("MULTILINESTRING", line).alias("line"))
    left = rows.select(F.col("ogc_fid").alias("a"), "gml_id", F.col("modell").alias("_ma"))
    right = rows.select(F.col("ogc_fid").alias("b"), F.col("modell").alias("_mb"))
    return pairs.join(left, "a").join(right, "b").select(
        "gml_id", F.lit("Flurstücke").alias("thema"), F.lit("ax_flurstueck").alias("layer"), "line",
        F.lit(style).alias("signaturnummer"), A.arr_cat("_ma", "_mb").alias("modell"))


def boundary_point_styles(points: DataFrame, parcels: DataFrame, cell: float = 64.0) -> DataFrame:
    """Boundary points on parcels of deviating legal state take the paired style.

    ``points`` has gml_id, point, signaturnummer.
    """
    odd = links.open_rows(parcels).filter("abweichenderrechtszustand = 'true'").select(F.col("wkb_geometry").alias("_fg"))
    hit = (spatial.intersects_join(points.select("gml_id", "point"), odd, "point", "_fg", cell)
           .select("gml_id").distinct().withColumn("_odd", F.lit(True)))
    paired = F.when(F.col("signaturnummer") == "3022", "3023").when(F.col("signaturnummer") == "3024", "3025").otherwise("3021")
    return points.join(hit, "gml_id", "left").withColumn(
        "signaturnummer", F.when(F.col("_odd"), paired).otherwise(F.col("signaturnummer"))).drop("_odd")


def fraction_numbers(parcels: DataFrame, placed: DataFrame, overrides: DataFrame, prefer_bar: bool = True) -> DataFrame:
    """Parcel numbers as numerator, bar and denominator: one row per parcel and placed text.

    Columns: numerator, denominator, half (half bar width), x and y of the anchor,
    num_x (shifted anchor of the numbers), bar_x0, bar_x1, style of numbers and bar.
    """
    p = links.open_rows(parcels).filter(F.coalesce("nenner", F.lit("0")) != "0")
    texts = _prefixed(placed.select("gml_id", "geom", "schriftinhalt", "signaturnummer", *TEXT_LOOK), "t_")
    ov = _prefixed(overrides.select("gml_id", "signaturnummer"), "d_")
    out = p.select("gml_id", "zaehler", "nenner", "abweichenderrechtszustand", "wkb_geometry").join(texts, "gml_id", "left").join(ov, "gml_id", "left")
    given = F.col("t_signaturnummer")
    wanted = (~F.coalesce(given, F.lit("4115")).isin("4113", "4122")) if prefer_bar else F.coalesce(given, F.lit("4113")).isin("4115", "4123")
    written = F.replace("t_schriftinhalt", F.lit("-"), F.lit("/"))
    half = lambda i, own: F.coalesce(F.split_part(written, F.lit("/"), F.lit(i)), F.col(own).cast("string"))
    out = out.filter(wanted).select("*", half(1, "zaehler").alias("numerator"), half(2, "nenner").alias("denominator"),
                                    F.coalesce("t_geom", G.centroid("wkb_geometry")).alias("anchor"))
    wide = F.greatest(F.length("numerator"), F.length("denominator")).cast("double")
    out = out.withColumn("half", wide).withColumn("x", F.col("anchor")["parts"][0][0]["x"]).withColumn("y", F.col("anchor")["parts"][0][0]["y"])
    align = F.col("t_horizontaleausrichtung")
    mid = F.when(align == "rechtsbündig", F.col("x") - F.col("half")).when(align == "linksbündig", F.col("x") + F.col("half")).otherwise(F.col("x"))
    style = links.style_priority("d_signaturnummer", "t_signaturnummer", F.when(F.col("abweichenderrechtszustand") == "true", "4123").otherwise("4115"))
    return out.withColumn("num_x", mid).select(
        "gml_id", "numerator", "denominator", "half", "x", "y", "num_x", (F.col("num_x") - F.col("half")).alias("bar_x0"),
        (F.col("num_x") + F.col("half")).alias("bar_x1"), style.alias("signaturnummer"),
        F.coalesce("d_signaturnummer", F.lit("2001")).alias("strich"), F.coalesce("t_drehwinkel", F.lit(0.0)).alias("drehwinkel"))


def bar_line(numbers: DataFrame) -> DataFrame:
    """Fraction bars as lines, turned about the anchor."""
    flat = G.geom("MULTILINESTRING", F.array(F.array(G.vertex("bar_x0", "y"), G.vertex("bar_x1", "y"))))
    return numbers.filter("half > 0").select("gml_id", G.rotate(flat, F.col("drehwinkel"), F.col("x"), F.col("y")).alias("line"),
                                             F.col("strich").alias("signaturnummer"))


def slash_numbers(parcels: DataFrame, placed: DataFrame, overrides: DataFrame) -> DataFrame:
    """Parcel numbers written with a slash."""
    tag = "ZAE_NEN"
    texts = _prefixed(placed.filter(F.col("art") == tag).select("gml_id", "geom", "schriftinhalt", "signaturnummer"), "t_")
    ov = _prefixed(overrides.filter(F.col("art") == tag).select("gml_id", "signaturnummer"), "d_")
    out = links.open_rows(parcels).join(texts, "gml_id", "left").join(ov, "gml_id", "left")
    out = out.filter(F.coalesce("t_signaturnummer", F.lit("4115")).isin("4113", "4122") | (F.coalesce("nenner", F.lit("0")) == "0"))
    own = F.coalesce(F.concat(F.col("zaehler").cast("string"), F.lit("/"), F.col("nenner").cast("string")), F.col("zaehler").cast("string"))
    rule = F.when(F.col("abweichenderrechtszustand") == "true", "4122").otherwise("4113")
    return out.select("gml_id", F.coalesce(F.replace("t_schriftinhalt", F.lit("-"), F.lit("/")), own).alias("text"),
                      F.coalesce("t_geom", G.centroid("wkb_geometry")).alias("point"),
                      links.style_priority("d_signaturnummer", "t_signaturnummer", rule).alias("signaturnummer"))


def unstyled(objects: DataFrame, drawn: DataFrame, code: str) -> DataFrame:
    """Objects without a style, counted by code."""
    gone = objects.join(drawn.select("gml_id").distinct(), "gml_id", "left_anti")
    return gone.groupBy(code).agg(F.count(F.lit(1)).alias("n"))


def derive(tables: dict[str, DataFrame], enums: DataFrame, catalogue: DataFrame) -> dict[str, DataFrame]:
    """The four layers from cleaned object tables."""
    sources = {n: t for n, t in tables.items() if n in R.FILLS or n in R.LINES or any(n == s for s, _ in [*R.SYMBOLS, *R.LABELS])}
    objects = unified(sources)
    symbols_, texts, overrides = (placed_links(tables[n]) for n in ("ap_ppo", "ap_pto", "ap_darstellung"))
    points = symbols(objects, symbols_, overrides)
    if "ax_gleis" in tables and "bahnkategorie" in tables["ax_gleis"].columns:
        points = points.unionByName(track_symbols(tables["ax_gleis"]))
    drawn = line_layer(objects)
    if "ax_besondereflurstuecksgrenze" in tables:
        drawn = drawn.unionByName(border_layer(tables["ax_besondereflurstuecksgrenze"]))
    return {"po_polygons": fills(objects), "po_lines": drawn, "po_points": points,
            "po_labels": labels(objects, texts, overrides, enums, catalogue)}
