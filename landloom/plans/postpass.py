"""Post-pass over the four map layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import arrays as A, geometry as G
from ..operators.links import link_table, open_rows

# Styles that are never drawn.
HIDDEN = ("6000", "RP6000")
# Offsets of the seven symbols of a group.
GROUP_OFFSETS = [(-10, 0), (-5, 5), (-5, -5), (0, 0), (5, 5), (5, -5), (10, 0)]
# Styles drawn as a group of seven symbols.
GROUP_STYLES = (
    "RP3413 RP3415 RP3421 RP3442 RP3444 RP3448 RP3474 RP3476 RP3478 RP3480 RP3481 RP3484 RP3490 "
    "RP3440 RP3441 RP3446 RP3450 RP3452 RP3454 RP3456 RP3458 RP3460 RP3462 RP3470").split()


def drop_hidden(df: DataFrame, hidden: tuple[str, ...] = HIDDEN) -> DataFrame:
    """Rows with a drawable style; labels also need a text."""
    keep = F.col("signaturnummer").isNotNull() & ~F.col("signaturnummer").isin(*hidden)
    if "text" in df.columns:
        keep = keep & F.col("text").isNotNull()
    return df.filter(keep)


def split_style(style: Column, is_fill: Column) -> tuple[Column, Column]:
    """Fill and edge halves of a polygon style number."""
    n = style.try_cast("long")
    low, high = n % 10000, F.floor(n / 10000)
    text = lambda c: c.cast("string")
    fill = (F.when(n.between(1000, 1999), style)
            .when(n > 10000, F.when(low.between(1000, 1999), text(low)).when(high.between(1000, 1999), text(high)))
            .when(n.between(2000, 2999) & is_fill, style))
    edge = (F.when(n.between(2000, 2999), style)
            .when(n > 10000, F.when(low.between(2000, 2999), text(low)).when(high.between(2000, 2999), text(high))))
    digits = style.rlike("^[0-9]+$")
    return F.when(digits, fill), F.when(digits, edge)


def finish_polygons(polygons: DataFrame, fills: DataFrame) -> DataFrame:
    """Split styles, own edge style for outlined fills, models as sets, hidden rows out.

    ``fills`` has ``signaturnummer, randlinie``; it holds a fixed style catalogue.
    """
    outlined = fills.groupBy(F.col("signaturnummer").alias("_sn")).agg(
        F.max(F.col("randlinie").isNotNull()).alias("_outlined"))
    out = polygons.join(F.broadcast(outlined), F.col("signaturnummer") == F.col("_sn"), "left")
    fill, edge = split_style(F.col("signaturnummer"), F.col("_sn").isNotNull())
    given = lambda name, c: F.coalesce(F.col(name), c) if name in polygons.columns else c
    edge = F.when(F.col("_outlined"), F.concat(F.lit("rn"), F.col("signaturnummer"))).otherwise(given("sn_randlinie", edge))
    out = out.withColumns({"sn_flaeche": given("sn_flaeche", fill), "sn_randlinie": edge,
                           "modell": A.sorted_set("modell")})
    return drop_hidden(out.drop("_sn", "_outlined"))


def outline_styles(fills: DataFrame, edges: DataFrame, prefix: str = "rn") -> DataFrame:
    """Line styles cloned from the edges of outlined fills."""
    e = F.broadcast(edges.withColumnRenamed("id", "_edge").withColumnRenamed("farbe", "linienfarbe"))
    return fills.join(e, F.col("randlinie") == F.col("_edge")).select(
        "katalog", F.concat(F.lit(prefix), "signaturnummer").alias("signaturnummer"),
        "strichart", "abschluss", "scheitel", "strichstaerke", F.col("linienfarbe").alias("farbe"))


def finish_points(points: DataFrame) -> DataFrame:
    """Degrees, models as sets, group symbols, hidden rows out."""
    group = F.col("signaturnummer").isin(*GROUP_STYLES)
    first = F.col("point")["parts"][0][0]
    seven = F.array(*[F.array(G.vertex(first["x"] + F.lit(float(dx)), first["y"] + F.lit(float(dy))))
                      for dx, dy in GROUP_OFFSETS])
    spread = G.geom("MULTIPOINT", seven, F.col("point")["srid"])
    out = points.withColumns({
        "drehwinkel_grad": F.degrees("drehwinkel"), "modell": A.sorted_set("modell"),
        "point": F.when(group, spread).otherwise(F.col("point")),
        "signaturnummer": F.when(group, F.substring("signaturnummer", 3, 100)).otherwise(F.col("signaturnummer"))})
    return drop_hidden(out)


def finish_labels(labels: DataFrame) -> DataFrame:
    """Degrees, scale default, line breaks, models as sets, hidden rows out."""
    out = labels.withColumns({
        "drehwinkel_grad": F.degrees("drehwinkel"), "modell": A.sorted_set("modell"),
        "skalierung": F.coalesce("skalierung", F.lit(1.0)),
        "text": F.replace("text", F.lit("\\n"), F.lit("\n"))})
    return drop_hidden(out)


def arrow_heads(lines: DataFrame, line_styles: DataFrame) -> DataFrame:
    """Two strokes at the start of every line whose style ends in an arrow."""
    arrows = line_styles.filter("abschluss = 'Pfeil'").select(
        F.col("signaturnummer").alias("_sn"), (F.col("pfeillaenge") * 0.01).alias("_l"), (F.col("pfeilhoehe") * 0.005).alias("_h"))
    out = lines.join(F.broadcast(arrows), F.col("signaturnummer") == F.col("_sn"))
    part = F.col("line")["parts"][0]
    p0, p1 = part[0], part[1]
    a = -G.azimuth(p0, p1)
    c, s = F.cos(a), F.sin(a)

    def tip(h):
        return G.vertex(p0["x"] + h * c - F.col("_l") * s, p0["y"] + h * s + F.col("_l") * c)

    strokes = F.array(F.array(tip(F.col("_h")), p0, tip(-F.col("_h"))))
    return out.withColumn("line", G.geom("MULTILINESTRING", strokes, F.col("line")["srid"])).drop("_sn", "_l", "_h")


def finish_lines(lines: DataFrame, line_styles: DataFrame) -> DataFrame:
    """Models as sets, arrow heads added, hidden rows out."""
    out = lines.withColumn("modell", A.sorted_set("modell"))
    return drop_hidden(out.unionByName(arrow_heads(out, line_styles)))


def shift_untagged_numbers(layer: DataFrame, texts: DataFrame, column: str, layer_name: str = "ax_flurstueck_nummer",
                           prefix: str = "DERP", dy: float = 3.0) -> DataFrame:
    """Parcel numbers of one state that have a placed text without a tag move north to their own layer."""
    untagged = link_table(open_rows(texts).filter(F.col("art").isNull()), "dientzurdarstellungvon", "gml_id", [])
    hit = layer.join(untagged.distinct().withColumn("_hit", F.lit(True)), "gml_id", "left")
    moves = F.coalesce("_hit", F.lit(False)) & F.col("gml_id").startswith(prefix) & (F.col("layer") == layer_name)
    return hit.withColumns({
        column: F.when(moves, G.translate(column, 0.0, dy)).otherwise(F.col(column)),
        "layer": F.when(moves, F.lit(layer_name + "_rpnoart")).otherwise(F.col("layer"))}).drop("_hit").select(*layer.columns)


def missing_styles(points: DataFrame, lines: DataFrame, polygons: DataFrame, labels: DataFrame,
                   styles: dict[str, DataFrame]) -> DataFrame:
    """Styles in use that no catalogue knows: kind, count, distinct list."""
    def one(kind, df, col_, known):
        used = df.filter(F.col(col_).isNotNull()).groupBy(F.col(col_).cast("string").alias("signaturnummer")).agg(
            F.count(F.lit(1)).alias("n"))
        gone = used.join(F.broadcast(styles[known].select("signaturnummer").distinct()), "signaturnummer", "left_anti")
        return gone.agg(F.sum("n").alias("n"), A.joined_set("signaturnummer").alias("styles")).filter("n > 0").select(
            F.lit(kind).alias("kind"), "n", "styles")

    return (one("Punkt", points, "signaturnummer", "points")
            .unionByName(one("Linien", lines, "signaturnummer", "lines"))
            .unionByName(one("Flächen", polygons, "sn_flaeche", "fills"))
            .unionByName(one("Randlinien", polygons, "sn_randlinie", "lines"))
            .unionByName(one("Beschriftungen", labels, "signaturnummer", "fonts")))


def model_histogram(layers: list[DataFrame], whole: bool = False) -> DataFrame:
    """Objects per model tag, or per whole tag set; every layer counts once."""
    out = None
    for df in layers:
        part = df.select("modell")
        out = part if out is None else out.unionByName(part)
    key = F.array_join("modell", ",") if whole else F.explode("modell")
    return out.select(key.alias("modell")).groupBy("modell").agg(F.count(F.lit(1)).alias("n"))
