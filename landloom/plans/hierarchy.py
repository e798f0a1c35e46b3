"""Parcels dissolved to sections, districts, municipalities and counties."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import geometry as G
from ..operators import areas, links

# Key columns, simplify tolerance and style per level.
LEVELS = {
    "flur": (["land", "gemarkung", "flur"], 0.5, "pg-flur"),
    "gemarkung": (["land", "gemarkung"], 2.2, "pg-gemarkung"),
    "gemeinde": (["land", "bezirk", "kreis", "gemeinde"], 5.0, "pg-gemeinde"),
    "kreis": (["land", "bezirk", "kreis"], 7.0, "pg-kreis"),
}
THEME = "Politische Grenzen"


def keyed(parcels: DataFrame) -> DataFrame:
    """Open parcels with the keys of all levels as columns."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return links.open_rows(parcels).select(
        "gml_id", F.col("gemeindezugehoerigkeit_land").alias("land"), F.col("gemarkungsnummer").alias("gemarkung"),
        F.coalesce(F.col("flurnummer").cast("string"), F.lit("0")).alias("flur"),
        text("gemeindezugehoerigkeit_regierungsbezirk").alias("bezirk"), text("gemeindezugehoerigkeit_kreis").alias("kreis"),
        text("gemeindezugehoerigkeit_gemeinde").alias("gemeinde"), F.col("wkb_geometry").alias("geom"))


def outlines(parcels: DataFrame, level: str, node: bool = True, **kw) -> DataFrame:
    """Outline edges of one level straight from the parcels' edges.

    Each level is one aggregation of edges, so an upper level does not wait for
    the polygons of a lower one.
    """
    return areas.boundary_edges(keyed(parcels), LEVELS[level][0], "geom", node=node, **kw)


def polygons(parcels: DataFrame, level: str, model: str = "abgeleitet", **kw) -> DataFrame:
    """Polygon layer of one level."""
    keys, tolerance, style = LEVELS[level]
    src = keyed(parcels)
    shape = areas.dissolve(src, keys, "geom", **kw)
    ids = src.groupBy(*keys).agg(F.min("gml_id").alias("gml_id"))
    return shape.join(ids, keys).select(
        "gml_id", F.lit(THEME).alias("thema"), F.concat(F.lit(f"ax_flurstueck_{level}_"), *keys).alias("layer"),
        areas.simplify("polygon", tolerance).alias("polygon"), F.lit(style).alias("signaturnummer"),
        F.lit(style).alias("sn_randlinie"), F.array(F.lit(model)).alias("modell"), *keys)


def names(level_polygons: DataFrame, dim: DataFrame, keys: list[str], name: str, fallback: str) -> DataFrame:
    """Labels of one level at a point inside; a missing name is written from the key."""
    best = dim.groupBy(*keys).agg(F.min(name).alias("_name"))
    missing = F.concat(F.lit(f"({fallback} "), *keys, F.lit(")"))
    return level_polygons.join(best, keys, "left").select(
        "gml_id", "thema", "layer", G.point_on_surface("polygon").alias("point"),
        F.coalesce("_name", missing).alias("text"), "signaturnummer", F.lit(0.0).alias("drehwinkel"), "modell")


def section_labels(sections: DataFrame) -> DataFrame:
    return sections.select("gml_id", "thema", "layer", G.point_on_surface("polygon").alias("point"),
                           F.concat(F.lit("Flur "), "flur").alias("text"), "signaturnummer", F.lit(0.0).alias("drehwinkel"), "modell")
