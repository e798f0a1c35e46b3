"""Directories over all object tables, key tables, style catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import safe_int
from ..operators.lookups import unify

# Derived views that the directory leaves out.
UNION_VIEWS = ("ax_tatsaechlichenutzung", "ax_klassifizierung", "ax_ausfuehrendestellen")
PREFIXES = ("ax_", "ap_", "ks_", "aa_")

# Columns of the style catalogue tables.
STYLE_SCHEMAS = {
    "farben": "id int, name string, r int, g int, b int",
    "flaechen": "katalog int, signaturnummer string, darstellungsprioritaet int, name string, farbe int, randlinie int",
    "linien": "katalog int, signaturnummer string, darstellungsprioritaet int, name string, seite string",
    "linie": "id int, i int, katalog int, signaturnummer string, strichart int, abschluss string, scheitel string, "
             "strichstaerke double, pfeillaenge double, pfeilhoehe double, farbe int",
    "schriften": "katalog int, signaturnummer string, darstellungsprioritaet int, name string, art string, stil string, "
                 "grad_pt int, sperrung_pt int, farbe int",
    "randlinie": "id int, randlinie int, strichart int, abschluss string, scheitel string, strichstaerke double, farbe int",
    "stricharten": "id int, name string", "strichart": "id int, laenge string, einzug double, abstand string",
    "stricharten_i": "id int, stricharten int, i int, strichart int",
    "punkte": "katalog int, signaturnummer string, x0 double, y0 double, x1 double, y1 double",
}


def object_directory(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct (gml_id, beginnt, endet, table_name) over every table with an id."""
    listed = {n: t for n, t in tables.items() if n[:3] in PREFIXES and n not in UNION_VIEWS and "gml_id" in t.columns}
    return unify(listed, lambda n, t: t.select("gml_id", "beginnt", "endet", F.lit(n).alias("table_name")), distinct=True)


def typed_relations(relations: DataFrame, directory: DataFrame) -> DataFrame:
    """Relation rows with the type of both ends."""
    kinds = directory.groupBy("gml_id").agg(F.min("table_name").alias("_t"))
    side = lambda c, out: kinds.select(F.col("gml_id").alias(c), F.col("_t").alias(out))
    return (relations.join(side("beziehung_von", "typ_von"), "beziehung_von", "left")
            .join(side("beziehung_zu", "typ_zu"), "beziehung_zu", "left")
            .select("beziehung_von", "typ_von", "beziehungsart", "beziehung_zu", "typ_zu"))


def key_table(enums: DataFrame, domain: str, short: str | None = None) -> DataFrame:
    """Code, label and documentation of one enumeration domain.

    ``short`` adds the bracketed code of the label: ``last`` takes the last
    bracket, ``quoted`` also strips quotation marks.
    """
    pattern = {"last": r"^.*\((.*)\)$", "quoted": r'^[^(]*\("?([^"]*)"?\)$'}
    cols = [safe_int("code").alias("wert"), F.col("label").alias("bezeichner")]
    if short:
        cols.append(F.regexp_replace("label", pattern[short], "$1").alias("kurz"))
    elif "doc" in enums.columns:
        cols.append(F.col("doc").alias("erklaer"))
    return enums.filter(F.col("domain") == domain).select(*cols)


def typed_styles(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Style catalogue tables (read as text from any source) with their types."""
    out = {}
    for name, df in raw.items():
        fields = [f.strip().rsplit(" ", 1) for f in STYLE_SCHEMAS[name].split(",")]
        out[name] = df.select(*[F.col(c).try_cast(t).alias(c) for c, t in fields if c in df.columns])
    return out


def load_styles(spark, folder: str) -> dict[str, DataFrame]:
    """Style catalogue from one CSV file per table."""
    return typed_styles({n: spark.read.option("header", True).csv(f"{folder}/{n}.csv") for n in STYLE_SCHEMAS})
