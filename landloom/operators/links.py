"""Relations held as arrays of ids, turned into link tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import blank_to_null
from .skew import HOT_ROWS, salted_join


def open_rows(df: DataFrame, end: str = "endet") -> DataFrame:
    """Current snapshot: rows whose lifetime has no end."""
    return df.filter(F.col(end).isNull())


def link_table(df: DataFrame, array: str, target: str = "target", keep: list[str] | None = None,
               trim: bool = False) -> DataFrame:
    """One row per referenced id, so that relation joins are equi joins."""
    keep = keep if keep is not None else [c for c in df.columns if c != array]
    item = F.explode(F.array_distinct(F.col(array))).alias(target)
    out = df.select(*keep, item).filter(F.col(target).isNotNull())
    return out.withColumn(target, F.trim(target)) if trim else out


def placed(table: DataFrame, tags: list[str] | str | None, keep: list[str],
           array: str = "dientzurdarstellungvon", id_col: str = "gml_id", prefix: str = "") -> DataFrame:
    """Open placed objects of the given tags as ``(target, columns)``."""
    rows = open_rows(table)
    if tags is not None:
        tags = [tags] if isinstance(tags, str) else tags
        rows = rows.filter(F.col("art").isin(*tags))
    out = link_table(rows, array, id_col, keep)
    return out.select(id_col, *[F.col(c).alias(prefix + c) for c in keep])


def link_join(objects: DataFrame, linked: DataFrame, id_col: str = "gml_id", how: str = "inner",
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """Objects with the rows that refer to them; many references to one object are spread."""
    if how == "left":
        return objects.join(linked, id_col, "left")
    return salted_join(linked, objects, [id_col], how, hot_rows)


def override_join(objects: DataFrame, *sides: DataFrame, id_col: str = "gml_id") -> DataFrame:
    """Optional placed object and optional style override in one pass per side."""
    for side in sides:
        objects = objects.join(side, id_col, "left")
    return objects


def style_priority(override: Column | str, placed_style: Column | str, rule: Column | str) -> Column:
    """Style override before placed style before rule style; blanks do not count."""
    return F.coalesce(blank_to_null(override), blank_to_null(placed_style),
                      rule if isinstance(rule, Column) else F.col(rule))


def overlap_join(objects: DataFrame, codes: str, rules: DataFrame, rule_codes: str, keys: list[str]) -> DataFrame:
    """Pairs of objects and rules whose code arrays share a member."""
    left = objects.select("*", F.explode(F.array_distinct(F.col(codes))).alias("_code"))
    right = rules.select("*", F.explode(F.array_distinct(F.col(rule_codes))).alias("_code"))
    cols = [c for c in (*objects.columns, *rules.columns)]
    return salted_join(left, right, ["_code"]).dropDuplicates(keys).select(*cols)


def zip_rows(df: DataFrame, arrays: list[str], keep: list[str]) -> DataFrame:
    """Parallel unnest of several arrays; the shorter ones are padded with null."""
    zipped = F.arrays_zip(*[F.coalesce(F.col(a), F.slice(F.array(F.col(a)[0]), 1, 0)).alias(a) for a in arrays])
    return df.select(*keep, F.posexplode(zipped).alias("pos", "_z")).select(
        *keep, "pos", *[F.col(f"_z.{a}").alias(a) for a in arrays])


def tag_counts(df: DataFrame, array: str, tag: str = "tag", n: str = "n") -> DataFrame:
    """Histogram of array members."""
    return df.select(F.explode(array).alias(tag)).groupBy(tag).agg(F.count(F.lit(1)).alias(n))
