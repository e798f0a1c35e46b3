"""Jobs on lines: symbols at intervals, end points, borders, merging."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import arrays as A, geometry as G


def line_parts(df: DataFrame, geom: str, keep: list[str], out: str = "part") -> DataFrame:
    """One row per single line of a line geometry."""
    return df.filter(G.is_line(geom)).select(*keep, F.posexplode(F.col(geom)["parts"]).alias("part_no", out))


def reading_angle(part: Column, fraction: Column) -> Column:
    """Direction of the line at a fraction, from two close points, counter-clockwise from east."""
    before = G.interpolate(part, fraction * 0.9999)
    after = G.interpolate(part, F.when(fraction == 0, 0.001).when(fraction * 1.0001 > 1, 1.0).otherwise(fraction * 1.0001))
    sight = F.struct(before.alias("a"), after.alias("b"))
    return F.lit(0.5 * math.pi) - G.let(sight, lambda s: G.azimuth(s["a"], s["b"]))


def _measured(part: Column) -> Column:
    """Edges with the distance of their start from the start of the line."""
    zero = F.slice(F.array(F.struct(*[F.lit(0.0).alias(n) for n in ("ax", "ay", "bx", "by", "s", "ln")])), 1, 0)

    def add(acc, e):
        before = F.when(F.size(acc) > 0, F.element_at(acc, -1)["s"] + F.element_at(acc, -1)["ln"]).otherwise(0.0)
        return F.concat(acc, F.array(F.struct(
            e["a"]["x"].alias("ax"), e["a"]["y"].alias("ay"), e["b"]["x"].alias("bx"), e["b"]["y"].alias("by"),
            before.alias("s"), G.seg_length(e).alias("ln"))))

    return F.aggregate(G.segments(part), zero, add)


def symbols_along(df: DataFrame, part: str, keep: list[str], start_mm: Column | int, step_mm: Column | int,
                  unit: Column | None = None, angles: bool = True) -> DataFrame:
    """Symbols every ``step_mm`` from ``start_mm`` on: ``k, x, y, drehwinkel``.

    The line is cut into measured edges and every edge makes its own symbols, in
    the row of the line, so nothing is shuffled.  The angle is that of the edge
    unless one of the two sighting points lies on another edge.  ``unit`` keeps
    the symbols on offsets that this wider spacing also hits.
    """
    start = (start_mm if isinstance(start_mm, Column) else F.lit(start_mm)).cast("long")
    step = (step_mm if isinstance(step_mm, Column) else F.lit(step_mm)).cast("long")
    rows = df.withColumn("_start", start).withColumn("_step", step).filter(F.col("_step").isNotNull())
    rows = rows.withColumn("_es", _measured(F.col(part)))
    last = F.element_at("_es", -1)
    rows = rows.filter(F.size("_es") > 0).withColumn("_len", last["s"] + last["ln"])
    rows = rows.select(*dict.fromkeys([*keep, part]), "_start", "_step", "_len", F.inline("_es"))
    # symbol numbers with s < start + k * step <= s + ln; the first edge also takes offset 0
    n0, n1 = F.col("s") * 1000.0, F.least((F.col("s") + F.col("ln")) * 1000.0, F.floor(F.col("_len") * 1000.0))
    lo = F.floor((n0 - F.col("_start")) / F.col("_step")).cast("long") + 1
    lo = F.greatest(F.when((F.col("s") == 0) & (F.col("_start") == 0), 0).otherwise(lo), F.lit(0).cast("long"))
    hi = F.floor((n1 - F.col("_start")) / F.col("_step")).cast("long")
    rows = (rows.filter("ln > 0").withColumn("_lo", lo).withColumn("_hi", hi).filter("_lo <= _hi")
            .withColumn("k", F.explode(F.sequence("_lo", "_hi"))))
    if unit is not None:
        rows = rows.filter(F.pmod(F.col("k") * F.col("_step"), unit) == 0)
    off = (F.col("_start") + F.col("k") * F.col("_step")) / 1000.0
    t = F.least((F.col("_o") - F.col("s")) / F.col("ln"), F.lit(1.0))
    rows = rows.withColumn("_o", off).withColumn("x", F.col("ax") + (F.col("bx") - F.col("ax")) * t).withColumn(
        "y", F.col("ay") + (F.col("by") - F.col("ay")) * t)
    if not angles:
        return rows.select(*keep, "k", "x", "y")
    same = ((F.col("_o") * 0.9999 >= F.col("s")) & (F.col("_o") > 0)
            & (F.least(F.col("_o") * 1.0001, F.col("_len")) <= F.col("s") + F.col("ln")))
    edge = F.lit(0.5 * math.pi) - G.azimuth(G.vertex("ax", "ay"), G.vertex("bx", "by"))
    angle = F.when(same, edge).otherwise(reading_angle(F.col(part), F.col("_o") / F.col("_len")))
    return rows.select(*keep, "k", "x", "y", angle.alias("drehwinkel"))


def alternating(df: DataFrame, offset: float, k: str = "k") -> DataFrame:
    """Moves every second symbol to the other side of its line."""
    side = F.when(F.col(k) % 2 == 0, F.lit(offset)).otherwise(F.lit(-offset))
    return df.withColumn("x", F.col("x") - side * F.sin("drehwinkel")).withColumn("y", F.col("y") + side * F.cos("drehwinkel"))


def end_points(df: DataFrame, part: str, keep: list[str]) -> DataFrame:
    """Both ends of each line with the direction into the line."""
    p = F.col(part)
    n = F.size(p)
    ends = F.array(
        F.struct(F.lit("start").alias("which"), p[0].alias("v"), G.azimuth(p[0], p[1]).alias("azimut")),
        F.struct(F.lit("end").alias("which"), F.get(p, n - 1).alias("v"), G.azimuth(F.get(p, n - 1), F.get(p, n - 2)).alias("azimut")))
    return df.filter(n >= 2).select(*keep, F.inline(ends)).select(
        *keep, "which", F.col("v.x").alias("x"), F.col("v.y").alias("y"), "azimut")


def merge_lines(df: DataFrame, keys: list[str], geom: str, out: str = "line", srid: int = 25832) -> DataFrame:
    """Lines of a key as one multi line; equal lines once, repeated vertices dropped.

    Direction does not count when lines are compared.
    """
    parts = df.select(*keys, F.explode(F.col(geom)["parts"]).alias("_p")).select(*keys, G.drop_repeated(F.col("_p")).alias("_p"))
    parts = parts.filter(F.size("_p") >= 2).select(*keys, F.least(F.col("_p"), F.reverse("_p")).alias("_p")).distinct()
    return parts.groupBy(*keys).agg(G.geom("MULTILINESTRING", F.array_sort(F.collect_list("_p")), srid).alias(out))


def chain_lines(df: DataFrame, keys: list[str], part: str) -> DataFrame:
    """Lines of a key joined where exactly two meet; ``chain`` names the joined line.

    Labels spread over shared end points by joins until nothing changes, so the
    lines of a key are never collected.
    """
    from ..session import cut_lineage
    p = F.col(part)
    ends = F.array(p[0], F.get(p, F.size(p) - 1))
    lines = df.select(*keys, F.least(p, F.reverse(p)).alias(part)).distinct()
    node = lines.select(*keys, part, F.explode(F.array_distinct(ends)).alias("_v"))
    meets = node.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"), F.min(part).alias("_a"), F.max(part).alias("_b")).filter("_n = 2")
    link = meets.select(*keys, F.col("_a").alias("_x"), F.col("_b").alias("_y"))
    both = cut_lineage(link.unionByName(link.select(*keys, F.col("_y").alias("_x"), F.col("_x").alias("_y"))))
    label = cut_lineage(lines.withColumn("chain", F.col(part)))
    while True:
        seen = both.join(label.select(*keys, F.col(part).alias("_y"), F.col("chain").alias("_c")), [*keys, "_y"]).groupBy(
            *keys, F.col("_x").alias(part)).agg(F.min("_c").alias("_c"))
        step = label.join(seen, [*keys, part], "left")
        # jump to the label of the label as well, which halves the way each round
        nxt = step.select(*keys, part, F.least("chain", "_c").alias("chain"), (F.col("_c") < F.col("chain")).alias("_moved"))
        hop = nxt.select(*keys, F.col(part).alias("chain"), F.col("chain").alias("_h"))
        nxt = cut_lineage(nxt.join(hop, [*keys, "chain"], "left").select(
            *keys, part, F.least("chain", "_h").alias("chain"), "_moved"))
        label = nxt.drop("_moved")
        if nxt.filter("_moved").isEmpty():
            return label


def border_sets(df: DataFrame, geom: str, fid: str, gml_id: str, codes: str, models: Column) -> DataFrame:
    """Equal border geometries once, with all codes and models."""
    p = F.col(geom)["parts"][0]
    usable = (G.npoints(geom) > 3) | (p[0] != F.get(p, F.size(p) - 1))
    src = df.filter(usable).select(fid, gml_id, F.col(codes).alias("_c"), models.alias("_m"), F.col(geom))
    return src.groupBy(geom).agg(F.min(fid).alias(fid), F.min(gml_id).alias(gml_id),
                                 A.sorted_set(F.flatten(F.collect_set("_c"))).alias(codes),
                                 A.sorted_set(F.flatten(F.collect_set("_m"))).alias("modell"))
