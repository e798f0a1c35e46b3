"""Object-like inputs derived from the driver tables.

Each fixture is one SQL text that Spark and DuckDB both understand after the
replacements in ``spark_sql`` / ``duck_sql``; ``{a}//{b}`` style integer
division is written ``idiv(a, b)`` and array literals ``arr(a, b)``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions import geometry as G

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

ISO_SPARK = "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
ISO_DUCK = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')"

FIXTURES: dict[str, str] = {
    # one parcel per part on a 100-wide grid of 10 x 10 cells
    "parcel": """
        SELECT p_partkey AS pid, p_brand AS district, p_size AS psize, p_type AS ptype,
               CAST(100 + p_size AS DOUBLE) AS official,
               CAST(10 * (p_partkey % 100) AS DOUBLE) AS x0, CAST(10 * idiv(p_partkey, 100) AS DOUBLE) AS y0,
               CAST(10 * (p_partkey % 100) + 10 AS DOUBLE) AS x1, CAST(10 * idiv(p_partkey, 100) + 10 AS DOUBLE) AS y1
        FROM part""",
    "usearea": """
        SELECT s_suppkey AS uid, s_nationkey AS code,
               CAST(7 * (s_suppkey % 97) AS DOUBLE) AS x0, CAST(3 * (s_suppkey % 31) AS DOUBLE) AS y0,
               CAST(7 * (s_suppkey % 97) + 25 AS DOUBLE) AS x1, CAST(3 * (s_suppkey % 31) + 15 AS DOUBLE) AS y1
        FROM supplier""",
    "link": """
        SELECT l_orderkey AS oid, array_agg(DISTINCT l_partkey) AS serves, min(l_returnflag) AS kind
        FROM lineitem GROUP BY l_orderkey""",
    # versions of one id per user; equal seconds are merged
    "versions": """
        SELECT gml_id, beginnt, event_id AS ogc_fid, event_type AS typ,
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE nxt END AS endet, nxt, arr('A') AS anlass
        FROM (SELECT *, lead(beginnt) OVER (PARTITION BY gml_id ORDER BY beginnt) AS nxt
              FROM (SELECT 'DESN' || lpad(CAST(user_id AS STRING), 12, '0') AS gml_id, iso(ts) AS beginnt,
                           min(event_id) AS event_id, min(event_type) AS event_type
                    FROM events GROUP BY 1, 2) e) v""",
    # the same chain with planted defects
    "dirty": """
        SELECT gml_id, ogc_fid, beginnt,
               CASE WHEN ogc_fid % 10 = 0 THEN NULL
                    WHEN ogc_fid % 7 = 0 THEN beginnt
                    WHEN ogc_fid % 13 = 0 THEN prv
                    WHEN ogc_fid % 11 = 0 THEN nx2 ELSE nxt END AS endet
        FROM (SELECT *, lead(beginnt, 2) OVER (PARTITION BY gml_id ORDER BY beginnt) AS nx2,
                     lag(beginnt) OVER (PARTITION BY gml_id ORDER BY beginnt) AS prv
              FROM versions) d""",
    # one change per fourth version
    "changes": """
        SELECT ogc_fid AS seq, lower(typ) AS typename,
               CASE WHEN ogc_fid % 20 = 0 THEN gml_id ELSE gml_id || compact(beginnt) END AS featureid,
               CASE ogc_fid % 3 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' ELSE 'replace' END AS context,
               CASE WHEN ogc_fid % 3 = 2 THEN CASE WHEN ogc_fid % 8 = 0 THEN 'true' ELSE 'false' END END AS safetoignore,
               CASE WHEN ogc_fid % 3 = 2 THEN
                    CASE WHEN ogc_fid % 16 = 0 OR nxt IS NULL THEN gml_id ELSE gml_id || compact(nxt) END END AS replacedby,
               CASE WHEN ogc_fid % 3 = 1 THEN arr('U1') END AS anlass,
               CASE WHEN ogc_fid % 3 = 1 AND ogc_fid % 28 <> 0 THEN '2024-12-31T00:00:00Z' END AS endet
        FROM versions WHERE ogc_fid % 4 = 0""",
    # style choice per part: placed object from returned items, override from accepted items
    "placed": """
        SELECT CAST(l_partkey AS STRING) AS target, min(l_linestatus) AS txt, CAST(min(l_linenumber) + 4100 AS STRING) AS style
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey""",
    "override": """
        SELECT CAST(l_partkey AS STRING) AS target, CAST(max(l_linenumber) + 4200 AS STRING) AS style
        FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_partkey""",
    # height per line number, kept per order; vertices (10k, y_{k-1}) and (10k, y_k)
    "steps": """
        SELECT l_orderkey AS oid, l_linenumber AS k, CAST(floor(min(l_quantity)) AS BIGINT) AS y
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
}
DEPENDS = {"dirty": ["versions"], "changes": ["versions"]}


def _idiv(sql: str, repl: str) -> str:
    return re.sub(r"idiv\(([^,()]+|[^,]+?), ([^()]+?)\)", repl, sql)


def spark_sql(sql: str) -> str:
    sql = _idiv(sql, r"(\1 div \2)")
    sql = re.sub(r"iso\(([\w.]+)\)", lambda m: ISO_SPARK.format(m.group(1)), sql)
    sql = re.sub(r"compact\(([\w.]+)\)", r"translate(\1, '-:', '')", sql)
    return sql.replace("array_agg(DISTINCT", "collect_set(").replace("arr(", "array(")


def duck_sql(sql: str) -> str:
    sql = _idiv(sql, r"(\1 // \2)")
    sql = re.sub(r"iso\(([\w.]+)\)", lambda m: ISO_DUCK.format(m.group(1)), sql)
    sql = re.sub(r"compact\(([\w.]+)\)", r"translate(\1, '-:', '')", sql)
    return sql.replace("AS STRING", "AS VARCHAR").replace("arr(", "list_value(")


class Data:
    """Driver tables and fixtures of one folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Run a portable query over driver tables, fixtures and given frames."""
        text = spark_sql(text)
        names = {w for w in re.findall(r"(?i)\b(?:from|join)\s+([a-z_]\w*)", text)}
        for n in names:
            if n in frames:
                frames[n].createOrReplaceTempView(n)
            elif n in TABLES:
                self.raw(n).createOrReplaceTempView(n)
            elif n in FIXTURES:
                self[n].createOrReplaceTempView(n)
        return self.spark.sql(text)

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.raw(name)
        return self.sql(FIXTURES[name])

    def split(self, df: DataFrame) -> DataFrame:
        """Small derived tables in as many pieces as there are cores, like a stored table."""
        return df.repartition(self.spark.sparkContext.defaultParallelism)

    # -- with geometry
    def parcels(self) -> DataFrame:
        return self.split(self["parcel"]).withColumn("geom", G.rectangle("x0", "y0", "x1", "y1"))

    def useareas(self) -> DataFrame:
        return self.split(self["usearea"]).withColumn("geom", G.rectangle("x0", "y0", "x1", "y1"))

    def polylines(self) -> DataFrame:
        """One axis-parallel line per order."""
        from pyspark.sql import functions as F
        steps = self["steps"].groupBy("oid").agg(F.array_sort(F.collect_list(F.struct("k", "y"))).alias("s"))
        base = F.array(F.struct(F.lit(0).alias("k"), F.lit(0).cast("long").alias("y")))
        leg = lambda p, q: F.array(G.vertex(q["k"] * 10, p["y"]), G.vertex(q["k"] * 10, q["y"]))
        legs = F.flatten(F.zip_with(F.concat(base, F.slice("s", 1, F.size("s") - 1)), F.col("s"), leg))
        path = G.let(F.concat(F.array(G.vertex(0, 0)), legs), G.drop_repeated)
        return self.split(steps.select("oid", path.alias("part")))


def with_fixtures(body: str, *names: str) -> str:
    """DuckDB text: needed fixtures as CTEs in front of ``body``."""
    order: list[str] = []

    def need(n):
        for d in DEPENDS.get(n, []):
            need(d)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    if not order:
        return duck_sql(body)
    ctes = ",\n".join(f"{n} AS ({duck_sql(FIXTURES[n])})" for n in order)
    body = duck_sql(body).strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[len('WITH'):]}"
    return f"WITH {ctes}\n{body}"
