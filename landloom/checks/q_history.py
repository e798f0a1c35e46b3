"""Version history queries."""

from pyspark.sql import functions as F

from ..operators import history as H, links, lookups
from .registry import query

DELIVERED = "2025-01-01T00:00:00Z"

# the records of an id one after the other, each with the begins that are open before it
WALK = """RECURSIVE
ch AS (SELECT c.*, substr(featureid, 1, 16) AS id, row_number() OVER (PARTITION BY substr(featureid, 1, 16) ORDER BY seq) AS k FROM changes c),
last AS (SELECT gml_id AS lid, max(beginnt) AS last_begin FROM versions GROUP BY gml_id),
facts AS (SELECT ch.*, v.beginnt AS long_begin, sx.beginnt AS succ, last_begin
          FROM ch LEFT JOIN versions v ON v.ogc_fid = ch.seq AND length(featureid) = 32
          LEFT JOIN versions sx ON length(replacedby) = 32 AND replacedby <> featureid AND sx.gml_id || compact(sx.beginnt) = replacedby
          LEFT JOIN last ON lid = substr(replacedby, 1, 16)),
walk AS (
  SELECT gml_id AS wid, CAST(0 AS BIGINT) AS wk, coalesce(list(beginnt ORDER BY beginnt) FILTER (endet IS NULL), []) AS opens,
         CAST(NULL AS BIGINT) AS wseq, CAST(NULL AS STRING) AS target_begin, CAST(NULL AS STRING) AS status FROM versions GROUP BY gml_id
  UNION ALL
  SELECT wid, wk, CASE WHEN status = 'applied' THEN list_filter(opens, lambda o: o <> t) ELSE opens END, seq, t, status
  FROM (SELECT *, {status} AS status
        FROM (SELECT wid, k AS wk, opens, facts.*, CASE WHEN length(featureid) = 32 THEN long_begin ELSE opens[1] END AS t
              FROM walk JOIN facts ON id = wid AND k = wk + 1) s) r),
tg AS (SELECT facts.*, target_begin, status FROM walk JOIN facts ON seq = wseq)
"""
TARGETS = WALK.format(status="""
  CASE WHEN t IS NULL OR (context = 'update' AND endet IS NULL) THEN 'error'
       WHEN context = 'replace' AND succ IS NULL AND NOT coalesce(last_begin > t, FALSE) THEN
            CASE WHEN safetoignore = 'false' AND featureid <> replacedby THEN 'error' ELSE 'ignored' END
       ELSE 'applied' END""")
KILLED = WALK.format(status="CASE WHEN t IS NULL THEN 'error' WHEN context = 'replace' AND featureid = replacedby THEN 'ignored' ELSE 'applied' END")

PLAN = TARGETS + """,
done AS (SELECT *, CASE context WHEN 'delete' THEN '2025-01-01T00:00:00Z' WHEN 'update' THEN endet
                   ELSE coalesce(succ, (SELECT min(b.beginnt) FROM versions b WHERE b.gml_id = substr(replacedby, 1, 16) AND b.beginnt > target_begin)) END AS new_end
         FROM tg)
"""
CLOSED = PLAN + """,
closing AS (SELECT id, target_begin, arg_max(new_end, seq) AS new_end, count(CASE WHEN context = 'update' THEN 1 END) AS upd
            FROM done WHERE status = 'applied' GROUP BY id, target_begin)
SELECT v.gml_id, v.beginnt, coalesce(c.new_end, v.endet) AS endet, 'A' || repeat(',U1', coalesce(upd, 0)) AS reasons
FROM versions v LEFT JOIN closing c ON c.id = v.gml_id AND c.target_begin = v.beginnt"""


def versions(d):
    return d["versions"].select("gml_id", "ogc_fid", "typ", "beginnt", "endet", "anlass")


@query("h01_current_snapshot", "SELECT gml_id, beginnt, typ FROM versions WHERE endet IS NULL", ("versions",))
def _(d):
    return links.open_rows(d["versions"]).select("gml_id", "beginnt", "typ")


@query("h02_resolve_target", "WITH " + TARGETS + """
SELECT seq, target_begin, CASE WHEN target_begin IS NULL THEN 'no open version' WHEN context = 'update' AND endet IS NULL THEN 'no end given' END AS problem
FROM tg""", ("changes",))
def _(d):
    return H.resolve_targets(d["changes"], versions(d)).select("seq", "target_begin", "problem")


def planned(d, context):
    return (H.plan_changes(d["changes"], versions(d), DELIVERED).filter(F.col("context") == context)
            .select("seq", "status", F.when(F.col("status") == "applied", F.col("new_end")).alias("new_end")))


for _id, _ctx in (("h03_apply_delete", "delete"), ("h04_apply_update", "update"), ("h05_apply_replace", "replace")):
    query(_id, "WITH " + PLAN + f"""
    SELECT seq, status, CASE WHEN status = 'applied' THEN new_end END AS new_end FROM done
    WHERE context = '{_ctx}'""", ("changes",))(lambda d, c=_ctx: planned(d, c))


@query("h06_unmatched_fallback", """
WITH RECURSIVE ghosts AS (SELECT ogc_fid AS seq, gml_id AS id, CASE ogc_fid % 3 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' ELSE 'replace' END AS context,
                       row_number() OVER (PARTITION BY gml_id ORDER BY ogc_fid) AS k
                FROM versions WHERE ogc_fid % 9 < 4 AND nxt IS NOT NULL),
kept AS (SELECT *, row_number() OVER (PARTITION BY gml_id ORDER BY beginnt DESC) AS r FROM versions),
base AS (SELECT gml_id, beginnt, CASE WHEN r <= 1 + CAST(substr(gml_id, 14) AS INT) % 3 THEN NULL ELSE nxt END AS endet FROM kept),
walk AS (
  SELECT gml_id AS wid, CAST(0 AS BIGINT) AS wk, coalesce(list(beginnt ORDER BY beginnt) FILTER (endet IS NULL), []) AS opens,
         CAST(NULL AS BIGINT) AS seq, CAST(NULL AS STRING) AS status, CAST(NULL AS STRING) AS close_begin FROM base GROUP BY gml_id
  UNION ALL
  SELECT wid, wk, CASE WHEN status = 'applied' THEN opens[2:] ELSE opens END, seq, status, CASE WHEN status = 'applied' THEN opens[1] ELSE '1999-01-01T00:00:00Z' END
  FROM (SELECT wid, k AS wk, opens, g.seq, CASE WHEN (len(opens) = 0 AND context <> 'replace') OR (len(opens) = 1 AND context = 'replace') THEN 'ignored'
               WHEN len(opens) = 2 THEN 'applied' ELSE 'unresolved' END AS status FROM walk JOIN ghosts g ON id = wid AND k = wk + 1) s)
SELECT seq, status, close_begin FROM walk WHERE wk > 0""", ("versions",))
def _(d):
    v = d["versions"]
    kind = F.when(F.col("ogc_fid") % 3 == 0, "delete").when(F.col("ogc_fid") % 3 == 1, "update").otherwise("replace")
    ghosts = v.filter("ogc_fid % 9 < 4 AND nxt IS NOT NULL").select(
        F.col("ogc_fid").alias("seq"), F.concat("gml_id", F.lit("19990101T000000Z")).alias("featureid"),
        kind.alias("context"), F.when(F.col("ogc_fid") % 3 == 2, "true").alias("safetoignore"),
        F.when(F.col("ogc_fid") % 3 == 2, F.concat("gml_id", F.translate("nxt", "-:", ""))).alias("replacedby"),
        "anlass", F.lit("2024-12-31T00:00:00Z").alias("endet"))
    base = d.sql("""
        SELECT gml_id, beginnt, anlass, CASE WHEN r <= 1 + CAST(substr(gml_id, 14) AS INT) % 3 THEN NULL ELSE nxt END AS endet
        FROM (SELECT *, row_number() OVER (PARTITION BY gml_id ORDER BY beginnt DESC) AS r FROM versions) k""")
    return H.plan_changes(ghosts, base, DELIVERED).select("seq", "status", "close_begin")


@query("h07_kill_mode", "WITH " + KILLED + """
SELECT v.gml_id, v.beginnt FROM versions v WHERE NOT EXISTS
  (SELECT 1 FROM tg WHERE tg.id = v.gml_id AND tg.target_begin = v.beginnt AND status = 'applied')""", ("changes",))
def _(d):
    return H.apply_changes(d["changes"], versions(d), DELIVERED, keep_history=False).select("gml_id", "beginnt")


@query("h08_purge_ended", "SELECT typ, count(*) AS n FROM versions WHERE endet IS NULL GROUP BY typ", ("versions",))
def _(d):
    return H.purge_ended(d["versions"]).groupBy("typ").agg(F.count(F.lit(1)).alias("n"))


@query("h09_apply_with_history", "WITH " + CLOSED, ("changes",))
def _(d):
    out = H.apply_changes(d["changes"], versions(d), DELIVERED, keep_history=True)
    return out.select("gml_id", "beginnt", "endet", F.array_join("anlass", ",").alias("reasons"))


@query("h10_earliest_version_wins", """
SELECT o_custkey, o_orderkey FROM (SELECT *, min(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) t
WHERE o_orderdate = m""")
def _(d):
    return lookups.earliest_wins(d["orders"], ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey")


@query("h11_several_open", """
SELECT gml_id, count(*) AS n FROM dirty WHERE endet IS NULL GROUP BY gml_id HAVING count(*) > 1""", ("dirty",))
def _(d):
    return H.several_open(d["dirty"])


@query("h12_begin_not_before_end", "SELECT gml_id, beginnt, endet FROM dirty WHERE beginnt >= endet", ("dirty",))
def _(d):
    return H.begin_not_before_end(d["dirty"]).select("gml_id", "beginnt", "endet")


@query("h13_overlapping_lifetimes", """
SELECT a.gml_id, count(*) AS pairs FROM dirty a JOIN dirty b ON a.gml_id = b.gml_id AND a.ogc_fid < b.ogc_fid
  AND a.beginnt < b.endet AND a.endet > b.beginnt GROUP BY a.gml_id""", ("dirty",))
def _(d):
    return H.overlapping(d["dirty"])


@query("v08_chain_report", """
SELECT 'several open' AS check_name, count(*) AS n FROM
  (SELECT gml_id FROM dirty WHERE endet IS NULL GROUP BY gml_id HAVING count(*) > 1) s
UNION ALL SELECT 'begin not before end', count(*) FROM dirty WHERE beginnt >= endet
UNION ALL SELECT 'overlapping lifetimes', count(*) FROM dirty a JOIN dirty b
  ON a.gml_id = b.gml_id AND a.ogc_fid <> b.ogc_fid AND a.beginnt < b.endet AND a.endet > b.beginnt""", ("dirty",))
def _(d):
    return H.chain_report(d["dirty"])


@query("s06_insert_only_dedupe", """
SELECT gml_id, beginnt, ogc_fid FROM versions WHERE ogc_fid % 3 <> 0""", ("versions",))
def _(d):
    v = d["versions"].select("gml_id", "beginnt", "ogc_fid")
    stored = v.filter("ogc_fid % 3 = 0")
    return H.drop_known(v.unionByName(v), stored)
