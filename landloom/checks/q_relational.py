"""Joins, projections, windows, aggregates and scalar helpers."""

from pyspark.sql import functions as F

from ..functions import arrays as A, fractions as FR, text as T
from ..operators import links, lookups, shares
from .registry import query

def n_rows():
    return F.count(F.lit(1)).alias("n")


# -- joins ----------------------------------------------------------------

@query("j01_link_join", """
SELECT l.oid, p.p_partkey AS pid, p.p_brand AS brand FROM (SELECT oid, unnest(serves) AS pid FROM link WHERE kind <> 'R') l
JOIN part p ON p.p_partkey = l.pid WHERE p.p_size > 10""", ("link",))
def _(d):
    linked = links.link_table(d["link"].filter("kind <> 'R'"), "serves", "pid", ["oid"])
    objects = d["part"].filter("p_size > 10").select(F.col("p_partkey").alias("pid"), F.col("p_brand").alias("brand"))
    return links.link_join(objects, linked, "pid").select("oid", "pid", "brand")


@query("j02_link_table", """
SELECT pid, count(*) AS n, min(oid) AS first_oid FROM (SELECT oid, unnest(serves) AS pid FROM link) l GROUP BY pid""", ("link",))
def _(d):
    return links.link_table(d["link"], "serves", "pid", ["oid"]).groupBy("pid").agg(n_rows(), F.min("oid").alias("first_oid"))


STYLED = """SELECT CAST(p_partkey AS STRING) AS target, p_name AS name, p_size AS size FROM part"""


@query("j03_double_override", """
SELECT s.target, coalesce(o.style, p.style, '4100') AS style, coalesce(p.txt, s.name) AS txt
FROM (""" + STYLED + """) s LEFT JOIN placed p ON p.target = s.target LEFT JOIN override o ON o.target = s.target""",
       ("placed", "override"))
def _(d):
    out = links.override_join(
        d.sql(STYLED), d["placed"].withColumnRenamed("style", "pstyle"),
        d["override"].withColumnRenamed("style", "ostyle"), id_col="target")
    return out.select("target", links.style_priority("ostyle", "pstyle", F.lit("4100")).alias("style"),
                      F.coalesce("txt", "name").alias("txt"))


@query("j04_triple_optional", """
SELECT s.target, coalesce(o.style, p.style, '4100') AS style, coalesce(q.txt, p.txt, s.name) AS txt
FROM (""" + STYLED + """) s LEFT JOIN placed p ON p.target = s.target LEFT JOIN override o ON o.target = s.target
LEFT JOIN (SELECT CAST(l_partkey AS VARCHAR) AS target, max(l_linestatus) AS txt FROM lineitem
           WHERE l_returnflag = 'N' AND l_quantity > 40 GROUP BY 1) q ON q.target = s.target
WHERE p.target IS NULL OR s.size > 25""", ("placed", "override"))
def _(d):
    second = d.sql("""SELECT CAST(l_partkey AS STRING) AS target, max(l_linestatus) AS name_txt FROM lineitem
                      WHERE l_returnflag = 'N' AND l_quantity > 40 GROUP BY 1""")
    out = links.override_join(
        d.sql(STYLED), d["placed"].withColumnRenamed("style", "pstyle").withColumn("has", F.lit(True)),
        d["override"].withColumnRenamed("style", "ostyle"), second, id_col="target")
    return out.filter(F.col("has").isNull() | (F.col("size") > 25)).select(
        "target", links.style_priority("ostyle", "pstyle", F.lit("4100")).alias("style"),
        F.coalesce("name_txt", "txt", "name").alias("txt"))


@query("j05_inner_link", """
SELECT s.target, p.style FROM (""" + STYLED + """) s JOIN placed p ON p.target = s.target""", ("placed",))
def _(d):
    return links.link_join(d.sql(STYLED), d["placed"], "target").select("target", "style")


@query("j06_key_join", """
SELECT c_custkey, o_orderkey, n_name FROM orders JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey WHERE o_totalprice > 300000""")
def _(d):
    o = d["orders"].filter("o_totalprice > 300000")
    return (o.join(d["customer"], F.col("c_custkey") == F.col("o_custkey"))
            .join(d["nation"], F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", "o_orderkey", "n_name"))


@query("j07_left_to_array_key", """
SELECT p_partkey, l.oid FROM part LEFT JOIN (SELECT oid, unnest(serves) AS pid FROM link WHERE kind = 'R') l ON l.pid = p_partkey""", ("link",))
def _(d):
    linked = links.link_table(d["link"].filter("kind = 'R'"), "serves", "p_partkey", ["oid"])
    return links.link_join(d["part"].select("p_partkey"), linked, "p_partkey", "left")


@query("j08_using_left", """
SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN (SELECT n_nationkey AS s_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey < 20) n
USING (s_nationkey) LEFT JOIN region ON r_regionkey = n_regionkey""")
def _(d):
    n = d["nation"].filter("n_nationkey < 20").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    r = d["region"].select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return d["supplier"].join(n, "s_nationkey", "left").join(r, "n_regionkey", "left").select("s_suppkey", "n_name", "r_name")


@query("j10_array_overlap_join", """
SELECT DISTINCT k.oid, r.sn FROM (SELECT l_orderkey AS oid, l_linenumber AS c FROM lineitem) k
JOIN (SELECT * FROM (VALUES ('2016', 1), ('2018', 2), ('2010', 3), ('2010', 5), ('2022', 6)) v(sn, c)) r ON r.c = k.c""")
def _(d):
    rules = d.spark.createDataFrame([("2016", [1]), ("2018", [2]), ("2010", [3, 5]), ("2022", [6])], "sn string, adfs array<int>")
    coded = d["lineitem"].groupBy(F.col("l_orderkey").alias("oid")).agg(F.collect_set("l_linenumber").alias("codes"))
    return links.overlap_join(coded, "codes", rules, "adfs", ["oid", "sn"]).select("oid", "sn")


@query("j11_prefix_join", """
SELECT DISTINCT a.k AS upper_key, b.k AS lower_key FROM
(SELECT 'k' || CAST(n_nationkey % 7 AS VARCHAR) AS k FROM nation) a
JOIN (SELECT 'k' || CAST(n_nationkey % 7 AS VARCHAR) || '_' || CAST(n_nationkey AS VARCHAR) AS k FROM nation) b ON b.k LIKE a.k || '%'""")
def _(d):
    keyed = d["nation"].select(F.concat(F.lit("k"), (F.col("n_nationkey") % 7).cast("string")).alias("upper_key"), "n_nationkey")
    # the county key travels as a column, so the prefix match is an equi join
    lower = keyed.select("upper_key", F.concat_ws("_", "upper_key", F.col("n_nationkey").cast("string")).alias("lower_key"))
    return keyed.select("upper_key").distinct().join(lower, "upper_key")


@query("j12_anti_join", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def _(d):
    o = d["orders"].filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return lookups.missing_keys(d["customer"].select("c_custkey"), o, ["c_custkey"])


@query("j13_semi_join", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def _(d):
    o = d["orders"].filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return lookups.present_keys(d["customer"].select("c_custkey"), o, ["c_custkey"])


@query("j14_label_lookup", """
SELECT s_suppkey, (SELECT min(n_name) FROM nation WHERE n_nationkey = s_nationkey AND n_regionkey < 3) AS label FROM supplier""")
def _(d):
    enums = d["nation"].filter("n_regionkey < 3").select(
        F.lit("nation").alias("domain"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label"))
    return lookups.label_lookup(d["supplier"], enums, "nation", "s_nationkey", "label").select("s_suppkey", "label")


@query("j15_latest_row_lookup", """
SELECT c_custkey, (SELECT o_orderpriority FROM orders WHERE o_custkey = c_custkey
                   ORDER BY o_orderdate DESC, o_orderpriority DESC LIMIT 1) AS latest FROM customer""")
def _(d):
    last = lookups.latest(d["orders"], ["o_custkey"], "o_orderpriority", "o_orderdate", "latest")
    return lookups.lookup(d["customer"].select("c_custkey"), last.withColumnRenamed("o_custkey", "c_custkey"),
                          ["c_custkey"])


@query("j16_any_row_lookup", """
SELECT r_regionkey, (SELECT min(n_name) FROM nation WHERE n_regionkey = r_regionkey) AS nation FROM region""")
def _(d):
    dim = lookups.any_value(d["nation"], ["n_regionkey"], "n_name", "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return lookups.lookup(d["region"].select("r_regionkey"), dim, ["r_regionkey"])


@query("j17_lateral_unnest", """
SELECT o.o_orderkey, l.pid FROM orders o LEFT JOIN (SELECT oid, unnest(serves) AS pid FROM link WHERE len(serves) > 3) l ON l.oid = o.o_orderkey""", ("link",))
def _(d):
    arrays = d["link"].filter(F.size("serves") > 3).select(F.col("oid").alias("o_orderkey"), "serves")
    return d["orders"].select("o_orderkey").join(arrays, "o_orderkey", "left").select(
        "o_orderkey", F.explode_outer("serves").alias("pid"))


@query("j23_parallel_unnest", """
WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS words, string_split(p_type || ' ' || p_brand || ' end', ' ') AS more FROM part),
n AS (SELECT unnest(generate_series(1, 6)) AS i)
SELECT p_partkey, i - 1 AS pos, words[i] AS a, more[i] AS b FROM w JOIN n ON i <= greatest(len(words), len(more))""")
def _(d):
    w = d["part"].select("p_partkey", F.split("p_name", " ").alias("a"),
                         F.split(F.concat_ws(" ", "p_type", "p_brand", F.lit("end")), " ").alias("b"))
    return links.zip_rows(w, ["a", "b"], ["p_partkey"]).withColumn("pos", F.col("pos").cast("long"))


@query("j18_constants_join", """
SELECT k.katalog, s.name, s.katalog * 10 + k.katalog AS code FROM (VALUES (1), (2)) k(katalog)
JOIN (SELECT n_name AS name, n_nationkey AS katalog FROM nation) s ON TRUE""")
def _(d):
    return d["nation"].select(F.explode(F.array(F.lit(1), F.lit(2))).alias("katalog"), F.col("n_name").alias("name"),
                              F.col("n_nationkey").alias("_k")).select("katalog", "name", (F.col("_k") * 10 + F.col("katalog")).alias("code"))


BOOKINGS = """
  SELECT 'O' || CAST(o_orderkey AS STRING) AS booking, 'C' || CAST(o_custkey AS STRING) AS refers, 1 AS num, 2 + o_orderkey % 5 AS den FROM orders
  UNION ALL SELECT DISTINCT 'L' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING), 'O' || CAST(l_orderkey AS STRING), 1, 2 + l_linenumber % 5 FROM lineitem"""

CHAIN = """WITH RECURSIVE b AS (""" + BOOKINGS + """),
walk AS (SELECT 'C' || CAST(c_custkey AS STRING) AS root, 'C' || CAST(c_custkey AS STRING) AS booking, CAST(1 AS BIGINT) AS num, CAST(2 + c_custkey % 5 AS BIGINT) AS den, 0 AS depth FROM customer
         UNION ALL SELECT w.root, b.booking, w.num * b.num, w.den * b.den, w.depth + 1 FROM walk w JOIN b ON b.refers = w.booking)
"""


def chain(d):
    b = d.sql(BOOKINGS)
    roots = d.sql("""SELECT 'C' || CAST(c_custkey AS STRING) AS root, 'C' || CAST(c_custkey AS STRING) AS booking,
                     1 AS num, 2 + c_custkey % 5 AS den FROM customer""")
    return shares.walk(roots, b, booking="booking", refers="refers", num="num", den="den")


@query("j19_recursive_bookings", CHAIN + """
SELECT root, depth, count(*) AS n, CAST(sum(den) AS BIGINT) AS dens FROM walk GROUP BY root, depth""")
def _(d):
    return chain(d).groupBy("root", "depth").agg(n_rows(), F.sum(F.col("den").cast("decimal(38,0)")).cast("long").alias("dens"))


@query("a05_fraction_sum", CHAIN + """,
tot AS (SELECT root, CAST(sum(num * (216000 // den)) AS BIGINT) AS s FROM walk WHERE 216000 % den = 0 GROUP BY root)
SELECT root, CAST(s // gcd(s, 216000) AS VARCHAR) || '/' || CAST(216000 // gcd(s, 216000) AS VARCHAR) AS anteil FROM tot""")
def _(d):
    return FR.sum_fractions(chain(d), ["root"], "num", "den", reduce=True).select("root", "anteil")


# -- projections, predicates, set operations ------------------------------

@query("q01_rule_table_style", """
SELECT p_partkey, (SELECT style FROM (VALUES (1, 10, 1, 2505), (5, 20, 2, 2623), (15, 30, 3, 2030), (25, 45, 4, 2031)) r(lo, hi, prio, style)
   WHERE p_size BETWEEN lo AND hi ORDER BY prio LIMIT 1) AS style FROM part""")
def _(d):
    rules = d.spark.createDataFrame([(1, 10, 1, 2505), (5, 20, 2, 2623), (15, 30, 3, 2030), (25, 45, 4, 2031)],
                                    "lo int, hi int, priority int, style int")
    return lookups.rule_style(d["part"], rules, "p_size").select("p_partkey", "style")


@query("q02_range_buckets", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey BETWEEN 0 AND 499 THEN '1XXX' WHEN l_partkey BETWEEN 500 AND 999 THEN '2XXX'
  WHEN l_partkey BETWEEN 1000 AND 1499 THEN '3XXX' ELSE CAST(l_partkey AS VARCHAR) END AS cls FROM lineitem""")
def _(d):
    ranges = [(0, 499, "1XXX"), (500, 999, "2XXX"), (1000, 1499, "3XXX")]
    cls = F.coalesce(lookups.range_code(F.col("l_partkey"), ranges), F.col("l_partkey").cast("string"))
    return d["lineitem"].select("l_orderkey", "l_linenumber", cls.alias("cls"))


@query("q03_additive_style", "SELECT p_partkey, 25150000 + CASE WHEN p_size > 25 THEN 1406 ELSE 1409 END AS style FROM part")
def _(d):
    return d["part"].select("p_partkey", (F.lit(25150000) + F.when(F.col("p_size") > 25, 1406).otherwise(1409)).alias("style"))


@query("q04_modulus_chain", """
SELECT o_orderkey, CASE WHEN m % 2000 = 0 THEN 2023 WHEN m % 1000 = 0 THEN 2022 WHEN m % 500 = 0 THEN 2021
  WHEN m % 250 = 0 THEN 2020 WHEN m % 50 = 0 THEN 2019 WHEN m % 25 = 0 THEN 2018 END AS style
FROM (SELECT o_orderkey, CAST(round_even(o_totalprice, 0) AS BIGINT) AS m FROM orders) t""")
def _(d):
    m = T.half_even_int("o_totalprice")
    out = None
    for step, style in ((2000, 2023), (1000, 2022), (500, 2021), (250, 2020), (50, 2019), (25, 2018)):
        hit = F.pmod(m, F.lit(step)) == 0
        out = F.when(hit, style) if out is None else out.when(hit, style)
    return d["orders"].select("o_orderkey", out.alias("style"))


@query("q06_prefix_filter", "SELECT p_type, count(*) AS n FROM part WHERE p_brand LIKE 'Brand#1%' AND p_name NOT LIKE 'small%' GROUP BY p_type")
def _(d):
    return (d["part"].filter(F.col("p_brand").startswith("Brand#1") & ~F.col("p_name").startswith("small"))
            .groupBy("p_type").agg(n_rows()))


@query("q07_array_predicates", """
SELECT oid, list_contains(serves, 7) AS has7, list_has_any(serves, [1, 2, 3, 4, 5, 6, 7, 8, 9]) AS hasany, len(serves) = 1 AS single FROM link""", ("link",))
def _(d):
    return d["link"].select("oid", F.array_contains("serves", 7).alias("has7"),
                            A.any_of("serves", *range(1, 10)).alias("hasany"), (F.size("serves") == 1).alias("single"))


@query("q08_inline_mapping", """
SELECT o_orderkey, m.label FROM orders LEFT JOIN (VALUES ('O', 'offen'), ('F', 'fertig')) m(code, label) ON m.code = o_orderstatus""")
def _(d):
    return d["orders"].select("o_orderkey", lookups.mapped(F.col("o_orderstatus"), {"O": "offen", "F": "fertig"}).alias("label"))


UNIFY = {"customer": ("c_custkey", "c_mktsegment", "41001"), "supplier": ("s_suppkey", "s_name", "41002"),
         "part": ("p_partkey", "p_type", "43001")}


@query("q09_unified_view", " UNION ALL ".join(
    f"SELECT {k} * 32 + {i} AS ogc_fid, '{t}' AS name, '{c}' || coalesce(':' || {f}, '') AS code FROM {t}"
    for i, (t, (k, f, c)) in enumerate(UNIFY.items())))
def _(d):
    order = list(UNIFY)

    def shape(name, df):
        key, field, cls = UNIFY[name]
        return df.select((F.col(key) * 32 + order.index(name)).alias("ogc_fid"), F.lit(name).alias("name"),
                         F.concat(F.lit(cls), F.coalesce(F.concat(F.lit(":"), F.col(field)), F.lit(""))).alias("code"))

    return lookups.unify({n: d[n] for n in UNIFY}, shape)


@query("q10_union_distinct", "SELECT s_nationkey AS k FROM supplier UNION SELECT c_nationkey FROM customer WHERE c_acctbal > 5000")
def _(d):
    return d["supplier"].select(F.col("s_nationkey").alias("k")).union(
        d["customer"].filter("c_acctbal > 5000").select("c_nationkey")).distinct()


@query("q11_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(d):
    return d["lineitem"].select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("q12_top_row_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) t WHERE rn = 1""")
def _(d):
    o = d["orders"].select("o_custkey", "o_orderkey", "o_totalprice")
    return lookups.top_per_key(o, ["o_custkey"], [-F.col("o_totalprice"), F.col("o_orderkey")])


@query("q13_ordered_output", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type")
def _(d):
    return d["part"].groupBy("p_type").agg(n_rows()).orderBy(F.desc("n"), "p_type")


@query("q14_density_thinning")
def _(d):
    return lookups.thin(d["part"].select("p_partkey", "p_brand"), ["p_partkey"], F.lit(20))


# -- windows --------------------------------------------------------------

@query("w01_serial_in_sheet", """
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders""")
def _(d):
    return lookups.numbered(d["orders"].select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"],
                            ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "rn")


@query("w02_number_after_count", """
SELECT n_regionkey, n_name, 100 + (SELECT count(*) FROM supplier s JOIN nation n2 ON n2.n_nationkey = s.s_nationkey WHERE n2.n_regionkey = n.n_regionkey)
  + row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS k FROM nation n""")
def _(d):
    have = (d["supplier"].join(d["nation"], F.col("n_nationkey") == F.col("s_nationkey"))
            .groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("have")))
    out = d["nation"].join(have, "n_regionkey", "left")
    return lookups.numbered(out, ["n_regionkey"], ["n_name"], "k", F.coalesce("have", F.lit(0)) + 100).select("n_regionkey", "n_name", "k")


@query("w03_global_number", "SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) AS rn FROM part")
def _(d):
    return lookups.global_number(d["part"].select("p_partkey", "p_name"), ["p_name", "p_partkey"]).select(
        "p_partkey", "rn")


@query("w04_lag_drop_repeats", """
SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) t
WHERE p IS NULL OR p <> event_type""")
def _(d):
    from pyspark.sql import Window
    p = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return d["events"].withColumn("p", p).filter("p IS NULL OR p <> event_type").select("user_id", "event_id", "event_type")


@query("w05_hex_keys", """
SELECT c_custkey, lower(to_hex(row_number() OVER (ORDER BY c_name, c_custkey))) AS pk FROM customer""")
def _(d):
    return lookups.global_number(d["customer"].select("c_custkey", "c_name"), ["c_name", "c_custkey"]).select(
        "c_custkey", T.hex_key("rn").alias("pk"))


# -- aggregates -----------------------------------------------------------

@query("a01_group_aggregates", """
SELECT l_returnflag, l_linestatus, min(l_partkey) AS lo, max(l_partkey) AS hi, count(*) AS n, round(sum(l_quantity), 2) AS qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _(d):
    return d["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(
        F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"), n_rows(), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("a02_joined_distinct", "SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY p_brand")
def _(d):
    return d["part"].groupBy("p_brand").agg(A.joined_set("p_type").alias("types"))


@query("a03_capped_text", """
SELECT p_brand, CASE WHEN length(t) > 196 THEN substr(t, 1, 196) || ' ...' ELSE t END AS names
FROM (SELECT p_brand, string_agg(DISTINCT p_name, ',' ORDER BY p_name) AS t FROM part GROUP BY p_brand) s""")
def _(d):
    return d["part"].groupBy("p_brand").agg(A.joined_set("p_name").alias("t")).select("p_brand", T.capped_list("t").alias("names"))


@query("a04_having", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 6")
def _(d):
    return d["lineitem"].groupBy("l_orderkey").agg(n_rows()).filter("n > 6")


@query("a06_array_concat", """
SELECT kind, CAST(sum(len(serves)) AS BIGINT) AS n, CAST(sum(list_sum(serves)) AS BIGINT) AS s FROM link GROUP BY kind, oid % 50""", ("link",))
def _(d):
    cat = d["link"].groupBy("kind", (F.col("oid") % 50).alias("g")).agg(A.concat_arrays("serves", "oid").alias("a"))
    return cat.select("kind", F.size("a").cast("long").alias("n"), F.aggregate("a", F.lit(0).cast("long"), lambda s, x: s + x).alias("s"))


@query("a07_share_weighted_area", """
SELECT o_custkey, round(sum(floor(o_totalprice) * CASE WHEN d = 0 THEN 1.0 ELSE CAST(1 AS DOUBLE) / d END), 3) AS area
FROM (SELECT *, o_orderkey % 7 AS d FROM orders) t GROUP BY o_custkey""")
def _(d):
    # both sides with 24 more digits: only the columns hold them, no cut text does
    long_ = lambda c: F.concat(c.cast("string"), F.lit("0" * 24))
    whole = (d["orders"].withColumns({"n": long_(F.lit(1)), "d": F.when(F.col("o_orderkey") % 7 != 0, long_(F.col("o_orderkey") % 7)).otherwise("0")})
             .withColumn("flaeche", F.floor("o_totalprice").cast("double")))
    return shares.weighted_area(whole, ["o_custkey"], "flaeche", "n", "d").select(
        "o_custkey", F.round("area", 3).alias("area"))


@query("a08_sorted_set", """
SELECT oid, array_to_string(list_sort(list_distinct(list_transform(serves, lambda x: x % 10))), ',') AS s FROM link""", ("link",))
def _(d):
    return d["link"].select("oid", F.array_join(A.sorted_set(F.transform("serves", lambda x: x % 10)).cast("array<string>"), ",").alias("s"))


@query("a09_tag_histogram", "SELECT tag, count(*) AS n FROM (SELECT unnest(serves) AS tag FROM link) t GROUP BY tag", ("link",))
def _(d):
    return links.tag_counts(d["link"], "serves")


# -- updates as new frames -------------------------------------------------

@query("u01_update_from", """
SELECT c_custkey, coalesce(t.total, c_acctbal) AS bal FROM customer LEFT JOIN
 (SELECT o_custkey, round(max(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) t ON o_custkey = c_custkey""")
def _(d):
    t = d["orders"].filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.max("o_totalprice"), 2).alias("total"))
    return d["customer"].join(t, "c_custkey", "left").select("c_custkey", F.coalesce("total", "c_acctbal").alias("bal"))


@query("u02_cleanup", """
SELECT event_id, nullif(CASE WHEN event_type = 'view' THEN '' ELSE replace(event_type, 'signup', 'Strasse') END, '') AS art,
       nullif(user_id % 5, 0) AS floors, coalesce(CASE WHEN event_id % 3 = 0 THEN 'true' END, 'false') AS flag FROM events""")
def _(d):
    from ..plans.cleanup import normalised
    raw = d["events"].select(
        "event_id", F.when(F.col("event_type") == "view", "").otherwise(F.replace("event_type", F.lit("signup"), F.lit("Straße"))).alias("art"),
        (F.col("user_id") % 5).alias("floors"), F.when(F.col("event_id") % 3 == 0, "true").alias("flag"))
    return normalised(raw, blank=["art"], spelling={"art": {"Straße": "Strasse"}}, zero=["floors"], flags=["flag"])


@query("u03_drop_hidden", "SELECT p_partkey, p_size FROM part WHERE p_size NOT IN (6, 16) AND p_name IS NOT NULL")
def _(d):
    from ..plans.postpass import drop_hidden
    df = d["part"].select("p_partkey", "p_size", F.col("p_size").cast("string").alias("signaturnummer"), F.col("p_name").alias("text"))
    return drop_hidden(df, hidden=("6", "16")).select("p_partkey", "p_size")


@query("u04_insert_or_skip", """
SELECT k, src FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY prio) AS rn FROM (
 SELECT s_nationkey AS k, 'tower' AS src, 0 AS prio FROM supplier WHERE s_acctbal > 8500
 UNION ALL SELECT c_nationkey, 'building', 1 FROM customer WHERE c_acctbal > 9900 UNION ALL SELECT n_nationkey, 'parcel', 2 FROM nation) u) t WHERE rn = 1""")
def _(d):
    s = d["supplier"].filter("s_acctbal > 8500").select(F.col("s_nationkey").alias("k"), F.lit("tower").alias("src"))
    c = d["customer"].filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("k"), F.lit("building").alias("src"))
    n = d["nation"].select(F.col("n_nationkey").alias("k"), F.lit("parcel").alias("src"))
    return lookups.priority_union([s, c, n], ["k"])


# -- scalar helpers ---------------------------------------------------------

@query("x01_safe_int", """
SELECT doc_id, TRY_CAST(trim(t) AS INTEGER) AS n FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN ' ' || CAST(n_chars AS VARCHAR) || ' ' ELSE source END AS t FROM documents) s""")
def _(d):
    t = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" "), F.col("n_chars").cast("string"), F.lit(" "))).otherwise(F.col("source"))
    return d["documents"].select("doc_id", T.safe_int(t).alias("n"))


@query("x02_zero_pad", """
SELECT o_orderkey, CASE WHEN o_orderkey > 9999 THEN '####' ELSE lpad(CAST(o_orderkey AS VARCHAR), 4, '0') END AS k FROM orders""")
def _(d):
    return d["orders"].select("o_orderkey", T.pad_number("o_orderkey", 4).alias("k"))


@query("x03_roman", """
SELECT p_partkey, list_extract(['', 'X', 'XX', 'XXX', 'XL', 'L'], p_size // 10 + 1) || list_extract(['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'], p_size % 10 + 1) AS r FROM part""")
def _(d):
    return d["part"].select("p_partkey", T.roman("p_size").alias("r"))


@query("x04_plain_number", """
SELECT p_partkey, CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
  ELSE rtrim(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '0') END AS t FROM part""")
def _(d):
    return d["part"].select("p_partkey", T.plain_number("p_retailprice").alias("t"))


@query("x05_truncate_dots", """
SELECT p_partkey, CASE WHEN length(p_name) > 10 THEN substr(p_name, 1, 7) || '...' ELSE p_name END AS a, substr(p_name, 1, 3) AS b FROM part""")
def _(d):
    return d["part"].select("p_partkey", T.truncate_dots("p_name", 10).alias("a"), T.truncate_dots("p_name", 3).alias("b"))


@query("x06_append_line", """
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE s_name || chr(10) || s_name END AS a FROM supplier""")
def _(d):
    second = F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name"))
    first = F.when(F.col("s_suppkey") % 3 == 0, F.lit("")).otherwise(F.col("s_name"))
    return d["supplier"].select("s_suppkey", T.append_line(first, F.coalesce(second, F.col("s_name"))).alias("a"))


@query("x07_text_escapes", r"""
SELECT p_partkey, replace(p_name, ' ', chr(10)) AS t, '"' || p_brand || '"' AS q, '(' || p_type || ')' AS b FROM part""")
def _(d):
    return d["part"].select("p_partkey", T.unescape_newlines(F.replace("p_name", F.lit(" "), F.lit("\\n"))).alias("t"),
                            T.quoted("p_brand").alias("q"), T.bracketed("p_type").alias("b"))


@query("x08_dates", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, iso(o_orderdate) AS iso, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS compact FROM orders""")
def _(d):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return d["orders"].select("o_orderkey", F.year("o_orderdate").alias("y"), iso.alias("iso"), T.compact_time(iso).alias("compact"))


@query("x09_rounding", """
SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS e, CAST(round(CAST(l_quantity AS DECIMAL(10,2)) / 2, 0) AS BIGINT) AS a FROM lineitem""")
def _(d):
    return d["lineitem"].select("l_orderkey", "l_linenumber", T.half_even_int(F.col("l_quantity") / 2).alias("e"),
                                T.half_away_int(F.col("l_quantity").cast("decimal(10,2)") / 2).alias("a"))


@query("x10_array_concat_null", """
SELECT oid, len(CASE WHEN kind = 'A' THEN serves ELSE list_concat(serves, serves) END) AS n FROM link WHERE kind <> 'N' OR oid % 2 = 0""", ("link",))
def _(d):
    other = F.when(F.col("kind") != "A", F.col("serves"))
    return d["link"].filter("kind <> 'N' OR oid % 2 = 0").select("oid", F.size(A.arr_cat("serves", other)).cast("long").alias("n"))


@query("x11_series", """
SELECT o_orderkey, i FROM (SELECT o_orderkey, unnest(generate_series(3650, o_orderkey, 6000)) AS i FROM orders) t""")
def _(d):
    ok = F.col("o_orderkey") >= 3650
    return d["orders"].select("o_orderkey", F.explode(F.when(ok, F.sequence(F.lit(3650).cast("long"), F.col("o_orderkey"), F.lit(6000).cast("long")))).alias("i"))


@query("x12_parcel_key", """
SELECT p_partkey, '14' || lpad(CAST(p_size AS VARCHAR), 4, '0') || '-' || lpad(CAST(p_partkey % 12 AS VARCHAR), 3, '0') || '-' ||
  CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_partkey > 9999 THEN '####' ELSE lpad(CAST(p_partkey AS VARCHAR), 4, '0') END || '/' || lpad(CAST(p_size AS VARCHAR), 4, '0')
    WHEN 1 THEN lpad(CAST(p_partkey AS VARCHAR), 5, '0') || '/' || lpad(CAST(p_size AS VARCHAR), 4, '0')
    WHEN 2 THEN lpad(CAST(p_partkey AS VARCHAR), 5, '0') || '/' || 'ABCD'
    ELSE lpad(CAST(p_partkey AS VARCHAR), 5, '0') || '/' || lpad(CAST(p_size AS VARCHAR), 3, '0') END AS k FROM part""")
def _(d):
    state = F.element_at(F.array(*[F.lit(s) for s in ("DESL", "DETH", "DESN", "DENW")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    df = d["part"].select(
        "p_partkey", F.concat(state, F.lit("000000000001")).alias("gml_id"), F.lit("14").alias("land"), F.col("p_size").cast("string").alias("gemarkungsnummer"),
        (F.col("p_partkey") % 12).alias("flurnummer"), F.col("p_partkey").cast("string").alias("zaehler"), F.col("p_size").cast("string").alias("nenner"),
        F.lit("12345678901234ABCD__").alias("flurstueckskennzeichen"))
    return df.select("p_partkey", T.parcel_key().alias("k"))
