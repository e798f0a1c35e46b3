"""Lookups that pick one row per key, and ordered picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage


def latest(df: DataFrame, keys: list[str], value: str, order: str, out: str | None = None) -> DataFrame:
    """Value of the row with the greatest ``order`` per key (ties: greatest value)."""
    best = F.max_by(F.col(value), F.struct(F.col(order), F.col(value)))
    return df.groupBy(*keys).agg(best.alias(out or value))


def any_value(df: DataFrame, keys: list[str], value: str, out: str | None = None) -> DataFrame:
    """One value per key; the smallest one, so the answer never varies."""
    return df.groupBy(*keys).agg(F.min(value).alias(out or value))


def lookup(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Optional match against a table with one row per key; the engine picks broadcast by size."""
    return df.join(dim, keys, "left")


def label_lookup(df: DataFrame, enums: DataFrame, domain: str, code: str, out: str) -> DataFrame:
    """Label of a code in one enumeration domain."""
    dim = (enums.filter(F.col("domain") == domain)
           .groupBy(F.col("code").alias("_code")).agg(F.min("label").alias(out)))
    return df.join(dim, F.col(code).cast("string") == F.col("_code"), "left").drop("_code")


def earliest_wins(df: DataFrame, keys: list[str], begin: str = "beginnt") -> DataFrame:
    """Drop rows for which an earlier one with the same key exists; ties stay.

    The earliest begin per key is a map-side combined aggregate, so a key with
    many rows is never sorted in one task.
    """
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    first = df.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(F.min(begin).alias("_first"))
    cond = F.col(begin) == F.col("_first")
    for k, n in names.items():
        cond = F.col(k).eqNullSafe(F.col(n)) & cond
    return df.join(first, cond, "left_semi")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order (a struct minimum, no sort of whole groups)."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    row = F.struct(*rest)
    return (df.groupBy(*keys).agg(F.min_by(row, ranked).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def running(df: DataFrame, keys: list[str], order: list, value: Column, out: str) -> DataFrame:
    """Running sum of ``value`` per key in ``order``, the own row included.

    Rows are range partitioned by key and order, so a key with many rows spans
    several tasks; each piece is summed on its own and shifted by the totals of
    the pieces of that key before it.  The ranges are checkpointed because both
    uses must see the same pieces.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.withColumn("_v", value).repartitionByRange(parts, *keys, *order)
                         .withColumn("_p", F.spark_partition_id()))
    local = F.sum("_v").over(Window.partitionBy("_p", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    pieces = ranged.groupBy(*keys, "_p").agg(F.sum("_v").alias("_t"))
    before = F.sum("_t").over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    shift = pieces.select(*[F.col(k).alias(n) for k, n in names.items()], F.col("_p").alias("_q"), F.coalesce(before, F.lit(0)).alias("_off"))
    cond = F.col("_p") == F.col("_q")
    for k, n in names.items():
        cond = cond & F.col(k).eqNullSafe(F.col(n))
    return (ranged.withColumn("_l", local).join(shift, cond).withColumn(out, F.col("_l") + F.col("_off"))
            .select(*df.columns, out))


def numbered(df: DataFrame, keys: list[str], order: list, out: str = "rn", start: Column | None = None) -> DataFrame:
    """Running number per key, after ``start``; ``order`` should leave no ties."""
    rows = running(df, keys, order, F.lit(1).cast("long"), out)
    return rows if start is None else rows.withColumn(out, F.col(out) + start)


def global_number(df: DataFrame, order: list[str], out: str = "rn") -> DataFrame:
    """1..n over the whole table in ``order`` without a single-task sort."""
    return numbered(df, [], order, out)


def priority_union(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Insert-or-skip over several sources: the first source that has a key wins."""
    tagged = [s.withColumn("_prio", F.lit(i)) for i, s in enumerate(sources)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    rest = [c for c in out.columns if c not in (*keys, "_prio")]
    return top_per_key(out, keys, [F.col("_prio"), *[F.col(c) for c in rest]]).drop("_prio")


def unify(tables: dict[str, DataFrame], shape, distinct: bool = False) -> DataFrame:
    """Union of typed tables brought to one shape by ``shape(name, df)``."""
    out = None
    for name, df in tables.items():
        part = shape(name, df)
        out = part if out is None else out.unionByName(part)
    return out.distinct() if distinct else out


def missing_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a partner."""
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def present_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a partner."""
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def range_code(c: Column, ranges: list[tuple[int, int, str]]) -> Column:
    """Code by closed ranges, first hit wins."""
    out = None
    for lo, hi, value in ranges:
        out = F.when(c.between(lo, hi), value) if out is None else out.when(c.between(lo, hi), value)
    return out


def mapped(c: Column, values: dict) -> Column:
    """Inline mapping of values, null for others."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def rule_style(df: DataFrame, rules: DataFrame, code: str, out: str = "style") -> DataFrame:
    """Style by rule table ``(lo, hi, priority, style)``: lowest priority among hits.

    The rule table has a fixed, small size; its ranges become one sorted array
    that travels as a single row.
    """
    arr = rules.agg(F.array_sort(F.collect_list(F.struct("priority", "lo", "hi", "style"))).alias("_rules"))
    hit = F.get(F.filter("_rules", lambda r: F.col(code).between(r["lo"], r["hi"])), F.lit(0))
    return (df.withColumn("_one", F.lit(1)).join(F.broadcast(arr.withColumn("_one", F.lit(1))), "_one")
            .withColumn(out, hit["style"]).drop("_one", "_rules"))


def thin(df: DataFrame, keys: list[str], density: Column | str) -> DataFrame:
    """Keep about ``density`` percent of the rows, the same ones on every run."""
    density = F.col(density) if isinstance(density, str) else density
    return df.filter((density >= 100) | (F.pmod(F.xxhash64(*keys), F.lit(100)) < density))


#: Leading characters of an ISO time that cut the points of a key into ranges (year and month).
RANGE_LETTERS = 7


def next_after(requests: DataFrame, points: DataFrame, key: str, at: str, out: str) -> DataFrame:
    """``requests`` with ``out``: the smallest ``at`` of ``points`` of the same key that is greater than ``after``.

    Requests and points are walked together in time order, no request meets all
    points of its key.  Keys are cut into ranges of time, so that a key with very
    many points is spread; what a range does not hold is the first point of the
    next range that holds any.
    """
    cut = lambda c: F.substring(c, 1, RANGE_LETTERS)
    keys = requests.select(key).distinct()
    points = points.select(key, F.col(at).alias("_t")).filter(F.col(at).isNotNull()).join(keys, key, "left_semi")
    both = requests.select(key, F.col("after").alias("_t"), F.struct(*requests.columns).alias("_row")).unionByName(points, allowMissingColumns=True)
    # backwards in time; at one time requests come before points, so that only later points lie behind a request
    back = lambda *order: Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    later_points = F.min(F.when(F.col("_row").isNull(), F.col("_t")))
    within = (both.withColumn("_part", cut("_t"))
              .withColumn("_next", later_points.over(back(F.col("_t").desc(), F.col("_row").isNull()).partitionBy(key, "_part")))
              .filter(F.col("_row").isNotNull()).select("_row", F.col(key).alias("_key"), "_part", "_next"))
    firsts = points.groupBy(key, cut("_t").alias("_part")).agg(F.min("_t").alias("_first")).unionByName(
        requests.select(key, cut("after").alias("_part")).distinct(), allowMissingColumns=True)
    later = (firsts.groupBy(key, "_part").agg(F.min("_first").alias("_first"))
             .withColumn("_later", F.min("_first").over(back(F.col("_part").desc()).partitionBy(key)))
             .select(F.col(key).alias("_key"), "_part", "_later"))
    return within.join(later, ["_key", "_part"], "left").select("_row.*", F.coalesce("_next", "_later").alias(out))
