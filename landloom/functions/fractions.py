"""Ownership fractions of any length, held as decimal texts.

Numerators and denominators have no limit of digits.  Sums split a numerator
into limbs of ``LIMB`` digits that are added up with map-side combine; products
and common denominators are whole numbers of Python in Arrow batches, one per
group of bounded size or per row that outgrows a decimal.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut_lineage, stored

NUM = "decimal(38,0)"
LIMB = 18
#: Denominators folded by one row.
FOLD = 500


def _whole(text) -> int:
    if sys.get_int_max_str_digits():
        sys.set_int_max_str_digits(0)
    return int(text)


def digits(value: Column, kind: str) -> Column:
    """A whole number of type ``kind`` as text; texts stay as they are."""
    return value if kind == "string" else value.cast(NUM).cast("string")


@F.pandas_udf(T.StringType())
def times(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else str(_whole(x) * _whole(y)) for x, y in zip(a, b)], dtype=object)


FRACTION = T.StructType([T.StructField("n", T.StringType()), T.StructField("d", T.StringType())])


def _written(sums: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame([(str(n), str(d)) for n, d in sums], columns=["n", "d"])


def _lowest(n: int, d: int) -> tuple[int, int]:
    g = math.gcd(n, d) or 1
    return n // g, d // g


@F.pandas_udf(FRACTION)
def _folded(parts: pd.Series, reduce: pd.Series) -> pd.DataFrame:
    """Sum of limbs (d, i, s): equal denominators add, others cross-multiply, smallest first."""
    out = []
    for group, lowest in zip(parts, reduce):
        by_den: dict[int, int] = {}
        for f in group:
            q = _whole(f["d"])
            by_den[q] = by_den.get(q, 0) + _whole(f["s"]) * 10 ** (LIMB * f["i"])
        n, d = 0, 1
        for q, p in sorted(by_den.items()):
            n, d = (n + p, d) if q == d else (n * q + p * d, d * q)
        out.append(_lowest(n, d) if lowest else (n, d))
    return _written(out)


@F.pandas_udf(FRACTION)
def _added(pairs: pd.Series, reduce: pd.Series) -> pd.DataFrame:
    """Sum of the one or two fractions of each row."""
    out = []
    for group, lowest in zip(pairs, reduce):
        n, d = 0, 1
        for f in group:
            p, q = _whole(f["n"]), _whole(f["d"])
            n, d = n * q + p * d, d * q
        out.append(_lowest(n, d) if lowest else (n, d))
    return _written(out)


def _limbs(n: Column) -> Column:
    """Limbs of a decimal text, lowest first, each with its sign."""
    sign = F.when(n.startswith("-"), F.lit(-1)).otherwise(1)
    bare = F.ltrim(n, F.lit("-"))
    count = F.ceil(F.char_length(bare) / LIMB).cast("int")
    padded = F.lpad(bare, count * LIMB, F.lit("0"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: sign * F.substring(padded, (count - 1 - i) * LIMB + 1, F.lit(LIMB)).cast("long"))


def as_text(f: Column) -> Column:
    return F.concat_ws("/", f["n"], f["d"])


def limb_sums(df: DataFrame, keys: list[str], num: str, den: str) -> DataFrame:
    """Numerators of ``num/den`` added up per key and denominator ``_d``: limb ``_i`` and its sum ``_p``."""
    kind = dict(df.dtypes)
    text = lambda c: F.coalesce(digits(F.col(c), kind[c]), F.lit("1"))
    each = df.select(*keys, text(den).alias("_d"), F.posexplode(_limbs(text(num))).alias("_i", "_p"))
    return each.groupBy(*keys, "_d", "_i").agg(F.sum(F.col("_p").cast("decimal(20,0)")).cast(NUM).alias("_p"))


def sum_fractions(df: DataFrame, keys: list[str], num: str, den: str,
                  out: str = "anteil", reduce: bool = False) -> DataFrame:
    """Sum ``num/den`` per key: the text ``out`` and the struct ``out``_parts (n, d texts).

    A missing numerator or denominator counts as 1.  Equal denominators are
    summed first (with map-side combine) and the sums stored.  A key with at most
    ``FOLD`` of them is folded by one row.  The denominators of any other key are
    dealt over parts of about ``FOLD``, which are folded and then added two by
    two; with ``reduce`` every sum on the way is cut to its lowest terms.  The
    size of the last step is that of the result, which without ``reduce`` holds
    the product of all denominators.
    """
    return fold_limbs(limb_sums(df, keys, num, den), keys, out, reduce)


def fold_limbs(limbs: DataFrame, keys: list[str], out: str = "anteil", reduce: bool = False) -> DataFrame:
    """Fractions of the rows of ``limb_sums``, which may have been added up further."""
    limbs = stored(limbs.withColumn("_p", F.col("_p").cast("string")), "limbs")
    many = cut_lineage(limbs.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
                       .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > FOLD))
    most = many.agg(F.max("_n")).first()[0]
    fold = lambda rows, by: rows.groupBy(*by).agg(F.collect_list(F.struct(F.col("_d").alias("d"), F.col("_i").alias("i"), F.col("_p").alias("s"))).alias("_f")) \
        .select(*by, _folded("_f", F.lit(reduce)).alias("_f"))
    if most is None:
        whole = fold(limbs, keys)
    else:
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        parts = 1 << math.ceil(math.log2(most / FOLD))
        dealt = limbs.join(many, same, "left_semi").withColumn("_s", F.pmod(F.xxhash64("_d"), F.lit(parts)))
        level = fold(dealt, [*keys, "_s"])
        while parts > 1:
            parts //= 2
            level = level.groupBy(*keys, F.pmod("_s", F.lit(parts)).alias("_s")).agg(F.collect_list("_f").alias("_f")) \
                .select(*keys, "_s", _added("_f", F.lit(reduce)).alias("_f"))
        whole = fold(limbs.join(many, same, "left_anti"), keys).unionByName(level.drop("_s"))
    return whole.select(*keys, as_text(F.col("_f")).alias(out), F.col("_f").alias(f"{out}_parts"))


def ratio(n: Column, d: Column) -> Column:
    """n / d of two decimal texts as a double, however long they are."""
    head = lambda x: F.substring(F.ltrim(x, F.lit("-")), 1, 17).cast("double")
    rest = lambda x: F.greatest(F.char_length(F.ltrim(x, F.lit("-"))) - 17, F.lit(0))
    sign = F.when(n.startswith("-") != d.startswith("-"), F.lit(-1.0)).otherwise(1.0)
    return sign * head(n) / head(d) * F.pow(F.lit(10.0), rest(n) - rest(d))
