"""Joins that split hot keys.

A key that holds a large part of one side would end in one task.  Such keys are
found with a map-side combined count; their rows on the big side get a salt and
the matching rows on the other side are repeated once per salt.  At most
``TOP_KEYS`` keys are treated (every other key holds at most 1/TOP_KEYS of the
rows), so the broadcast list of hot keys has a fixed size bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

TOP_KEYS = 1000
MAX_SALTS = 256
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of salts for each."""
    n = F.least(F.ceil(F.col("_n") / F.lit(hot_rows)), F.lit(MAX_SALTS)).cast("int")
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > hot_rows)
            .orderBy(F.col("_n").desc(), *keys).limit(TOP_KEYS)
            .select(*keys, n.alias("_salts")))


def salted_side(big: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``big`` with a ``_salt`` column: a function of the row, so a recomputed task repeats it."""
    spread = F.xxhash64(*[c for c, t in big.dtypes if "map<" not in t])  # maps cannot be hashed
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    pick = (F.when(no_key, F.pmod(spread, F.lit(MAX_SALTS)))
            .when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts"))).otherwise(0).cast("int"))
    return big.join(F.broadcast(hot), keys, "left").withColumn("_salt", pick).drop("_salts")


def repeated_side(other: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``other`` once per salt of its key."""
    width = F.coalesce(F.col("_salts"), F.lit(1))
    return (other.join(F.broadcast(hot), keys, "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), width - 1))).drop("_salts"))


def salted(big: DataFrame, other: DataFrame, keys: list[str],
           hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt`` column to join on besides ``keys``."""
    hot = hot_keys(big, keys, hot_rows)
    return salted_side(big, hot, keys), repeated_side(other, hot, keys)


def salted_join(big: DataFrame, other: DataFrame, keys: list[str], how: str = "inner",
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join ``big`` with ``other`` on ``keys``; hot keys of ``big`` are spread.

    ``how`` may be inner, left, left_semi or left_anti: every row of ``big``
    still meets every matching row of ``other`` exactly once.
    """
    left, right = salted(big, other, keys, hot_rows)
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
