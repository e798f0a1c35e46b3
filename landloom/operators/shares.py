"""Chained bookings: shares handed down along references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fractions as FR
from ..functions.fractions import NUM
from ..session import cut_lineage, stored
from .skew import HOT_ROWS, hot_keys, repeated_side, salted_side


def walk(roots: DataFrame, bookings: DataFrame, booking: str = "booking", refers: str = "refers",
         num: str = "num", den: str = "den",
         hot_rows: int = HOT_ROWS) -> DataFrame:
    """All bookings reachable from the roots with the product of the fractions.

    ``roots`` has the columns root.., booking, num, den; ``bookings`` says which
    booking refers to which.  One join per level; hot bookings are salted, a
    booking already on the path is not visited again, and bookings and levels
    are stored, so none is computed twice.  Numerators and denominators
    come back as texts without a limit of digits.
    """
    keep = [c for c in roots.columns if c not in (booking, num, den)]
    one = lambda df, c: F.coalesce(FR.digits(F.col(c), dict(df.dtypes)[c]), F.lit("1"))
    fits = lambda a, b: F.try_multiply(F.col(a).try_cast(NUM), F.col(b).try_cast(NUM)).cast("string")
    frontier = roots.select(*keep, booking, one(roots, num).alias(num), one(roots, den).alias(den), F.lit(0).alias("depth"),
                            F.array(booking).alias("path"))
    extra = [c for c in bookings.columns if c not in (booking, refers, num, den)]
    step = stored(bookings.select(F.col(refers).alias("_at"), F.col(booking).alias("_next"), one(bookings, num).alias("_n"),
                                  one(bookings, den).alias("_d"), *[F.col(c).alias(f"_x_{c}") for c in extra]), "bookings")
    # the hot bookings are the same on every level: counted once, at most TOP_KEYS rows
    hot = cut_lineage(hot_keys(step, ["_at"], hot_rows))
    salt = [] if hot.isEmpty() else ["_salt"]
    spread = salted_side(step, hot, ["_at"]) if salt else step
    carried = [c for c in keep if c not in extra]
    out = None
    while not frontier.isEmpty():  # ends because no path holds a booking twice
        out = frontier if out is None else out.unionByName(frontier, allowMissingColumns=True)
        at = frontier.withColumnRenamed(booking, "_at").drop(*extra)
        at = repeated_side(at, hot, ["_at"]) if salt else at
        nxt = spread.join(at, ["_at", *salt]).filter(~F.array_contains("path", F.col("_next")))
        level = stored(nxt.select(
            *carried, *[F.col(f"_x_{c}").alias(c) for c in extra], F.col("_next").alias(booking),
            fits(num, "_n").alias("_num"), fits(den, "_d").alias("_den"), num, den, "_n", "_d",
            (F.col("depth") + 1).alias("depth"), F.concat("path", F.array("_next")).alias("path")), "walk")
        long_ = F.col("_num").isNull() | F.col("_den").isNull()
        done = level.filter(~long_).withColumns({num: F.col("_num"), den: F.col("_den")})
        more = level.filter(long_).withColumns({num: FR.times(num, "_n"), den: FR.times(den, "_d")})  # past 38 digits
        frontier = done.unionByName(more).drop("_num", "_den", "_n", "_d")
    out = frontier if out is None else out
    return out.drop("path")


def factor(df: DataFrame, num: str, den: str) -> Column:
    """num/den as a double; no share or a zero denominator counts whole."""
    kind = dict(df.dtypes)
    n, d = FR.digits(F.col(num), kind[num]), FR.digits(F.col(den), kind[den])
    return F.when(n.isNull() | d.isNull() | (d == "0"), F.lit(1.0)).otherwise(FR.ratio(n, d))


def weighted_area(df: DataFrame, keys: list[str], area: str, num: str, den: str, out: str = "area",
                  areas: DataFrame | None = None, on: str | None = None) -> DataFrame:
    """Sum of area times num/den; no share or a zero denominator counts whole.

    The areas are a column of ``df`` or those of ``areas`` with the same ``on``.
    Shares are then added up per ``on`` before they meet the sum of its areas,
    so neither side is repeated by the other.
    """
    share = factor(df, num, den)
    if areas is None:
        return df.groupBy(*keys).agg(F.sum(F.col(area) * share).alias(out))
    held = df.groupBy(on, *keys).agg(F.sum(share).alias("_share"))
    whole = areas.groupBy(on).agg(F.sum(area).alias("_area"))
    return held.join(whole, on).groupBy(*keys).agg(F.sum(F.col("_area") * F.col("_share")).alias(out))
