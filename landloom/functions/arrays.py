"""Array helpers; a null array counts as empty, as in the source data model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col


def arr_cat(*parts: Column | str) -> Column:
    """Concatenate arrays; null only when every part is null."""
    cols = [col(p) for p in parts]
    out = cols[0]
    for nxt in cols[1:]:
        out = F.when(out.isNull(), nxt).when(nxt.isNull(), out).otherwise(F.concat(out, nxt))
    return out


def sorted_set(a: Column | str) -> Column:
    """Distinct non-null members in order; null for an empty result."""
    s = F.array_sort(F.array_distinct(F.array_compact(col(a))))
    return F.when(F.size(s) > 0, s)


def joined_set(c: Column | str, sep: str = ",") -> Column:
    """Aggregate: distinct values, sorted and joined; null when there is none."""
    s = F.sort_array(F.collect_set(col(c)))
    return F.when(F.size(s) > 0, F.array_join(s, sep))


def concat_arrays(c: Column | str, order: Column | str | None = None) -> Column:
    """Aggregate: all arrays of a group behind each other, in ``order``."""
    if order is None:
        return F.flatten(F.collect_list(col(c)))
    pairs = F.array_sort(F.collect_list(F.struct(col(order).alias("o"), col(c).alias("a"))))
    return F.flatten(F.transform(pairs, lambda p: p["a"]))


def any_of(a: Column | str, *values) -> Column:
    """True when the array holds one of the values."""
    return F.arrays_overlap(col(a), F.array(*[F.lit(v) for v in values]))
