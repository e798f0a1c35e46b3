"""How far the sources of a language stand apart in their words.

The terms of a language that stand in enough documents are numbered, frequent
ones first.  Every source keeps, for each count that its terms have, a bitmap of
the numbers of the terms with that count, cut into words of 64 bits.  The joint
counts of two sources come from these bitmaps alone: the bits of ``x AND y`` are
the terms that have count x in one and count y in the other.  Each such cell is
weighted by the difference that its two counts make.  Terms that a source does
not have are never stored: their cells are what is left of the other source's
bitmap, and of the whole vocabulary (complement).

All sums are of whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from landloom.operators.lookups import numbered

from . import textblocks as tb
from .minhash import stored

LEAST_DOCS = 30
TOP_TERMS = 50
#: Weight of a whole, and what is added to each count.
UNIT, ADDED = 1_000_000_000, 5
#: Numbers of a bitmap word, words handled by one task call, and sources that meet in one call.
WORD, WORDS, MEETING = 64, 16, 256

#: Bytes of a term (letters and all beyond ASCII); everything else becomes a blank.
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n (occurrences), docs (rows that hold it) of every block of rows."""
    for block in tb.blocks(batches, "text", 4 * tb.BLOCK_BYTES):
        data, offsets = tb.byte_view(block.column(2))
        texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(_LETTERS[data]))
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        code, words = np.asarray(coded.indices), len(coded.dictionary)
        row = np.repeat(np.arange(block.num_rows), np.diff(np.asarray(split.offsets)))
        empty = pc.index(coded.dictionary, pa.scalar("", pa.large_string())).as_py()
        full = np.flatnonzero(code != empty)
        group, groups = pd.factorize(pd.MultiIndex.from_arrays([block.column(0).to_pylist(), block.column(1).to_pylist()]))
        # rows hold a term once or more; then groups hold rows
        cell, n = np.unique(row[full] * words + code[full], return_counts=True)
        key, at = np.unique(group[cell // words] * words + cell % words, return_inverse=True)
        owner = key // words
        yield pa.RecordBatch.from_arrays(
            [pa.array([g[0] for g in groups], pa.string()).take(pa.array(owner)), pa.array([g[1] for g in groups], pa.string()).take(pa.array(owner)),
             coded.dictionary.take(pa.array(key % words)).cast(pa.string()),
             pa.array(np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)), pa.array(np.bincount(at, minlength=len(key)).astype(np.int64))],
            ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs of ``docs`` (lang, source, text)."""
    return (docs.select("lang", "source", "text").mapInArrow(_terms, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (n + ADDED) / (total + ADDED * terms)) in whole numbers of any size."""
    return F.expr(f"1 + (cast({UNIT} as decimal(38, 0)) * ({n} + {ADDED})) div ({total} + {ADDED} * {terms})")


def _meet(table: pa.Table) -> pa.Table:
    """What the terms that two sources both have change against both standing on their own; summed over the words of a call."""
    columns = table.select(["word", "source", "chunk", "p", "p0", "bits", "lo", "hi"]).to_pandas()
    lang, out = table.column("lang")[0].as_py(), {}
    across = columns["lo"].iat[0] != columns["hi"].iat[0]
    for _, rows in columns.groupby("word"):
        rows = rows.sort_values(["source", "p"], kind="stable")
        names, first = np.unique(rows["source"].to_numpy(), return_index=True)
        chunk, zero = rows["chunk"].to_numpy()[first], rows["p0"].to_numpy()
        p, bits = rows["p"].to_numpy(), rows["bits"].to_numpy().view(np.uint64)
        ends = [*first[1:], len(rows)]
        for k in range(len(names) - 1):
            a, b = first[k], ends[k]
            both = np.bitwise_count(bits[a:b, None] & bits[None, b:]).astype(np.int64)
            change = np.abs(p[a:b, None] - p[None, b:]) - np.abs(p[a:b, None] - zero[None, b:]) \
                - np.abs(zero[a] - p[None, b:]) + np.abs(zero[a] - zero[None, b:])
            sums = np.add.reduceat((both * change).sum(0), first[k + 1:] - b)
            for j, v in enumerate(sums.tolist(), k + 1):
                if not across or chunk[j] != chunk[k]:
                    out[names[k], names[j]] = out.get((names[k], names[j]), 0) + v
    pairs = list(out)
    return pa.table({"lang": pa.array([lang] * len(pairs), pa.string()), "one": pa.array([x for x, _ in pairs], pa.string()),
                     "other": pa.array([y for _, y in pairs], pa.string()), "change": pa.array(list(out.values()), pa.int64())})


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, meeting: int = MEETING) -> DataFrame:
    """lang, source, part, item, value, rank for the sources of ``docs`` (lang, source, text).

    Part ``pair``: item is another source of the language, value the summed
    difference of the shares of all kept terms.  Part ``term``: item is a kept
    term that the source uses more often than its language, value by how much;
    only the first ``top_terms``.  Ranks go by value, then by item.

    A null lang, source or text counts as an empty one; empty texts have no
    terms but their source takes part; a language without kept terms has pairs
    of value 0.  Equal rows count each on their own.  An empty table gives no
    rows.  Other columns, whatever their names, are not looked at.  A call of
    ``_meet`` holds at most twice ``meeting`` sources of one language.
    """
    spark = docs.sparkSession
    filled = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stored(term_counts(filled), "audit-counts")
    terms = (counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
             .filter(F.col("docs") >= least_docs).select("lang", "term", "total"))
    terms = stored(numbered(terms, ["lang"], [F.col("total").desc(), F.col("term")], "number"), "audit-terms")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_total"))
    cells = stored(counts.drop("docs").join(terms, ["lang", "term"]), "audit-cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.count(F.lit(1)).alias("present"))
    groups = stored(
        filled.select("lang", "source").distinct().join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
        .fillna(0, ["v", "lang_total", "group_total", "present"])
        .withColumn("p0", F.when(F.col("v") > 0, _share("0L", "group_total", "v")).otherwise(F.lit(0).cast("long"))), "audit-groups")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    chunks = max(1, -(-most // meeting))

    # a bitmap word for every count of every source
    chunk = F.pmod(F.xxhash64("source"), F.lit(chunks)).cast("int")
    number = F.col("number") - 1
    bit = F.expr(f"shiftleft(1L, cast((number - 1) % {WORD} as int))")
    bitmaps = (cells.groupBy("lang", "source", "n", F.floor(number / WORD).cast("long").alias("word")).agg(F.bit_or(bit).alias("bits"))
               .join(groups.select("lang", "source", "group_total", "v", "p0"), ["lang", "source"])
               .withColumn("p", _share("n", "group_total", "v")))
    bitmaps = stored(bitmaps.select("lang", "source", "word", "n", "p", "p0", "bits"), "audit-bitmaps")
    dealt = (bitmaps.withColumn("chunk", chunk).withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
             .select("lang", "source", "word", "chunk", "p", "p0", "bits", F.floor(F.col("word") / WORDS).alias("block"),
                     F.least("chunk", "with").alias("lo"), F.greatest("chunk", "with").alias("hi")))
    met = (dealt.groupBy("lang", "block", "lo", "hi").applyInArrow(_meet, "lang string, one string, other string, change long")
           .groupBy("lang", "one", "other").agg(F.sum("change").alias("change")))
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                             F.struct(F.col("other").alias("source"), F.col("one").alias("item"))))
    change = met.select("lang", both.alias("x"), "change").select("lang", "x.*", "change")

    # each source on its own against the other's share of a term it does not have
    levels = bitmaps.groupBy("lang", "source", "p").agg(F.sum(F.bit_count("bits")).alias("size"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("item_p0"))
    alone = (levels.join(others, "lang").filter("source <> item").groupBy("lang", "source", "item")
             .agg(F.sum(F.col("size") * F.abs(F.col("p") - F.col("item_p0"))).alias("alone")))
    pairs = (groups.select("lang", "source", "v", "present", "p0")
             .join(groups.select("lang", F.col("source").alias("item"), F.col("present").alias("item_present"), F.col("p0").alias("item_p0")), "lang")
             .filter("source <> item"))
    of_item = alone.select("lang", F.col("source").alias("item"), F.col("item").alias("source"), F.col("alone").alias("item_alone"))
    key = ["lang", "source", "item"]
    missing = (F.col("v") - F.col("present") - F.col("item_present")) * F.abs(F.col("p0") - F.col("item_p0"))
    none = F.lit(0).cast("long")
    value = sum((F.coalesce(c, none) for c in ("alone", "item_alone", "change")), missing)
    pairs = (pairs.join(alone, key, "left").join(of_item, key, "left").join(change, key, "left")
             .select("lang", "source", "item", value.cast("long").alias("value")))

    above = (cells.join(groups.select("lang", "source", "group_total", "v", "lang_total"), ["lang", "source"])
             .select("lang", "source", F.col("term").alias("item"),
                     (_share("n", "group_total", "v") - _share("total", "lang_total", "v")).cast("long").alias("value")).filter("value > 0"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    part = lambda rows, name: rows.withColumn("rank", rank).select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(pairs, "pair").unionByName(part(above, "term").filter(F.col("rank") <= top_terms))
