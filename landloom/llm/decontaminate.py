"""Benchmark decontamination by a positional inverted index of the training text.

Benchmark items are cut into windows of ``WINDOW`` words.  The index holds
(term, document, position) of the training words that occur in a window, stored
as a table.  For each window the lists of its rarest terms are read first:
shifted by the place of the term in the window they name start positions, and
the shifted lists are intersected by an equi-join on (window, document, start).
What is left is compared word by word with the document, so the matches are
exact phrases.  ``near_matches`` reads the same index for windows whose terms
all stand close together in any order.

Only terms that are among the ``RAREST`` of a window enter the index: frequent
words are never posted, but looked up in the few documents that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .minhash import stored
from .nativetext import lower_ascii, split_words

WINDOW = 10
RAREST = 2
#: Tables of at most so many rows (words and windows of ordinary length: some 100 MB) are sent to every executor.
BROADCAST_ROWS = 500_000
#: Everything in ASCII but digits and letters separates words.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_ENDS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def item_words(text: Column) -> Column:
    return split_words(text, SEPARATORS, _ENDS)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to at most ``rows`` rows, else left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def windows_of(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows: window (id), terms, items (sorted ids as strings)."""
    low = items.select("item_id", F.transform(item_words(F.col("text")), lower_ascii).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    cut = low.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("terms"))
    return (cut.groupBy("terms").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
            .withColumn("window", F.xxhash64("terms", F.size("terms"))))


def _positions(docs: DataFrame) -> DataFrame:
    """Every word of every document: row, position, term."""
    return (docs.select("row", F.posexplode(item_words(F.col("text"))).alias("position", "word"))
            .select("row", "position", lower_ascii(F.col("word")).alias("term")))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings (term, row, position) of ``terms`` in ``docs`` (row, text)."""
    return stored(_positions(docs).join(small(terms), "term"), "decontaminate-index")


def rarest_terms(docs: DataFrame, windows: DataFrame, rarest: int = RAREST) -> DataFrame:
    """window, term, offset (place in the window), rank (0: rarest), of the rarest different terms of each window."""
    placed = windows.select("window", F.posexplode("terms").alias("offset", "term"))
    vocabulary = small(placed.select("term").distinct())
    often = _positions(docs).join(vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    # a term that no document has makes its window impossible; it is the rarest and has an empty list
    counted = (placed.groupBy("window", "term").agg(F.min("offset").alias("offset")).join(often, "term", "left")
               .withColumn("n", F.coalesce("n", F.lit(0))))
    order = Window.partitionBy("window").orderBy("n", "term")  # at most WINDOW rows each
    return stored(counted.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < rarest)
                  .select("window", "term", "offset", "rank", "n"), "decontaminate-rarest")


def phrase_matches(docs: DataFrame, windows: DataFrame, rarest: int = RAREST) -> DataFrame:
    """row, start, window of every exact occurrence of a window in ``docs`` (row, text)."""
    anchors = rarest_terms(docs, windows, rarest)
    index = build_index(docs, anchors.select("term").distinct())

    def starts(rank: int) -> DataFrame:
        own = small(anchors.filter(F.col("rank") == rank).select("window", "term", "offset"))
        return (index.join(own, "term").select("window", "row", (F.col("position") - F.col("offset")).alias("start"))
                .filter("start >= 0"))

    left = starts(0)
    for k in range(1, rarest):
        more = anchors.filter(F.col("rank") == k).select("window")
        both = left.join(starts(k), ["window", "row", "start"], "left_semi")
        left = both.union(left.join(small(more), "window", "left_anti"))  # windows of fewer different terms
    left = stored(left.distinct(), "decontaminate-left")  # equal rows share a key: their windows count once
    # word by word, in the few documents that are left; a document's starts are bounded by its words
    wanted = (left.join(small(windows.select("window", "terms")), "window")
              .groupBy("row").agg(F.collect_list(F.struct("window", "start", "terms")).alias("c")))
    text = docs.join(wanted, "row").withColumn("w", F.transform(item_words(F.col("text")), lower_ascii))
    same = F.filter("c", lambda x: F.slice("w", x["start"] + 1, F.size(x["terms"])) == x["terms"])
    return (text.select("row", F.explode(same).alias("m"))
            .select("row", "m.start", "m.window", F.size("m.terms").alias("width")))


def near_matches(docs: DataFrame, windows: DataFrame, slop: int = 5) -> DataFrame:
    """row, window of windows whose different terms all stand within their number of words plus ``slop``.

    Every posting of a window's rarest term opens a span; the lists of its
    other terms are met in the same document and counted within the span.
    """
    placed = windows.select("window", F.explode(F.array_distinct("terms")).alias("term"), F.size("terms").alias("width"),
                            F.size(F.array_distinct("terms")).alias("need"))
    index = build_index(docs, placed.select("term").distinct())
    anchor = rarest_terms(docs, windows, 1).select("window", "term")
    opened = index.join(small(anchor), "term").select("window", "row", F.col("position").alias("at"))
    # spans begin at a term and hold the anchor, so all positions lie within width + slop of it
    met = (opened.join(small(placed), "window").join(index, ["term", "row"])
           .filter(F.abs(F.col("position") - F.col("at")) < F.col("width") + slop))
    spans = met.select("window", "row", "at", "width", "need", F.col("position").alias("begin")).distinct()
    inside = (spans.join(met.select("window", "row", "at", "term", "position"), ["window", "row", "at"])
              .filter((F.col("position") >= F.col("begin")) & (F.col("position") < F.col("begin") + F.col("width") + slop)))
    return (inside.groupBy("window", "row", "at", "begin", "need").agg(F.count_distinct("term").alias("have"))
            .filter("have = need").select("row", "window").distinct())


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted strings), contaminated.

    ``docs`` has doc_id and text, ``benchmark`` has item_id and text; other
    columns are not looked at.  Words are runs of digits, letters and non-ASCII
    characters, A-Z lower-cased.  An item of fewer than ``width`` words, but not
    none, is one window.  Null and empty texts have no words; items without
    words or with a null id name nothing but their words still count as hit.
    Rows that share a doc_id and a text get the same result each; a null doc_id
    is judged like any other.
    """
    key = F.struct("doc_id", F.xxhash64("text").alias("h"))
    rows = docs.select("doc_id", "text", key.alias("row"))
    windows = stored(windows_of(benchmark, width), "decontaminate-windows")
    found = phrase_matches(rows.select("row", "text"), windows, rarest)
    per = (found.join(small(windows.select("window", "items")), "window")
           .groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "width"))).alias("spans"),
                               F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    total = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["start"] + x["width"] - F.greatest(s["end"], x["start"]))).alias("n"),
        F.greatest(s["end"], x["start"] + x["width"]).alias("end")))
    per = per.select("row", total["n"].cast("long").alias("n_hit"), "items")
    none = F.array().cast("array<string>")
    counted = rows.select("doc_id", "row", F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    return (counted.join(per, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"))
            .withColumn("contaminated", F.col("n_hit") > 0))
