"""Quality rules: base counts and a hashed n-gram likelihood ratio.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets.  Two
multinomials are counted over the buckets: one over all documents (the raw
corpus), one over trusted documents.  A document's score is the sum of log
(trusted / raw) over its n-grams, divided by their number; documents below
``LEAST_SCORE`` are rejected.  The rule has no chance in it: equal texts get
equal verdicts.

Both counts cover all their documents, however many are trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .nativetext import let, split_words, with_fields

BUCKETS = 1 << 16
LEAST_SCORE = -0.1
#: Fixed values of the base rules.
SYMBOLS = "[^#*$%&|<>]+"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr_score", "base_failed", "kept")


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more in the text.

    Each step is bound to a variable, so none is worked out again for each element.
    """
    def summed(starts: Column) -> Column:
        return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                           lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n"), p.alias("last")))["n"]

    def starts_of(placed: Column) -> Column:
        following = F.slice(placed, F.lit(2), F.size(placed))
        pairs = F.zip_with(placed, following, lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

    def counted(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # most texts repeat nothing: the sort runs only where a hash comes twice
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(placed, lambda p: let(starts_of(p), summed))).otherwise(0)

    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(n >= WINDOW, let(hashes, counted)).otherwise(0).cast("long")


def base_fields(text: Column, words: Column) -> dict[str, Column]:
    """The base columns of a text and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return {"n_words": F.size(words).cast("long"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.char_length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(words)}


def _bucket(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def _grams(docs: DataFrame) -> DataFrame:
    """``bucket`` of every word and word pair of ``text``."""
    words = split_words(F.col("text"))
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))).alias("b"))
    rows = docs.select(F.explode(pairs).alias("p"))
    one = F.array(_bucket("p.a"), _bucket("p.a", "p.b"))
    return rows.select(F.explode(F.when(F.col("p.b").isNull(), F.slice(one, 1, 1)).otherwise(one)).alias("bucket"))


def ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with ``llr``: log (trusted / raw) of each bucket, with one added to each count."""
    chosen = trusted.filter("doc_id is not null").select("doc_id").distinct()
    # the ids are the small side of each part: texts are dealt out by id but not sorted
    marked = docs.select("doc_id", "text").join(chosen.hint("shuffle_hash"), "doc_id", "left_semi")
    count = lambda d, name: _grams(d).groupBy("bucket").agg(F.count(F.lit(1)).alias(name))
    counts = count(docs, "raw").join(count(marked, "target"), "bucket", "left")
    all_ = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0)
    whole = all_.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("c"),  # BUCKETS entries
                     F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    return whole.select(F.transform("c", lambda x: F.log((x["target"] + 1) / (F.col("targets") + BUCKETS))
                                    - F.log((x["raw"] + 1) / (F.col("raws") + BUCKETS))).alias("llr"))


def quality_rules(docs: DataFrame, trusted: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr_score and kept.

    ``docs`` has doc_id and text; its other columns come through (those named
    like a result are replaced).  ``trusted`` has doc_id.  A null, empty or
    blank text has no words and fails the base rules; its score is 0.  Without
    trusted documents the ratio says nothing about any document but its length
    in known buckets; then every document that passes the base rules is kept.
    Rows with a null doc_id are judged like all others.
    """
    table = ratios(docs, trusted)
    known = trusted.filter("doc_id is not null").limit(1).agg(F.count(F.lit(1)).alias("n"))
    names = [c for c in docs.columns if c not in RESULTS]
    rows = docs.select(*names, table.scalar().alias("_llr"), known.scalar().alias("_known"))

    def score(words: Column) -> Column:
        n = F.size(words)
        single = F.aggregate(words, F.lit(0.0), lambda s, w: s + F.get("_llr", _bucket(w)))
        double = F.when(n > 1, F.aggregate(F.sequence(F.lit(0), n - 2), F.lit(0.0), lambda s, i: s + F.get(
            F.col("_llr"), _bucket(F.get(words, i), F.get(words, i + 1))))).otherwise(0.0)
        return F.when(n > 0, (single + double) / (2 * n - 1)).otherwise(0.0)

    def judged(q: Column) -> Column:
        failed = (q["n_words"] < LEAST_WORDS) | (q["n_repeat_words"] * 100 > q["n_words"] * MOST_REPEATED_PERCENT)
        kept = ~failed & ((q["llr_score"] >= least_score) | (F.col("_known") == 0))
        return F.struct(*[q[c].alias(c) for c in RESULTS[:-2]], failed.alias("base_failed"), kept.alias("kept"))

    text = F.coalesce(F.col("text"), F.lit(""))
    fields = let(split_words(F.col("text")), lambda w: F.struct(
        *[v.alias(c) for c, v in base_fields(text, w).items()], score(w).alias("llr_score")))
    return with_fields(rows, let(fields, judged)).drop("_llr", "_known")
