"""Corpus preparation in five stages, each over all rows its predecessor kept.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the docs of the next.  All but the last return the columns of
``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from landloom.llm import decontaminate, minhash, quality_rules, queries, sentencepiece, suffix


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``_row``, a number of each row: ids may be null or come twice.  The numbers hold because they are stored."""
    return minhash.stored(docs.withColumn("_row", F.monotonically_increasing_id()), f"pipeline-rows-{name}")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    trusted = queries.table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules.quality_rules(docs, trusted).filter("kept").select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (shingles of five words, similarity 0.8): the smallest id, null ids last."""
    rows = keyed(docs, "near")
    groups = minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), width=5)
    named = groups.select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first"))
    return rows.join(first.select("first._row"), "_row", "left_semi").select(*docs.columns)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand anywhere else; a text that loses all stays as an empty one."""
    out = suffix.remove_repeats(docs)
    return out.withColumns({"text": F.when(F.col("text").isNotNull(), F.col("kept_text")),
                            "n_chars": F.char_length("kept_text").cast("long")}).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null and repeated ids do not matter, as a verdict depends on the text alone.

    The digests of the texts found are stored, so the engine knows how many they
    are before it chooses a join: few go to all tasks and no text is shuffled.
    """
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    found = decontaminate.decontaminate(docs.select(digest.alias("doc_id"), "text"), queries.table(spark, sf_dir, "benchmark"))
    gone = minhash.stored(found.filter("contaminated").select(F.col("doc_id").alias("_text")).distinct(), "pipeline-contaminated")
    return docs.join(gone, digest == F.col("_text"), "left_anti").select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to it."""
    path = queries.tokenizer_file("piece_bpe_32k.model")
    done = sentencepiece.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), path)
    same = F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(sentencepiece.BLANK), F.lit(" "))
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules_stage),
    ("near_duplicates", near_duplicates_stage),
    ("suffix_repeats", repeats_stage),
    ("benchmark", benchmark_stage),
    ("encoding", encoding_stage),
]

#: Hashes of n-grams and pieces of a vocabulary file are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = minhash.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
