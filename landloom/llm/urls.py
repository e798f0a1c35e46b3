"""URL filters: host and path rules, then a blocked Bloom filter with an exact join.

Listed addresses are put into canonical form and into a Bloom filter that is cut
into blocks of ``WORDS`` 64-bit words; an address sets one bit in each word of
one block.  The filter is a table with one row per block.  Addresses of pages
probe the block they belong to; those whose bits are all set go on to an exact
hash join with the listed addresses, which removes false positives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 4
#: Listed addresses for each block of WORDS * 64 bits: 16 bits an address.
PER_BLOCK = WORDS * 4
#: A filter of at most so many blocks (32 MB of words) is sent to every executor; a larger one is joined by block.
BROADCAST_BLOCKS = 1 << 20
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, SMALL)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.`` and a port, path without trailing slashes; empty for no host."""
    bare = F.regexp_replace(F.regexp_replace(host, ":[0-9]*$", ""), "^(www|m)\\.", "")
    return F.when(host == "", F.lit("")).otherwise(F.concat(bare, F.regexp_replace(path, "/+$", "")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule (verdict, host, path) that fits, else null.

    A rule fits its host and all subdomains where the path begins with the
    rule's.  Ties go to block.  ``rules`` are program data.
    """
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1], r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in order]
    pick = lambda value: F.coalesce(F.lit(None).cast("string"), *[F.when(f, F.lit(value(r))) for f, r in zip(fits, order)])
    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


def _places(address: Column, blocks: int) -> list[Column]:
    """Block and one bit for each word of it."""
    h = F.xxhash64(address, F.lit(1))
    spread = F.xxhash64(address, F.lit(2))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int")).alias(f"b{k}")
            for k in range(WORDS)]
    return [F.pmod(h, F.lit(blocks)).alias("block"), *bits]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """One row per used block: block, w0 .. w3, from rows with ``address``."""
    return (listed.select(*_places(F.col("address"), blocks)).groupBy("block")
            .agg(*[F.bit_or(f"b{k}").alias(f"w{k}") for k in range(WORDS)]))


def listed_pages(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """page key and address of the ``pages`` (key, address) whose address is in ``listed`` (address)."""
    listed = listed.filter("address is not null and address <> ''").select("address").distinct()
    blocks = max(1, -(-listed.count() // PER_BLOCK))
    filter_ = bloom_filter(listed, blocks)
    filter_ = F.broadcast(filter_) if blocks <= BROADCAST_BLOCKS else filter_
    probe = pages.select("*", *_places(F.col("address"), blocks))
    all_set = reduce(lambda a, b: a & b, [F.col(f"w{k}").bitwiseAND(F.col(f"b{k}")) == F.col(f"b{k}") for k in range(WORDS)])
    possible = probe.join(filter_, "block").filter(all_set).select(*pages.columns)
    return possible.join(listed.hint("shuffle_hash"), "address", "left_semi")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame) -> DataFrame:
    """page_id, url, host, path, address, rule and verdict of every row of ``pages`` (page_id, url).

    The verdict is that of the longest rule that fits; without a rule it is
    ``block`` where the canonical address is in ``listed`` (column url), else
    ``allow``.  A null url or one without ``://`` has an empty host and path, no
    rule and is allowed.  Equal rows come out as often as they go in; other
    columns are not looked at; an empty list blocks nothing.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    seen = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = seen.withColumns({"rule": rule, "_v": verdict, "address": canonical(F.col("host"), F.col("path"))})
    names = listed.select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("address"))
    open_ = seen.filter("_v is null and address <> ''").select("address").distinct()
    hits = listed_pages(open_, names).withColumn("_hit", F.lit(True))
    # an address in the list blocks all its pages; the side of hits holds each address once
    return (seen.join(hits, "address", "left")
            .withColumn("verdict", F.coalesce("_v", F.when(F.col("_hit"), F.lit("block")).otherwise(F.lit("allow"))))
            .select("page_id", "url", "host", "path", "address", "rule", "verdict"))
