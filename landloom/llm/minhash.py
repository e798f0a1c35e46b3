"""Near duplicates by MinHash signatures and an inverted join of their coordinates.

Every text becomes the set of its distinct word shingles.  Texts with equal
sets form one class at once.  One document of each class is posted under each
of its signature coordinates as (coordinate, value).  Two documents whose sets
are similar to 0.8 agree in at least ``MATCHES`` of ``COORDINATES`` coordinates
but for a chance below 1e-8, so they share one of the ``COORDINATES - MATCHES +
1`` coordinates that are rarest in the corpus for either of them: only this
prefix is posted and joined, the longer lists are skipped and probed by the
signature itself.  Pairs that agree often enough are confirmed on full sets.

The join runs in three rounds so that a large group never meets itself pair by
pair.  First every posting meets the document of its list that shares most with
the others, its pivot.  Then documents of one pivot meet where they differ from
it in the same shingles: each meets one document of each list, ``HEADS`` times
over, and only what these links leave in several components meets pair by pair.
Last, lists that still hold several components join across pivots and components.

Pairs that only share a list are held back by bounds that hold for every pair:
in the second round what the sorted differences still have behind the one that
is shared, in the last one a sketch of the parities of the sets (``ODD``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from landloom.session import checkpoint_dir

from . import textblocks as tb

COORDINATES = 48
#: Coordinates that a pair must share.  Binomial(48, 0.8) falls below 21 with a chance of about 2e-8.
MATCHES = 21
PERCENT = 80
#: Two bits of each coordinate of a pair differ in more than 35 of 96 places with a chance of about 1e-8.
DIFFERENT = 35
#: Rounds in which every list of one difference meets one of its documents.  They only save pairs, no link depends on them.
HEADS = 2
#: Longs of a set's parity sketch: each shingle flips one of 64 bits of one long, so two sketches differ in at most as
#: many bits as there are shingles in one set only.  Similar sets never differ in more, whatever the hashes.
ODD = 4
SKETCH = [f"o{k}" for k in range(ODD)]


def shingle_sets(block: pa.RecordBatch, text: str, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and hash of each distinct shingle of each row, and the number of rows."""
    data, offsets = tb.byte_view(block.column(block.schema.get_field_index(text)))
    data = tb.LOWER[data]
    starts, ends, row = tb.words(data, offsets)
    word = tb.word_hashes(data, starts, ends)
    n = block.num_rows
    count = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    place = np.arange(len(word)) - first[row]
    size = np.minimum(count, width)  # a short text is one shingle of all its words
    at = np.flatnonzero(place <= (count - size)[row])
    value, owner = np.zeros(len(at), tb.U), row[at]
    for k in range(width):
        more = np.flatnonzero(size[owner] > k)
        value[more] = tb.mix(value[more] * tb.U(tb.BASE) + word[at[more] + k])
    own = tb.mix(value + owner.astype(tb.U) * tb.U(tb.INVERSE))  # the row's part keeps rows apart
    keep = ~pd.Series(own).duplicated().to_numpy()
    return owner[keep], value[keep], n


def _signatures(width: int, coordinates: int):
    turn = tb.mix(np.arange(1, 2 * coordinates + 1, dtype=tb.U) * tb.U(tb.BASE))
    factor, shift = turn[:coordinates] | tb.U(1), turn[coordinates:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "text", tb.BLOCK_BYTES // 2):
            owner, value, n = shingle_sets(block, "text", width)
            count = np.bincount(owner, minlength=n)
            filled = np.flatnonzero(count)
            first = (np.concatenate([[0], np.cumsum(count)])[:-1])[filled]
            place = owner * (64 * ODD) + (tb.mix(value ^ tb.U(tb.INVERSE)) % tb.U(64 * ODD)).astype(np.int64)
            flips = (np.bincount(place, minlength=n * 64 * ODD) & 1).astype(np.uint8)
            odd = np.packbits(flips).view(np.int64).reshape(n, ODD)
            lo, hi, sig = np.zeros(n, tb.U), np.zeros(n, tb.U), np.zeros((n, coordinates), np.int32)
            if len(filled):
                lo[filled] = np.add.reduceat(value, first)
                hi[filled] = np.add.reduceat(tb.mix(value ^ tb.U(tb.INVERSE)), first)
                for k in range(coordinates):
                    low = np.minimum.reduceat(value * factor[k] + shift[k] ^ (value >> tb.U(29)), first)
                    sig[filled, k] = (tb.mix(low) >> tb.U(32)).astype(np.uint32).view(np.int32)
            # two bits of each coordinate, for a first look at a pair
            pairs = (sig & 3).astype(tb.U)
            short = np.zeros((n, 2), tb.U)
            for k in range(min(coordinates, 64)):
                short[:, k // 32] |= pairs[:, k] << tb.U(2 * (k % 32))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(count, pa.int64()), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)),
                 pa.array(short[:, 0].view(np.int64)), pa.array(short[:, 1].view(np.int64)),
                 *(pa.array(np.ascontiguousarray(odd[:, k])) for k in range(ODD)),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * coordinates, pa.int32()), pa.array(sig.ravel()))],
                ["doc_id", "n_shingles", "lo", "hi", "s0", "s1", *SKETCH, "signature"])
    return run


def signatures(docs: DataFrame, width: int, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, two sums that name the set, two bits of each coordinate, the parity sketch, and the signature."""
    return docs.select("doc_id", "text").mapInArrow(
        _signatures(width, coordinates),
        "doc_id long, n_shingles long, lo long, hi long, s0 long, s1 long, " + "".join(f"{c} long, " for c in SKETCH) + "signature array<int>")


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "text"):
            owner, value, n = shingle_sets(block, "text", width)
            order = np.lexsort((value, owner))
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value[order].view(np.int64)))],
                ["doc_id", "shingles"])
    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps do not repeat its work."""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _postings(reps: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """The rarest coordinates of each document, without those no other document has.

    ``weight`` is the length of all lists of a document together: among near
    copies it is largest for the text that the others were made from.
    """
    every = reps.select("doc_id", F.posexplode("signature").alias("coordinate", "value")) \
        .select("doc_id", F.xxhash64("coordinate", "value").alias("post"))
    often = every.groupBy("post").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = every.join(often, "post")
    # coordinates of its own come first in a document's order and meet nobody
    ranked = shared.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("n", "post"))).alias("lists"))
    free = F.lit(coordinates) - F.size("lists")
    take = F.greatest(F.lit(coordinates - matches + 1) - free, F.lit(0))
    weight = F.aggregate("lists", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    return (ranked.filter(F.size("lists") >= matches)  # fewer shared coordinates cannot reach the threshold
            .select("doc_id", weight.alias("weight"), F.transform(F.slice("lists", F.lit(1), take), lambda x: x["post"]).alias("posts"))
            .join(reps.select("doc_id", "n_shingles", "s0", "s1"), "doc_id")
            .select("doc_id", "weight", "n_shingles", "s0", "s1", F.explode("posts").alias("post")))


def _alike(a: str, b: str):
    """A first look at two documents: sizes, and two bits of each coordinate."""
    n, m = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
    away = F.bit_count(F.col(f"{a}s0").bitwiseXOR(F.col(f"{b}s0"))) + F.bit_count(F.col(f"{a}s1").bitwiseXOR(F.col(f"{b}s1")))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT) & (away <= DIFFERENT)


def _reachable(a: str, b: str):
    """False for two documents whose sketches differ in more bits than similar sets have shingles in one set only."""
    away = sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in SKETCH), F.lit(0))
    return away * (100 + PERCENT) <= (F.col(f"{a}n_shingles") + F.col(f"{b}n_shingles")) * (100 - PERCENT)


def _likely(pairs: DataFrame, reps: DataFrame, matches: int) -> DataFrame:
    """``pairs`` (a, b, ..) whose signatures agree in enough coordinates."""
    sig = reps.select("doc_id", "signature")
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return stored(pairs.join(sig.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa")), "a")
                  .join(sig.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb")), "b")
                  .filter(agree >= matches).drop("sa", "sb"), "minhash-likely")


def _full_sets(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Stored shingle sets of all documents in ``pairs``."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    return stored(docs.join(named, "doc_id", "left_semi").mapInArrow(_sets(width), "doc_id long, shingles array<long>"), "minhash-sets")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with the sizes na, nb of the full sets and of what they share."""
    return (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
            .withColumns({"na": F.size("x").cast("long"), "nb": F.size("y").cast("long"), "both": F.size(F.array_intersect("x", "y")).cast("long")})
            .drop("x", "y"))


SIMILAR = f"both * 100 >= (na + nb - both) * {PERCENT}"


def _confirmed_beside(pairs: DataFrame, each: DataFrame) -> DataFrame:
    """Components (a, b) that a similar pair of ``pairs`` ties together; ``each`` has the documents' differences d from their pivot."""
    x = each.select(F.col("doc_id").alias("a"), "pivot", "q", "na", "d")
    y = each.select(F.col("doc_id").alias("b"), "pivot", F.col("q").alias("q2"), F.col("d").alias("d2"))
    return (pairs.distinct().join(x, ["a", "pivot"]).join(y, ["b", "pivot"])
            .filter(9 * F.size(F.array_intersect("d", "d2")) >= F.col("q") + F.col("q2") + F.col("na"))
            .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())


def _links_beside(pivots: DataFrame) -> DataFrame:
    """Links (a, b) between the components of documents that were measured against the same pivot.

    ``pivots``: doc_id, component, pivot, na (size of the pivot's set), lacks
    (its shingles the document lacks) and adds (those the document adds).  A
    document whose excess q = 5 |lacks| + 4 |adds| - na is at most 0 is similar to
    the pivot itself.  Two documents are similar if and only if what they lack
    and add has at least (q1 + q2 + na) / 9 shingles in common.  So if one of
    them is not similar to the pivot, they must meet in these differences, which
    are short and, sorted by how often they come, need only be posted for a
    prefix.  Behind the first one that two documents share come all others they
    share, so a list makes no pair of a document with too few behind it.  The
    largest groups of near copies hold few such documents; no pair of the others
    is looked at.

    One link between two components is as good as all.  So each list of one
    difference first meets one of its documents, drawn anew in each of ``HEADS``
    rounds, which makes no more pairs than there are postings; the components
    that these links tie together count as one from then on.  Lists that still
    hold several components are joined in full, across components only.
    """
    group = (pivots.groupBy("pivot").agg(F.count_if(F.col("q") > 0).alias("beside"), F.count(F.lit(1)).alias("n"))
             .filter("beside > 0 and n > 1").select("pivot"))
    size = F.col("r") + F.col("p")
    own = 1 + 5 * F.col("r") + 4 * F.col("p")
    # fewest common differences with any partner: ninths of q + .. for a partner beside, a fifth of q for one similar to the pivot
    least = F.greatest(F.lit(1), F.when(F.col("q") > 0, F.least(F.ceil(own / 9), F.ceil(F.col("q") / 5))).otherwise(F.ceil(own / 9)))
    # a document similar to the pivot needs nine of its differences to make up the least excess beside
    few = pivots.filter("q > 0").groupBy("pivot").agg(F.min("q").alias("lowest"))
    # 256 places for the differences: a place that only one side has is a difference they do not share
    place = lambda k: F.aggregate(F.filter("d", lambda e: F.shiftright(e, 8).bitwiseAND(F.lit(3)) == k), F.lit(0).cast("long"),
                                  lambda acc, e: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(F.lit(63)).cast("int"))))
    each = stored(pivots.join(group, "pivot", "left_semi").join(few, "pivot").filter((F.col("q") > 0) | (9 * size >= F.col("lowest") + F.col("q") + F.col("na")))
                  .select("doc_id", "component", "pivot", "na", "r", "p", "q", least.cast("int").alias("least"), F.concat("lacks", "adds").alias("d"))
                  .withColumns({f"b{k}": place(k) for k in range(4)}), "minhash-differences")
    loose = each.select("doc_id", "pivot", F.explode("d").alias("e"))
    often = loose.groupBy("pivot", "e").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = loose.join(often, ["pivot", "e"]).groupBy("doc_id", "pivot").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("lists"))
    # differences of its own come first and meet nobody
    take = F.greatest(F.size("lists") - F.col("least") + 1, F.lit(0))
    posts = stored(ranked.join(each.drop("d"), ["doc_id", "pivot"]).select("*", F.posexplode(F.slice("lists", F.lit(1), take)).alias("at", "l"))
                   .select("doc_id", "component", "pivot", "na", "r", "p", "q", "b0", "b1", "b2", "b3", F.col("l.e").alias("e"),
                           (F.size("lists") - F.col("at")).alias("left")), "minhash-beside")
    apart = lambda x, y: sum((F.bit_count(F.col(f"{x}.b{k}").bitwiseAND(F.bitwise_not(F.col(f"{y}.b{k}")))) for k in range(4)), F.lit(0))
    shared = F.least(F.col("l.r") + F.col("l.p") - apart("l", "r"), F.col("r.r") + F.col("r.p") - apart("r", "l"))  # at most
    # of the lists in which two similar documents meet, the first has all that they share at or behind it
    meet = (((F.col("l.q") > 0) | (F.col("r.q") > 0))
            & (9 * F.least("l.left", "r.left") >= F.col("l.q") + F.col("r.q") + F.col("l.na"))
            & (9 * (F.least("l.r", "r.r") + F.least("l.p", "r.p")) >= F.col("l.q") + F.col("r.q") + F.col("l.na"))
            & (9 * shared >= F.col("l.q") + F.col("r.q") + F.col("l.na")))
    pair = [F.col(f"{x}.{c}").alias(n) for x, c, n in (("l", "doc_id", "a"), ("r", "doc_id", "b"), ("l", "pivot", "pivot"), ("l", "component", "ca"), ("r", "component", "cb"))]
    several = F.min("component") < F.max("component")
    tied = None
    for turn in range(HEADS):
        heads = (posts.groupBy("pivot", "e")
                 .agg(F.min(F.struct(F.xxhash64("doc_id", F.lit(turn)).alias("draw"), *[c for c in posts.columns if c not in ("pivot", "e")])).alias("r"), several.alias("open"))
                 .filter("open").select("pivot", "e", "r"))
        l = posts.select("pivot", "e", F.struct(*posts.columns).alias("l"))
        pairs = l.join(heads, ["pivot", "e"]).filter(meet & (F.col("l.component") != F.col("r.component"))).select(*pair)
        found = components(_confirmed_beside(pairs, each))
        tied = found if tied is None else tied.union(found)
        under = found.select(F.col("node").alias("component"), F.col("component").alias("under"))
        posts = posts.join(under, "component", "left").withColumn("component", F.coalesce("under", "component")).drop("under")
    open_ = posts.groupBy("pivot", "e").agg(several.alias("open")).filter("open").select("pivot", "e")
    posts = stored(posts.join(open_, ["pivot", "e"], "left_semi"), "minhash-apart")
    l, r = posts.alias("l"), posts.alias("r")
    same = (F.col("l.pivot") == F.col("r.pivot")) & (F.col("l.e") == F.col("r.e")) & (F.col("l.component") < F.col("r.component"))
    links = _confirmed_beside(l.join(r, same & meet).select(*pair), each)
    return stored(links.union(tied.select(F.col("component").alias("a"), F.col("node").alias("b"))), "minhash-tied")


def components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each node of ``edges`` (a, b): node, component.

    Every round hangs each node's larger neighbours under its smallest
    neighbour and then its smaller ones (large star and small star), until all
    links lead to the end of their component.  A node with very many links is summed by minimum
    before the shuffle and joined, never collected.
    """
    def hang(links: DataFrame, larger: bool) -> DataFrame:
        least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        hung = links.join(least, "u")
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if larger else \
            hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    links = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    def settled() -> bool:
        """All links lead straight to a node that leads nowhere."""
        twice = links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
        onward = links.select("v").join(links.select(F.col("u").alias("v")), "v", "left_semi")
        return twice.union(onward).isEmpty()

    while not settled():
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = stored(hang(hang(both, True), False), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))


def near_duplicates(docs: DataFrame, width: int = 5, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``docs`` has doc_id and text, other columns are not looked at.  Words are
    runs of bytes other than white space, A-Z lower-cased; a text with fewer
    than ``width`` words is one shingle.  Null, empty and blank texts have no
    shingles and link with nothing.  Rows that share a doc_id count as one
    document; a null doc_id keeps its row, links with nothing and has a null
    component.  Equal rows come out as often as they go in.
    """
    docs = docs.select("doc_id", "text")
    signed = stored(signatures(docs, width, coordinates), "minhash-signatures")
    full = signed.filter("doc_id is not null and n_shingles > 0")
    classes = full.groupBy("n_shingles", "lo", "hi").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = stored(full.join(classes.select(F.col("rep").alias("doc_id"), "n_shingles", "lo", "hi"),
                            ["doc_id", "n_shingles", "lo", "hi"], "left_semi")
                  .dropDuplicates(["doc_id", "lo", "hi"]).select("doc_id", "n_shingles", "s0", "s1", *SKETCH, "signature"), "minhash-classes")
    posts = _postings(reps, coordinates, matches)

    # round 1: every posting against the weightiest document of its list
    posts = stored(posts, "minhash-postings")
    heads = posts.groupBy("post").agg(F.max(F.struct("weight", "doc_id", "n_shingles", "s0", "s1")).alias("head"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").drop("n")
    lists = stored(posts.join(heads, "post").withColumn("near", (F.col("doc_id") != F.col("head.doc_id")) & _alike("", "head."))
                   .withColumns({"a": F.when(F.col("near"), F.col("head.doc_id")), "wa": F.when(F.col("near"), F.col("head.weight"))})
                   .drop("head", "near", "weight"), "minhash-lists")
    star = lists.filter("a is not null").select("a", F.col("doc_id").alias("b"), "wa").distinct()
    # the weightiest document that each one is like is its pivot; others are their own
    pivot = _likely(star, reps, matches).groupBy("b").agg(F.max(F.struct("wa", "a")).alias("s")).select(F.col("b").alias("doc_id"), F.col("s.a").alias("pivot"))
    pivot = stored(pivot, "minhash-pivots")
    sets = _full_sets(docs, pivot.select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")), width)
    measured = (sets.join(pivot, "doc_id").withColumnRenamed("shingles", "x")
                .join(sets.select(F.col("doc_id").alias("pivot"), F.col("shingles").alias("y")), "pivot")
                .select("doc_id", "pivot", F.size("y").alias("na"), F.array_except("y", "x").alias("lacks"), F.array_except("x", "y").alias("adds"))
                .withColumns({"r": F.size("lacks"), "p": F.size("adds")}).withColumn("q", 5 * F.col("r") + 4 * F.col("p") - F.col("na")))
    measured = stored(measured, "minhash-measured")
    found = components(measured.filter("q <= 0").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")))
    named = found.withColumnRenamed("node", "doc_id")
    placed = stored(reps.select("doc_id", *SKETCH).join(named, "doc_id", "left").join(pivot, "doc_id", "left")
                    .select("doc_id", F.coalesce("component", "doc_id").alias("component"), F.coalesce("pivot", "doc_id").alias("pivot"), *SKETCH), "minhash-placed")

    # round 2: documents of the same pivot by their differences from it
    beside = _links_beside(measured.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")))

    # round 3: lists that hold several pivots and components, across both only; rows of one doc_id meet with every sketch of theirs
    labelled = lists.select("post", "doc_id", "n_shingles", "s0", "s1").join(placed, "doc_id")
    mixed = (labelled.groupBy("post").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.min("pivot").alias("p"), F.max("pivot").alias("q"))
             .filter("c <> d and p <> q").select("post"))
    open_ = stored(labelled.join(mixed, "post", "left_semi"), "minhash-open")
    side = lambda x, df: df.select("post", F.col("pivot").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("doc_id", "component", "n_shingles", "s0", "s1", *SKETCH)])
    own, held = open_.filter("pivot = doc_id"), open_.filter("pivot <> doc_id")
    across = (F.col("p") != F.col("q")) & (F.col("p_component") != F.col("q_component")) & _alike("p_", "q_") & _reachable("p_", "q_")
    pair = (F.least("p_doc_id", "q_doc_id").alias("a"), F.greatest("p_doc_id", "q_doc_id").alias("b"))
    # documents that are their own pivots meet as such; those of one pivot meet others only, list by list
    alone = side("p", own).join(side("q", own), "post").filter((F.col("p") < F.col("q")) & across).select(*pair)
    mixed_ = side("p", held).join(side("q", own), "post").filter(across).select(*pair)
    kinds = held.select("post", "pivot").distinct()
    two = kinds.withColumnRenamed("pivot", "p").join(kinds.withColumnRenamed("pivot", "q"), "post").filter("p < q")
    groups = two.join(side("p", held), ["post", "p"]).join(side("q", held), ["post", "q"]).filter(across).select(*pair)
    rest = alone.union(mixed_).union(groups).distinct()
    rest = _likely(rest, reps, matches)
    more = _measured(rest, _full_sets(docs, rest, width)).filter(SIMILAR).select("a", "b").union(beside)

    # rows that share a doc_id tie their classes together
    same = (full.join(classes, ["n_shingles", "lo", "hi"]).filter("doc_id <> rep")
            .select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    twice = signed.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    tied = same.join(twice.withColumnRenamed("doc_id", "b"), "b", "left_semi").select("a", "b")
    stars = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
    found = components(stars.union(more).union(tied))
    out = (signed.join(classes.select("n_shingles", "lo", "hi", "rep"), ["n_shingles", "lo", "hi"], "left")
           .withColumn("node", F.coalesce("rep", "doc_id")))
    found = found.withColumnRenamed("component", "least")
    # a class whose only member shares its id with another row is found under that id
    return (out.withColumn("node", F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.col("node")))
            .join(found, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("least", "node").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
