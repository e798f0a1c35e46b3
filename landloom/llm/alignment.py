"""Alignment of the tokens that two tokenizers make of the same texts.

Tokens of both sides are laid out by the bytes they cover.  For each batch of
documents ``pandas.merge_asof``, keyed by document, finds for the begin of every
token of one side the token of the other side that covers it.  Both directions
together give all overlapping pairs: of two ranges that overlap, one begins
inside the other.  Places where both sides end a token cut a document into
groups.

The libraries encode each different word once.  A text is cut before a blank
that stands between two other letters; neither tokenizer makes a token across
such a place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textblocks as tb
from .minhash import stored
from .token_records import Memory, spread

BLANK = "▁"
#: Words that a worker remembers, words given to a library as one text, and the mark of words that a library does not give back.
REMEMBERED, JOINED, BAD = 250_000, 300, 0xFFFFFFFF
#: Bytes of text laid out at once; a longer text is laid out part by part.
PART_BYTES = 1 << 20
#: Pair counts handed to every task at most; the rest is joined.
SENT = 1 << 20

# letters beside a blank that may be cut: printable ASCII, and others that no white space begins or ends with
_BEFORE, _AFTER = np.zeros(256, bool), np.zeros(256, bool)
_BEFORE[0x21:0x7F] = _AFTER[0x21:0x7F] = True
_BEFORE[0x80:] = True
_BEFORE[[0x85, 0xA0, 0xA8, 0xA9, 0xAF, 0x9F, *range(0x80, 0x8B)]] = False  # last bytes of white space beyond ASCII
_AFTER[0xC3:] = True
_AFTER[[0xE1, 0xE2, 0xE3]] = False  # first bytes of white space beyond ASCII


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it is printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """Token bytes of a vocabulary by id, and token ids of texts that begin with a blank."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            t.no_truncation()
            t.no_padding()
            letters = byte_letters()
            names = [t.id_to_token(i) or "" for i in range(t.get_vocab_size())]
            self.bytes_ = [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names]
            self.library = lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            import sentencepiece
            s = sentencepiece.SentencePieceProcessor(model_file=path)
            self.bytes_ = [bytes([int(s.id_to_piece(i)[1:-1], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace(BLANK, " ").encode()
                           for i in range(s.get_piece_size())]
            self.library = lambda texts: s.encode([x[1:] for x in texts], num_threads=1)  # the model adds the blank itself
        self.size = np.array([len(b) for b in self.bytes_], np.int64)
        self.first, self.flat = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(self.bytes_), np.uint8)
        width = len(str(len(self.bytes_))) + 1
        self.digits = np.array([list(str(i).encode().ljust(width, b"\0")) for i in range(len(self.bytes_))], np.uint8)
        self.n_digits = np.array([len(str(i)) for i in range(len(self.bytes_))], np.int64)


    def encode(self, words: list[str], size: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of ``size`` bytes, and how many each has.

        ``plain`` words may stand one behind the other: many make one text for
        the library.  Where token ends meet all word ends they tell the words
        apart; else each word of that text is encoded on its own.
        """
        ids, counts, order, others = [], [], [], [np.flatnonzero(~plain)]
        rows = np.flatnonzero(plain)
        groups = [rows[k:k + JOINED] for k in range(0, len(rows), JOINED)]
        for group, found in zip(groups, self.library(["".join([words[i] for i in g.tolist()]) for g in groups])):
            found = np.array(found, np.uint32)
            ends, wanted = np.cumsum(self.size[found]), np.cumsum(size[group])
            at = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
            if ends[-1] != wanted[-1] or (ends[at] != wanted).any():
                others.append(group)
                continue
            ids.append(found)
            counts.append(np.diff(at, prepend=-1))
            order.append(group)
        rest = np.concatenate(others)
        found = self.library([words[i] for i in rest.tolist()]) if len(rest) else []
        count = np.concatenate([*counts, np.fromiter(map(len, found), np.int64, len(found))])
        ids = np.concatenate([*ids, np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))])
        at = np.argsort(np.concatenate([*order, rest]))
        return ids[spread((np.cumsum(count) - count)[at], count[at])], count[at]

    def gives(self, ids: np.ndarray, count: np.ndarray, data: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the token bytes of each word are its bytes in ``data``."""
        ends = np.concatenate([[0], np.cumsum(self.size[ids])])[np.concatenate([[0], np.cumsum(count)])]
        same = np.diff(ends) == size
        rows = np.flatnonzero(same & (size > 0))
        if len(rows):
            mine = self.flat[spread(self.first[ids], self.size[ids])][spread(ends[:-1][rows], size[rows])]
            equal = mine == data[spread((np.cumsum(size) - size)[rows], size[rows])]
            same[rows] = np.logical_and.reduceat(equal, np.cumsum(size[rows]) - size[rows])
        return same


class Aligner:
    """Known words: an entry holds the number of its first side's tokens (``BAD`` where bytes differ) and the ids of both sides."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(path_a), Side(path_b)
        self.known = Memory(REMEMBERED)

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Entries of new words, by both libraries."""
        data, offsets = tb.byte_view(pa.array(words, pa.large_string()))
        size = np.diff(offsets)
        first, last = offsets[:-1], offsets[1:] - 1
        plain = (size > 1) & (data[first] == 0x20) & _AFTER[data[np.minimum(first + 1, len(data) - 1)]] & _BEFORE[data[last]]
        (a, n_a), (b, n_b) = (side.encode(words, size, plain) for side in (self.a, self.b))
        good = self.a.gives(a, n_a, data, size) & self.b.gives(b, n_b, data, size)
        count = 1 + n_a + n_b
        at = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.uint32)
        out[at] = np.where(good, n_a, BAD)
        out[spread(at + 1, n_a)], out[spread(at + 1 + n_a, n_b)] = a, b
        return out, count

    def lay_out(self, word: np.ndarray, doc: np.ndarray, docs: int) -> dict[str, np.ndarray]:
        """Tokens, links and groups of words (numbers) of ``docs`` documents; ``doc`` ascends."""
        sides, pool = [], self.known.young
        first, n_a = pool.first[word], pool.flat[pool.first[word]].astype(np.int64)
        for side, at, count in ((self.a, first + 1, n_a), (self.b, first + 1 + n_a, pool.size[word] - 1 - n_a)):
            ids = pool.flat[spread(at, count)].astype(np.int64)
            end = np.cumsum(side.size[ids])
            sides.append((ids, np.repeat(doc, count), end - side.size[ids], end))
        (a, doc_a, start_a, end_a), (b, doc_b, start_b, end_b) = sides
        # every begin looks for the token of the other side that covers it
        left = pd.DataFrame({"doc": doc_a, "start": start_a, "i": np.arange(len(a))})
        right = pd.DataFrame({"doc": doc_b, "start": start_b, "j": np.arange(len(b))})
        j = pd.merge_asof(left, right, on="start", by="doc")["j"].to_numpy(np.int64)
        i = pd.merge_asof(right, left, on="start", by="doc")["i"].to_numpy(np.int64)
        more = np.flatnonzero(start_a[i] != start_b)  # pairs that begin together are found from both sides
        link_a, link_b = np.concatenate([a, a[i[more]]]), np.concatenate([b[j], b[more]])
        link_doc = np.concatenate([doc_a, doc_b[more]])
        ends = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, bool)
        ends[end_b] = True
        last_a = ends[end_a]
        ends[:] = False
        ends[end_a] = True
        last_b = ends[end_b]
        return {"n_a": np.bincount(doc_a, minlength=docs), "n_b": np.bincount(doc_b, minlength=docs),
                "n_groups": np.bincount(doc_a[last_a], minlength=docs), "n_links": np.bincount(link_doc, minlength=docs),
                "link": (link_doc * len(self.a.size) + link_a) * len(self.b.size) + link_b,
                "text": self._written(a, b, last_a, last_b, doc_a, doc_b, docs)}

    def _written(self, a, b, last_a, last_b, doc_a, doc_b, docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Groups of all documents as text: bytes, and the end of each document in them."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        at_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
        at_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
        width = max(self.a.digits.shape[1], self.b.digits.shape[1])
        rows = np.zeros((len(a) + len(b), width), np.uint8)
        rows[at_a, :self.a.digits.shape[1]] = self.a.digits[a]
        rows[at_b, :self.b.digits.shape[1]] = self.b.digits[b]
        closing = np.zeros(len(doc_b), bool)  # nothing stands behind the last group of a document
        closing[:-1] = doc_b[1:] != doc_b[:-1]
        closing[-1:] = True
        rows[at_a, self.a.n_digits[a]] = np.where(last_a, ord("|"), ord(","))
        rows[at_b, self.b.n_digits[b]] = np.where(closing, 0, np.where(last_b, ord(";"), ord(",")))
        flat = rows.ravel()
        size = np.bincount(doc_a, self.a.n_digits[a] + 1, docs) + np.bincount(doc_b, self.b.n_digits[b] + ~closing, docs)
        return flat[flat != 0], np.cumsum(size).astype(np.int64)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def cut_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, each text with a blank before it, and the text each word is of; empty texts have none."""
    full = pc.fill_null(column.cast(pa.large_string()), "")
    some = np.flatnonzero(np.asarray(pc.binary_length(full)) > 0)
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), full.take(pa.array(some, pa.int64())), pa.scalar(" ", pa.large_string()))
    data, offsets = tb.byte_view(spaced)
    blank = np.flatnonzero(data[1:-1] == 0x20) + 1
    blank = blank[_BEFORE[data[blank - 1]] & _AFTER[data[blank + 1]]]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets], cut[blank] = True, True
    cuts = np.flatnonzero(cut)
    # a text ends in a letter, then the blank of the next one follows: it is an offset already
    words = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data))
    return words, some[np.searchsorted(offsets, cuts[:-1], "right") - 1]


def _parts(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words of about twice ``PART_BYTES`` bytes: a block of several texts is one range."""
    total, out, at = np.cumsum(sizes), [], 0
    while at < len(sizes):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + 2 * PART_BYTES, "right")))
        out.append((at, end))
        at = end
    return out


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for block in tb.blocks(batches, "text", PART_BYTES):
            docs = block.num_rows
            words, doc = cut_words(block.column(2))
            coded = words.dictionary_encode()
            word = own.known.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), own.learn)[np.asarray(coded.indices)]
            pool = own.known.young
            bad = np.bincount(doc, pool.flat[pool.first[word]] == BAD, docs) > 0
            keep = ~bad[doc]
            sizes = np.diff(np.frombuffer(words.buffers()[1], np.int64))[keep]
            word, doc = word[keep], doc[keep]
            count = {c: np.zeros(docs, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
            texts, links, times = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
            ends = np.zeros(docs, np.int64)
            for lo, hi in _parts(sizes):  # more than one only for a single long text
                laid = own.lay_out(word[lo:hi], doc[lo:hi], docs)
                for c in count:
                    count[c] += laid[c]
                if texts:
                    texts.append(np.frombuffer(b";", np.uint8))
                    ends += 1
                texts.append(laid["text"][0])
                ends += laid["text"][1]
                new = np.sort(laid["link"])  # document, first id, second id
                first = np.flatnonzero(np.diff(new, prepend=-1))
                links, times = np.concatenate([links, new[first]]), np.concatenate([times, np.diff(first, append=len(new))])
                if len(links) > len(first):
                    order = np.argsort(links, kind="stable")
                    links, n = links[order], times[order]
                    first = np.flatnonzero(np.diff(links, prepend=-1))
                    links, times = links[first], np.add.reduceat(n, first)
            owner, links = np.divmod(links, len(own.a.size) * len(own.b.size))
            links = links // len(own.b.size) << 32 | links % len(own.b.size)
            text = np.concatenate([np.zeros(0, np.uint8), *texts])
            cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=docs))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), *[pa.array(count[c]) for c in count],
                 pa.LargeStringArray.from_buffers(docs, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(text)).cast(pa.string()),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(links)), pa.ListArray.from_arrays(pa.array(cuts), pa.array(times.astype(np.int32)))],
                ["row", "doc_id", *count, "groups", "pairs", "times"])
    return run


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Tokens of both tokenizers laid against each other, for every row of ``docs`` (doc_id, text).

    ``groups`` names the token ids between places where both sides end a token
    (``a1,a2|b1;a3|b2,b3``); ``pairs`` are the different pairs of overlapping
    tokens (first id times 2**32 plus second id) and ``times`` how often each
    occurs.  ``row`` numbers the rows and holds once the result is stored.

    Null and empty texts, and texts that one side does not give back byte by
    byte with the blank before them, have no tokens.  A null doc_id and equal
    rows keep their rows; an empty table gives none; other columns are not
    looked at.  Both files must stand at the same place on all executors; a
    ``.json`` file is a byte-level vocabulary, others are piece models.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_align(path_a, path_b), ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``docs`` (rows that hold it) and ``best`` (no pair of its first id is in more rows)."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    first = F.shiftright("pair", 32).alias("first")
    most = counts.groupBy(first).agg(F.max("docs").alias("most"))
    return stored(counts.withColumn("first", first).join(most, "first").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pair-best")


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, best = sent.value
        for batch in batches:
            pairs, times = batch.column(1), batch.column(2)
            size = np.asarray(pc.list_value_length(pairs), dtype=np.int64)
            pair, n = np.asarray(pairs.flatten()), np.asarray(times.flatten()).astype(np.int64)
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            found = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            ends = np.concatenate([[0], np.cumsum(size)])
            summed = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])
            hit = lambda values: n * np.where(found, values[at] if len(keys) else 0, 0)
            rest = np.flatnonzero(~found)
            cuts = np.concatenate([[0], np.cumsum(~found)])[ends]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(summed(hit(best))), pa.array(summed(hit(docs))),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                     [pa.array(pair[rest]), pa.array(n[rest])], ["pair", "n"]))],
                ["row", "n_best", "count_sum", "rest"])
    return run


def link_scores(aligned: DataFrame, counts: DataFrame, sent: int = SENT) -> DataFrame:
    """``row``, ``n_best`` (links whose pair is the best of its first id) and ``count_sum`` (rows of the pair, over all links).

    The counts of the commonest pairs, ``sent`` at most, go to all tasks; pairs
    beyond them are joined, so every link counts.  Both tables must be stored.
    """
    kind = F.floor(F.log2("docs")).cast("int")
    room, least = sent, 64
    for k, n in sorted(counts.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):  # at most 63 kinds
        if n > room:
            break
        room, least = room - n, k
    table = counts.filter(kind >= least).toArrow().sort_by("pair")
    arrays = tuple(np.asarray(table.column(c).combine_chunks()) if table.num_rows else np.zeros(0, t)
                   for c, t in (("pair", np.int64), ("docs", np.int64)))
    best = np.asarray(table.column("best").combine_chunks().cast(pa.int8())).astype(bool) if table.num_rows else np.zeros(0, bool)
    handed = aligned.sparkSession.sparkContext.broadcast((*arrays, best))
    rows = aligned.select("row", "pairs", "times").mapInArrow(
        _score(handed), "row long, n_best long, count_sum long, rest array<struct<pair: long, n: long>>")
    if least == 0:
        return rows.drop("rest")
    rows = stored(rows, "pair-scores")
    rare = counts.filter(kind < least)
    more = (rows.select("row", F.inline("rest")).join(rare, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("b"), F.sum(F.col("n") * F.col("docs")).alias("c")))
    none = F.lit(0).cast("long")
    return rows.join(more, "row", "left").select("row", (F.col("n_best") + F.coalesce("b", none)).alias("n_best"),
                                                 (F.col("count_sum") + F.coalesce("c", none)).alias("count_sum"))
