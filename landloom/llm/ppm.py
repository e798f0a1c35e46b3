"""Language model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts of up to ``ORDER`` bytes.  A symbol is coded
in the longest known context; where the context has not seen it, an escape goes
to the next shorter one, which leaves out all symbols the longer one knows
(symbol exclusion).  Escapes are estimated by the number of different symbols of
a context, each of which gives half an occurrence to it (method D).  Below the empty context all symbols left are equal.

``pretrained`` counts all training text in one distributed sum.  Every n-gram
stays in the stored levels; each different n-gram of any text gets its score by
joins with them.  The scores of at most ``HOT`` n-grams, the commonest, are sent
to the tasks; the other places of a text are joined with theirs.  Likewise at
most ``WORD_SHARE`` word counts are sent; rarer words are joined with their
counts.  ``Trie`` is the same model in memory, for small tables.  ``adaptive``
starts each document with an empty trie and learns as it reads.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import log, log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import textblocks as tb
from .minhash import stored

ORDER = 5
HOT = 1_000_000
WORD_SHARE = 4_000_000
#: Bytes that no UTF-8 text has: before the first byte, and behind the last.
START, END = 0xFE, 0xFF
#: Symbols below the empty context: all bytes but START.
SYMBOLS = 255
SMOOTH = 0.1
HELD = 10


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """One number for each byte and each end of text (the byte last, its context before it), and each row's begin."""
    n = len(offsets) - 1
    size = np.diff(offsets) + order + 1
    cuts = np.concatenate([[0], np.cumsum(size)])
    room = np.full(cuts[-1], START, np.uint8)
    room[cuts[1:] - 1] = END
    at = np.arange(len(data)) + np.repeat(cuts[:-1] + order - offsets[:-1], np.diff(offsets))
    room[at] = data
    key = np.zeros(max(len(room) - order, 0), np.int64)
    for t in range(order + 1):
        key = (key << 8) | room[t:len(key) + t]
    begin = cuts[:-1] - np.arange(n) * order
    inside = np.ones(len(key), bool)
    for t in range(order):  # places whose context would reach into the row before
        late = cuts[1:-1] - order + t
        inside[late] = False
    return key[inside], np.concatenate([begin, [inside.sum()]])


def _lower(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tb.byte_view(block.column(block.schema.get_field_index("text")))
    return tb.LOWER[data], offsets


class Sums:
    """Counts by key, added up over blocks; handed on when there are many."""

    def __init__(self, limit: int = 1_500_000):
        self.limit, self.keys, self.counts = limit, [], []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        code, names = pd.factorize(keys)
        self.keys.append(names)
        self.counts.append(np.bincount(code, minlength=len(names)))
        self.size += len(names)
        if self.size > self.limit:
            self._fold()
            if self.size > self.limit // 2:
                yield from self.rest()

    def _fold(self) -> None:
        code, names = pd.factorize(np.concatenate(self.keys))
        self.counts = [np.bincount(code, weights=np.concatenate(self.counts), minlength=len(names)).astype(np.int64)]
        self.keys, self.size = [names], len(names)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.keys:
            self._fold()
            yield self.keys[0], self.counts[0]
            self.keys, self.counts, self.size = [], [], 0


def _count(order: int):
    """Counts of byte n-grams (kind 0), of words (kind 1) and of texts (kind 2); of n-grams of texts held out (kind 3)."""
    def out(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)),
                                           pa.array(counts.astype(np.int64))], ["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram_sums, word_sums, held_sums, texts = Sums(), Sums(), Sums(), 0
        for block in tb.blocks(batches, "text"):
            data, offsets = _lower(block)
            held = block.column(block.schema.get_field_index("held_out")).to_numpy(zero_copy_only=False).astype(bool)
            texts += int((~held).sum())
            keys, cuts = grams(data, offsets, order)
            outside = np.repeat(held, np.diff(cuts))
            for pair in gram_sums.add(keys[~outside]):
                yield out(0, *pair)
            for pair in held_sums.add(keys[outside]):
                yield out(3, *pair)
            starts, ends, row = tb.words(data, offsets)
            for pair in word_sums.add(tb.word_hashes(data, starts, ends).view(np.int64)[~held[row]]):
                yield out(1, *pair)
        for kind, sums in ((0, gram_sums), (1, word_sums), (3, held_sums)):
            for pair in sums.rest():
                yield out(kind, *pair)
        yield out(2, np.zeros(1, np.int64), np.array([texts]))
    return run


class Trie:
    """Contexts of each length with their escapes, and the symbols they know."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        """``levels[o]``: n-grams of o context bytes and a symbol, their counts, the contexts, and how often each comes.

        A context may come more often than its n-grams together; the rest
        escapes, as symbols seldom seen.
        """
        self.order = len(levels) - 1
        self.grams, self.logs, self.nodes = [], [], []
        parent = None
        for o, (key, count, every, often) in enumerate(levels):
            turn = np.argsort(key)
            key, count = key[turn], count[turn].astype(np.float64)
            context, first = np.unique(key >> 8, return_index=True)
            order = np.argsort(every)
            total = often[order][np.searchsorted(every[order], context)].astype(np.float64)
            lost = total - np.add.reduceat(count, first) if len(key) else np.zeros(0)
            kinds = np.diff(np.concatenate([first, [len(key)]])).astype(np.float64)
            node = {"context": context, "total": total, "kinds": kinds, "lost": lost,
                    "escape": np.log((lost + kinds / 2) / total), "all": np.log(total)}
            if parent is not None:
                up = np.searchsorted(parent["context"], context & ((1 << 8 * (o - 1)) - 1))
                low = np.searchsorted(self.grams[-1], key & ((1 << 8 * o) - 1))
                known = np.add.reduceat(self.counts[low], first) if len(key) else np.zeros(0)
                total, kinds = parent["total"][up] - known, parent["kinds"][up] - kinds  # what the shorter context adds
                both, out = np.maximum(total, 0.5), parent["lost"][up] + kinds / 2
                node["down"] = np.where(out > 0, np.log(np.maximum(out, 0.5) / both), 0.0)
                node["rest"] = np.log(both)
                node["sum"] = node["down"] + parent["sum"][up]
            else:
                node |= {"down": np.zeros(len(context)), "rest": np.zeros(len(context)), "sum": np.zeros(len(context))}
            self.counts = count
            self.grams.append(key)
            self.logs.append(np.log(count - 0.5))
            self.nodes.append(node)
            parent = node
        known = len(self.grams[0])
        self.floor = -log(max(SYMBOLS - known, 1))

    @staticmethod
    def _find(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(table):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
        return np.where(table[at] == wanted, at, -1)

    def log10s(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each key after the bytes before it."""
        turn = np.argsort(keys)  # neighbours in the tables are read together
        keys = keys[turn]
        node = [self._find(self.nodes[o]["context"], (keys >> 8) & ((1 << 8 * o) - 1)) for o in range(self.order + 1)]
        gram = [self._find(self.grams[o], keys & ((1 << 8 * (o + 1)) - 1)) for o in range(self.order + 1)]
        longest, known = np.full(len(keys), -1), np.full(len(keys), -1)
        for o in range(self.order + 1):
            longest[node[o] >= 0] = o
            known[gram[o] >= 0] = o
        out = np.full(len(keys), -log(SYMBOLS))  # without any training text
        for m in range(self.order + 1):
            for o in range(-1, m + 1):
                r = np.flatnonzero((longest == m) & (known == o))
                if not len(r):
                    continue
                top = self.nodes[m]
                if o == m:
                    out[r] = self.logs[o][gram[o][r]] - top["all"][node[m][r]]
                    continue
                out[r] = top["escape"][node[m][r]] + top["sum"][node[m][r]]
                above = node[o + 1][r]
                out[r] -= self.nodes[o + 1]["sum"][above]
                if o >= 0:
                    out[r] += self.logs[o][gram[o][r]] - self.nodes[o + 1]["rest"][above]
                else:
                    out[r] += self.nodes[0]["sum"][above] + self.floor
        result = np.empty(len(keys))
        result[turn] = out / log(10)
        return result


def _low(key: Column, size: int) -> Column:
    """The last ``size`` bytes of a key."""
    return key.bitwiseAND(F.lit((1 << 8 * size) - 1))


def _levels(full: DataFrame, order: int) -> list[DataFrame]:
    """Stored levels: each context of o bytes with all its symbols (at most 256) and their counts."""
    key, levels = F.col("key"), []
    for o in range(order, -1, -1):
        level = full.groupBy(F.shiftright(key, 8).alias("context")).agg(F.collect_list(F.struct(
            key.bitwiseAND(F.lit(255)).cast("int").alias("symbol"), "n")).alias("all"))
        levels.append(level := stored(level, "ppm-level"))
        each = level.select("context", F.explode("all").alias("x"))
        full = each.select(_low(F.shiftleft("context", 8).bitwiseOR(F.col("x.symbol").cast("long")), o).alias("key"), F.col("x.n").alias("n"))
        full = full.groupBy("key").agg(F.sum("n").alias("n"))
    return levels[::-1]


def _nodes(level: DataFrame, share: int | None, total: int) -> DataFrame:
    """context, total, lost, kinds and symbols (a map to counts) of the contexts that know a symbol."""
    kept = F.col("all") if share is None else F.filter("all", lambda x: x["n"] * share >= total)
    count = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + x["n"])
    return (level.select("context", count(F.col("all")).alias("total"), kept.alias("kept")).filter(F.size("kept") > 0)
            .select("context", "total", (F.col("total") - count(F.col("kept"))).alias("lost"), F.size("kept").alias("kinds"),
                    F.map_from_entries("kept").alias("symbols")))


def _score_keys(want: DataFrame, nodes: list[DataFrame], o: int, floor: float) -> DataFrame:
    """log_n, start and go_on of each different key of ``want`` (o context bytes and a symbol).

    ``log_n``: of the count less a half, null if the context does not know the
    symbol.  ``start``: log probability of the symbol from this context on.
    ``go_on``: log probability after an escape from this context.  A context
    has at most 256 keys, and a key ends at most 256 longer ones: no join is skewed.
    """
    node = nodes[o]
    if o:
        up = nodes[o - 1].select(F.col("context").alias("up"), *(F.col(c).alias(f"up_{c}") for c in ("total", "lost", "kinds", "symbols")))
        known = F.aggregate(F.map_keys("symbols"), F.lit(0).cast("long"), lambda s, x: s + F.col("up_symbols")[x])
        out = F.col("up_lost") + (F.col("up_kinds") - F.col("kinds")) / 2
        both = F.greatest(F.col("up_total") - known, F.lit(0.5))  # what the shorter context adds
        node = node.join(up, _low(F.col("context"), o - 1) == F.col("up")).select(
            *node.columns, F.log(both).alias("rest"), F.when(out > 0, F.log(F.greatest(out, F.lit(0.5)) / both)).otherwise(0.0).alias("down"))
    found = want.withColumn("context", F.shiftright("key", 8)).join(node, "context", "left").select(
        "key", F.log(F.col("symbols")[F.col("key").bitwiseAND(F.lit(255)).cast("int")] - 0.5).alias("log_n"), F.log("total").alias("log_total"),
        F.log((F.col("lost") + F.col("kinds") / 2) / F.col("total")).alias("escape"), *(["rest", "down"] if o else []))
    start = F.col("log_n") - F.col("log_total")
    if not o:
        return found.select("key", "log_n", F.coalesce(start, F.col("escape") + floor, F.lit(-log(SYMBOLS))).alias("start"), F.lit(floor).alias("go_on"))
    found = stored(found, "ppm-found")
    missing = found.filter("log_n is null").withColumn("low", _low(F.col("key"), o))
    below = _score_keys(missing.select(F.col("low").alias("key")).distinct(), nodes, o - 1, floor).select(
        F.col("key").alias("low"), *(F.col(c).alias(f"low_{c}") for c in ("log_n", "start", "go_on")))
    go_on = F.coalesce(F.col("low_log_n") - F.col("rest"), F.col("down") + F.col("low_go_on"))
    missing = missing.join(below, "low").select("key", "log_n", F.coalesce(F.col("escape") + go_on, F.col("low_start")).alias("start"), go_on.alias("go_on"))
    return found.filter("log_n is not null").select("key", "log_n", start.alias("start"), F.lit(None).cast("double").alias("go_on")).unionAll(missing)


def train(rows: DataFrame, order: int = ORDER, share: int | None = None) -> tuple[DataFrame, DataFrame, int, int]:
    """Stored scores (key, value, seen) of all n-grams of ``rows``; stored word counts (word, c); number of words; number of texts.

    Nothing is learnt from rows held out; their n-grams are scored.  With
    ``share``, n-grams below one part in ``share`` of the training text are left
    out of their contexts and count as escape.
    """
    sums = stored(rows.select("held_out", "text").mapInArrow(_count(order), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")),
                  "ppm-counts")
    full = sums.filter("kind = 0").select("key", "n")
    total = full.agg(F.sum("n")).first()[0] or 0
    nodes = [_nodes(level, share, total) for level in _levels(full, order)]
    first = nodes[0].select("kinds").first()
    floor = -log(max(SYMBOLS - (first[0] if first else 0), 1))
    seen = sums.filter("kind in (0, 3)").groupBy("key").agg(F.sum("n").alias("seen"))
    scores = _score_keys(seen.select("key"), nodes, order, floor).select("key", (F.col("start") / log(10)).alias("value"))
    scores = stored(scores.join(seen, "key"), "ppm-scores")
    counted = sums.filter("kind = 1").select(F.col("key").alias("word"), F.col("n").alias("c"))
    words = counted.agg(F.sum("c")).first()[0] or 0
    texts = sums.filter("kind = 2").agg(F.sum("n")).first()[0] or 0
    return scores, counted, words, texts


def commonest(scores: DataFrame, hot: int) -> DataFrame:
    """The commonest rows of ``scores``, at most ``hot``: whole classes of ``seen``, each a quarter of a power of two wide."""
    kind = F.floor(F.log2("seen") * 4).alias("kind")
    least = None
    for k, n in sorted(scores.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):  # at most 256 classes
        hot -= n
        if hot < 0:
            break
        least = k
    return scores.filter(F.lit(False) if least is None else kind >= least)


def _sorted(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Both columns in the order of the first."""
    table = pairs.toArrow()
    key, value = (x.to_numpy() for x in table.columns)
    turn = np.argsort(key)
    return key[turn], value[turn]


def _score(key: np.ndarray, value: np.ndarray, word: np.ndarray, count: np.ndarray, order: int):
    """Sums over the n-grams and words of the tables; the other n-grams and words, and the number of the words."""
    logs = np.log10(count + SMOOTH)

    def sums(table: np.ndarray, worth: np.ndarray, keys: np.ndarray, row: np.ndarray, n: int):
        code, names = pd.factorize(keys)
        at = Trie._find(table, names)
        known = (at >= 0)[code]
        total = np.bincount(row, weights=np.where(at >= 0, worth[at] if len(worth) else 0.0, 0.0)[code], minlength=n)
        rare = np.flatnonzero(~known)
        cut = np.searchsorted(row[rare], np.arange(n + 1))
        return total, known, pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(keys[rare], pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "text"):
            data, offsets = _lower(block)
            n = block.num_rows
            keys, cuts = grams(data, offsets, order)
            score, _, tail = sums(key, value, keys, np.repeat(np.arange(n), np.diff(cuts)), n)
            starts, ends, row = tb.words(data, offsets)
            base, known, rare = sums(word, logs, tb.word_hashes(data, starts, ends).view(np.int64), row, n)
            sure = np.bincount(row, weights=known, minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*block.columns[:-1], pa.array(np.bincount(row, minlength=n).astype(np.int64)), pa.array(score), pa.array(base), pa.array(sure), rare, tail],
                ["rid", "doc_id", "held_out", "words", "score", "base", "sure", "rare", "tail"])
    return run


def held_out(doc_id, parts: int = HELD):
    """True for the share of documents that nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))


def pretrained(docs: DataFrame, order: int = ORDER, share: int | None = None, word_share: int = WORD_SHARE,
               hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    The levels and the word counts learn from rows that are not held out
    (crc32 of the id as text, modulo 10, is not 0; a null id is learnt from).
    A-Z is lower-cased.  Tokens are the words and one end of text.  ``score`` is
    the log10 probability of all bytes of the text and its end, ``base_score``
    that of the tokens by smoothed counts.  A null or empty text is its end
    only.  Equal rows are learnt as often as they come; other columns are not
    looked at.  Without training text all bytes are equally likely.  All n-grams
    count; a caller who wants a smaller model gives ``share`` (see ``train``).
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scores, counted, words, texts = train(rows, order, share)
    total = words + texts
    frequent = _sorted(counted.filter(F.col("c") * word_share >= words))  # at most ``word_share`` rows
    common = _sorted(commonest(scores, hot).select("key", "value"))  # at most ``hot`` rows
    step = _score(*common, frequent[0], frequent[1].astype(np.float64), order)
    scored = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "text").mapInArrow(
        step, "rid long, doc_id long, held_out boolean, words long, score double, base double, sure long, rare array<long>, tail array<long>")
    scored = stored(scored, "ppm-scored")  # the numbers of the rows hold because they are stored
    # rare words meet their counts; each is rarer than one in ``word_share``, so no key is hot
    rare = (scored.select("rid", F.explode("rare").alias("word")).groupBy("rid", "word").agg(F.count(F.lit(1)).alias("k"))
            .join(counted, "word", "left").withColumn("c", F.coalesce("c", F.lit(0))))
    # so are the n-grams that were not sent: a class of them that is too large to send has no common ones
    tail = scored.select("rid", F.explode("tail").alias("key")).join(scores.select("key", "value"), "key")
    none = F.lit(None).cast("double")
    per = rare.select("rid", (F.col("k") * F.log10(F.col("c") + F.lit(SMOOTH))).alias("more"),
                      F.when(F.col("c") > 0, F.col("k")).alias("found"), none.alias("far")).unionAll(
        tail.select("rid", none.alias("more"), F.lit(None).cast("long").alias("found"), F.col("value").alias("far")))
    per = per.groupBy("rid").agg(*(F.sum(c).alias(c) for c in ("more", "found", "far")))
    kinds = counted.count() + (1 if texts else 0)
    below = log10(total + SMOOTH * (kinds + 1))
    end = log10(texts + SMOOTH)
    zero = F.lit(0)
    return (scored.drop("rare", "tail").join(per, "rid", "left").select(
        "doc_id", "held_out", (F.col("words") + 1).alias("n_tokens"),
        (F.col("sure") + F.coalesce("found", zero) + (1 if texts else 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + end - (F.col("words") + 1) * F.lit(below)).alias("base_score"),
        (F.col("score") + F.coalesce("far", F.lit(0.0))).alias("score")))


def adaptive_log10(text: bytes, order: int = ORDER) -> float:
    """log10 probability of one text by a trie that starts empty and learns each byte after coding it."""
    seen: list[dict[bytes, dict[int, int]]] = [defaultdict(dict) for _ in range(order + 1)]
    room, total = bytes([START]) * order + text + bytes([END]), 0.0
    for i in range(order, len(room)):
        symbol, excluded = room[i], set()
        for o in range(order, -1, -1):
            counts = seen[o].get(room[i - o:i])
            left = {s: c for s, c in counts.items() if s not in excluded} if counts else {}
            if not left:
                continue
            weight = sum(left.values())
            if symbol in left:
                total += log10((left[symbol] - 0.5) / weight)
                break
            total += log10(len(left) / 2 / weight)
            excluded |= left.keys()
        else:
            total -= log10(max(SYMBOLS - len(excluded), 1))
        for o in range(order + 1):
            counts = seen[o][room[i - o:i]]
            counts[symbol] = counts.get(symbol, 0) + 1
    return total


def _adaptive(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "text"):
            data, offsets = _lower(block)
            scores = [adaptive_log10(data[a:b].tobytes(), order) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])
    return run


def adaptive(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id and score of every row by a trie of its own; for texts so odd that no training text covers them."""
    return docs.select("doc_id", "text").mapInArrow(_adaptive(order), "doc_id long, score double")
