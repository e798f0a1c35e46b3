"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Texts are cut where no piece can cross: before every run of the blank mark and
around letters that no longer piece contains.  The words of a batch that are not
yet known are grouped by length and all words of a length advance together, one
letter a step.  At each step the hashes of the last 1 .. longest letters probe
the sorted hashes of the pieces; every hit is a candidate that goes on from an
earlier state, and the largest score of each word is stored with a backpointer.

The candidate's score depends on the kind of the model:

* unigram: score of the best path so far plus the score of the piece.
* BPE: merging is a greedy order, not a sum, but it leaves a trace that a
  Viterbi search can follow: a sequence is the one that merging makes exactly if
  every two neighbours would also be left apart on their own.  So a candidate
  scores 0 if it agrees with the last piece of the state it goes on from, else
  minus infinity.  This gives the ids of the reference library, which a search
  for the largest sum of the scores of a BPE model would not.

Letters without a piece become byte pieces where the model has them, else the
unknown piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textblocks as tb

BLANK = "▁"
#: Words remembered by a worker between batches; a full memory starts anew.
REMEMBERED = 400_000
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.int32(-1)


class Pieces:
    """A model file: pieces, kinds, sorted hashes, and for BPE the last merge of each piece."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models")
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces \
                or not model.normalizer_spec.add_dummy_prefix or not model.normalizer_spec.escape_whitespaces:
            raise ValueError("only models that keep texts as they are and mark blanks")
        self.bpe = model.trainer_spec.model_type == 2
        self.text = [p.piece for p in model.pieces]
        self.kind = np.array([p.type for p in model.pieces])
        self.score = np.array([p.score for p in model.pieces])
        self.unknown = int(np.flatnonzero(self.kind == UNKNOWN)[0])
        self.bytes_ = {int(t[1:-1], 16): i for i, t in enumerate(self.text) if self.kind[i] == BYTE}
        usable = [i for i in range(len(self.text)) if self.kind[i] in (NORMAL, 4) and self.text[i]]
        self.longest = max(len(self.text[i]) for i in usable)
        self.size = np.array([len(t) for t in self.text])
        keys = np.array([hash_text(self.text[i]) for i in usable], tb.U)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usable, np.int32)[order]
        self.own = np.zeros(len(self.text), tb.U)
        self.own[usable] = keys
        # entry points into the sorted keys by their leading bits; most probes end at an empty one
        self.bits = tb.U(64 - 20)
        self.entry = np.searchsorted(self.keys >> self.bits, np.arange((1 << 20) + 1, dtype=tb.U)).astype(np.int32)
        self.filled = np.diff(self.entry) > 0
        self.most = int(np.diff(self.entry).max())
        # letters that only stand alone, and never with another letter in a piece
        joined = {c for i in usable if len(self.text[i]) > 1 for c in self.text[i]}
        self.alone = "".join(c for c in "\n\r\t\x00" if c not in joined)
        crossing = any(BLANK in self.text[i].lstrip(BLANK) for i in usable)
        if crossing:
            raise ValueError("pieces with a blank behind a letter")
        # a piece's rank: the earlier merged, the smaller
        self.rank = np.zeros(len(self.text), np.int64)
        self.rank[np.argsort(-self.score, kind="stable")] = np.arange(len(self.text))
        if self.bpe:
            self._splits(usable)
        output = [self._bytes(i) for i in range(len(self.text))]
        self.out_size = np.array([len(x) for x in output], np.int64)
        self.out_first, self.out = np.cumsum(self.out_size) - self.out_size, np.frombuffer(b"".join(output), np.uint8)

    def _bytes(self, i: int) -> bytes:
        if self.kind[i] == BYTE:
            return bytes([int(self.text[i][1:-1], 16)])
        if self.kind[i] == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if self.kind[i] == CONTROL else self.text[i].replace(BLANK, " ").encode()

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 where there is none."""
        out = np.full(len(hashes), NONE, np.int32)
        top = (hashes >> self.bits).astype(np.int64)
        rows = np.flatnonzero(self.filled[top])
        at, wanted = self.entry[top[rows]], hashes[rows]
        for k in range(self.most):
            place = np.minimum(at + k, len(self.keys) - 1)
            hit = self.keys[place] == wanted
            out[rows[hit]] = self.ids[place[hit]]
        return out

    def _splits(self, usable: list[int]) -> None:
        """Left and right part of each piece's last merge, -1 for letters and pieces that merging never makes."""
        n = len(self.text)
        self.left, self.right = np.full(n, NONE, np.int32), np.full(n, NONE, np.int32)
        known = {self.text[i]: i for i in usable}
        self.made = np.zeros(n, bool)
        for i in usable:
            t = self.text[i]
            if len(t) == 1:
                self.made[i] = True
                continue
            parts = list(t)
            while len(parts) > 1:  # merge t alone; a word of a few letters
                best, at = None, -1
                for k in range(len(parts) - 1):
                    j = known.get(parts[k] + parts[k + 1])
                    if j is not None and (best is None or self.rank[j] < best):
                        best, at = self.rank[j], k
                if best is None:
                    break
                if len(parts) == 2:
                    self.left[i], self.right[i], self.made[i] = known.get(parts[0], -1), known.get(parts[1], -1), True
                parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces ``a`` and ``b`` side by side.

        The merges of both are undone from the latest back; the pair is lost if
        at some time the two neighbouring parts could merge earlier than the one
        undone next.  Of two merges with equal rank the left one comes first.
        """
        ok = np.ones(len(a), bool)
        live = np.flatnonzero((a >= 0) & (b >= 0))  # letters without a piece never merge
        a, b = a[live].copy(), b[live].copy()
        far = np.int64(1) << 40
        limit = np.full(len(live), far)  # twice the rank of the merge undone last, one more for the right side
        while len(live):
            size = (self.size[b]).astype(np.int64)
            joined = self.find(self.own[a] * tb.powers(tb.BASE, 64)[size] + self.own[b])
            merge = np.where(joined >= 0, 2 * self.rank[joined], far)
            bad = merge < limit
            ok[live[bad]] = False
            ra = np.where(self.left[a] >= 0, 2 * self.rank[a], -1)
            rb = np.where(self.left[b] >= 0, 2 * self.rank[b] + 1, -1)
            go = ~bad & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            from_a = ra > rb
            limit = np.where(from_a, ra, rb)
            a, b = np.where(from_a, self.right[a], a), np.where(from_a, b, self.left[b])
        return ok

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (already with blank marks) one behind another, and their number for each word."""
        sizes, parts, order = np.zeros(len(words), np.int64), [], []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lengths):
            group = np.flatnonzero(lengths == n)
            step = max(1, 1_000_000 // int(n * min(n, self.longest)))
            for k in range(0, len(group), step):
                part = group[k:k + step]
                ids, count = self._advance([words[i] for i in part.tolist()], int(n))
                sizes[part] = count
                parts.append(ids)
                order.append(part)
        if not parts:
            return np.zeros(0, np.int32), sizes
        # from the order of lengths back to the order of words
        done = np.concatenate(order)
        begin = np.empty(len(words), np.int64)
        begin[done] = np.cumsum(sizes[done]) - sizes[done]
        end = np.cumsum(sizes)
        place = np.arange(end[-1]) + np.repeat(begin - (end - sizes), sizes)
        return np.concatenate(parts)[place], sizes

    def _advance(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        count = len(words)
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(count, n)
        sums = np.zeros((count, n + 1), tb.U)
        power = tb.powers(tb.BASE, max(64, self.longest + 1))
        for i in range(n):
            sums[:, i + 1] = sums[:, i] * tb.U(tb.BASE) + letter_code(letters[:, i])
        best = np.full((count, n + 1), -np.inf)
        best[:, 0] = 0.0
        piece = np.full((count, n + 1), NONE, np.int32)  # last piece of the best path
        back = np.zeros((count, n + 1), np.int32)  # its length
        least = float(self.score.min()) - 10.0  # the library's score of an unknown letter
        for i in range(1, n + 1):
            open_ = np.arange(count)  # BPE: one candidate fits, so words that have it look no further
            for j in range(max(0, i - self.longest), i):
                found = self.find(sums[open_, i] - sums[open_, j] * power[i - j])
                hit = np.arange(len(open_)) if i - j == 1 else np.flatnonzero(found >= 0)
                if not len(hit):
                    continue
                rows, ids = open_[hit], found[hit]
                if self.bpe:
                    fits = (ids < 0) | self.made[ids]
                    go = np.flatnonzero(fits & (j > 0))
                    fits[go] = self.apart(piece[rows[go], j], ids[go])
                    score = np.where(fits, 0.0, -np.inf)
                else:
                    score = best[rows, j] + np.where(ids >= 0, self.score[ids], least)
                better = score > best[rows, i]
                at = rows[better]
                best[at, i], piece[at, i], back[at, i] = score[better], ids[better], i - j
                if self.bpe and len(at):
                    left = np.ones(len(open_), bool)
                    left[hit[better]] = False
                    open_ = open_[left]
        # backpointers, all words together
        at, steps = np.full(count, n), []
        while at.any():
            live = np.flatnonzero(at)
            steps.append((live, piece[live, at[live]], at[live] - 1))
            at[live] -= back[live, at[live]]
        row = np.concatenate([s[0] for s in steps][::-1])
        ids = np.concatenate([s[1] for s in steps][::-1])
        ends = np.concatenate([s[2] for s in steps][::-1])
        order = np.argsort(row, kind="stable")
        row, ids, ends = row[order], ids[order], ends[order]
        cuts = np.searchsorted(row, np.arange(count + 1))
        if (ids >= 0).all():
            return ids, np.diff(cuts)
        spelled = [self._spelled(ids[a:b], words[k], ends[a:b]) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
        return np.concatenate(spelled), np.fromiter(map(len, spelled), np.int64, count)

    def _spelled(self, ids: np.ndarray, word: str, ends: np.ndarray) -> np.ndarray:
        """Letters without a piece as byte pieces; without those as one unknown piece a run."""
        out: list[int] = []
        for i, e in zip(ids.tolist(), ends.tolist()):
            if i >= 0:
                out.append(i)
            elif self.bytes_:
                out += [self.bytes_[x] for x in word[e].encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, np.int32)

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
        """Texts of ids that lie one behind another; the blank that encoding puts in front of each is taken off."""
        size = self.out_size[ids]
        data = _gather(self.out, self.out_first, self.out_size, ids)
        offsets = np.concatenate([[0], np.cumsum(size)])[cuts]
        first = offsets[:-1][offsets[1:] > offsets[:-1]]
        first = first[data[first] == 0x20]
        data = np.delete(data, first)
        offsets = offsets - np.searchsorted(first, offsets)
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        try:
            return raw.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # ids that no text has
            return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


def letter_code(letters: np.ndarray) -> np.ndarray:
    return tb.mix((letters.astype(tb.U) + tb.U(1)) * tb.U(tb.BASE)) | tb.U(1)


def hash_text(text: str) -> int:
    codes = letter_code(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
    h = 0
    for c in codes.tolist():
        h = (h * tb.BASE + c) & ((1 << 64) - 1)
    return h


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Encoder:
    """Words seen so far and their ids one behind another."""

    def __init__(self, model: Pieces):
        self.model = model
        alone = re.escape(model.alone)
        # runs of blanks go with what follows; letters that stand alone are words of their own
        self.cut = re.compile(f"[{alone}]|{BLANK}*[^{BLANK}{alone}]+|{BLANK}+" if alone else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.first, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, keys: list[str]) -> np.ndarray:
        """Places of ``keys`` among the known words.

        A key is what stands between two blanks.  It stands for the blank mark
        and itself; one that begins with a line feed stands for itself only.
        """
        new = [k for k in keys if k not in self.known]
        if new and len(self.known) + len(new) > REMEMBERED:
            self.clear()
            new = keys
        if new:
            words, per = [], np.zeros(len(new), np.int64)
            for i, k in enumerate(new):
                own = self.cut.findall(k if k[:1] == "\n" else BLANK + k)
                per[i] = len(own)
                words += own
            names = list(dict.fromkeys(words))
            ids, sizes = self.model.encode_words(names)
            at = dict(zip(names, range(len(names))))
            code = np.fromiter((at[w] for w in words), np.int64, len(words))
            ids = _gather(ids, np.cumsum(sizes) - sizes, sizes, code)
            size = np.add.reduceat(sizes[code], np.cumsum(per) - per)
            self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.pool = np.concatenate([self.pool, ids])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        return np.fromiter((self.known[k] for k in keys), np.int64, len(keys))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of ``column`` in one array, and where each text begins and the last ends."""
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        feeds = "\n" in self.model.alone
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n") if feeds else texts, " ")
        coded = split.flatten().dictionary_encode()
        keys = coded.dictionary.to_pylist()
        code, cuts = np.asarray(coded.indices, dtype=np.int64), np.asarray(split.offsets, dtype=np.int64)
        if any(not k or BLANK in k for k in keys):  # blanks next to each other, to a line feed or a mark, or an empty text
            return self._by_runs(texts.to_pylist())
        place = self.learn(keys)[code]
        end = np.concatenate([[0], np.cumsum(self.size[place])])
        return _gather(self.pool, self.first, self.size, place), end[cuts - cuts[0]]

    def _by_runs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [i for i, t in enumerate(texts) if "  " in t or not t or t[0] in " \n" or t[-1] == " " or " \n" in t or BLANK in t]
        plain = sorted({*range(len(texts))} - {*odd})
        out: list = [np.zeros(0, np.int32)] * len(texts)
        if plain:
            ids, cuts = self.encode(pa.array([texts[i] for i in plain], pa.large_string()))
            for i, a, b in zip(plain, cuts[:-1], cuts[1:]):
                out[i] = ids[a:b]
        listed = [self.cut.findall(BLANK + texts[i].replace(" ", BLANK)) if texts[i] else [] for i in odd]
        names = list(dict.fromkeys(w for words in listed for w in words))
        ids, sizes = self.model.encode_words(names)
        at, first = dict(zip(names, range(len(names)))), np.cumsum(sizes) - sizes
        for i, words in zip(odd, listed):
            out[i] = _gather(ids, first, sizes, np.fromiter((at[w] for w in words), np.int64, len(words)))
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.concatenate(out).astype(np.int32), np.concatenate([[0], np.cumsum(sizes)])


def _gather(pool: np.ndarray, first: np.ndarray, size: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The ranges of ``rows`` in ``pool`` one behind another."""
    count = size[rows]
    end = np.cumsum(count)
    return pool[np.arange(end[-1] if len(end) else 0) + np.repeat(first[rows] - (end - count), count)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(pieces(path))


def _encode(path: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for block in tb.blocks(batches, "text"):
            ids, cuts = own.encode(block.column(block.schema.get_field_index("text")))
            out = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*block.columns, out], [*names, "ids"])
    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int): the pieces of the whole ``text``.

    No begin, end or other control piece is added, and their names inside a text
    are ordinary letters.  A null or empty text has no ids.  Other columns come
    through; one named ids is replaced.  ``path`` is a model file that all
    executors have.
    """
    docs = docs.drop("ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_encode(path, docs.columns), f"{fields}, ids array<int>")


#: Ids decoded at once.
DECODED = 1 << 19


def _decode(path: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            flat, cuts = np.asarray(column.flatten()), np.asarray(column.offsets, dtype=np.int64)
            cuts, at = cuts - cuts[0], 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + DECODED, "right")) - 1)
                texts = model.decode(flat[cuts[at]:cuts[end]], cuts[at:end + 1] - cuts[at])
                yield pa.RecordBatch.from_arrays([*batch.slice(at, end - at).columns, texts], [*names, "decoded"])
                at = end
    return run


def _both(path: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for block in tb.blocks(batches, "text"):
            ids, cuts = own.encode(block.column(block.schema.get_field_index("text")))
            out = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*block.columns, out, own.model.decode(ids, cuts)], [*names, "ids", "decoded"])
    return run


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """``decode(encode(docs, path), path)`` in one pass: a task keeps one worker with one set of tables."""
    docs = docs.drop("ids", "decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_both(path, docs.columns), f"{fields}, ids array<int>, decoded string")


def decode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``decoded``: the text of ``ids``.

    Encoding and decoding give back every text without the blank mark U+2581,
    which decodes to a blank.  Control pieces decode to nothing, null or empty
    ids to an empty text; bytes that are no UTF-8 become U+FFFD.
    """
    docs = docs.drop("decoded").withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_decode(path, docs.columns), f"{fields}, decoded string")
