"""Token counts of whole texts as the tokenizer's own library gives them.

White space always ends a token of the tokenizers meant here (their splitter
drops it), so a text's count is the sum over its words.  Ordinary texts are cut
at blanks and line feeds, each different word of a batch is encoded once by the
library and its count looked up for all its occurrences.

Huge texts are not left to one task.  They are cut into chunks that overlap, the
chunks are spread over tasks and encoded with offsets.  Two neighbours are
spliced at a place where both begin a token behind white space: what stands left
and right of such a place is encoded independently, so both encodings agree with
that of the whole text from there on.  Where an overlap holds no such place, all
chunks of the text are cut again with a wider overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textblocks as tb
from .minhash import stored

#: Letters of a text that is cut, of a chunk, and of the first overlap.
HUGE = 1 << 16
CHUNK = 1 << 14
OVERLAP = 1 << 9
WIDER = 8
#: Words remembered by a worker between batches; a full memory starts anew.
REMEMBERED = 1_000_000
ENDINGS = ".,;:!?#*$%&|"


class Counter:
    """Counts of words by the library; what a worker has seen it looks up."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.seen: dict[str, int] = {"": 0}

    def words(self, words: list[str]) -> np.ndarray:
        if len(self.seen) > REMEMBERED:
            self.seen = {"": 0}
        parts = [self._parts(w) for w in words]
        new = list(dict.fromkeys(p for pair in parts for p in pair if p not in self.seen))
        for at in range(0, len(new), 50_000):
            some = new[at:at + 50_000]
            self.seen.update(zip(some, map(len, self.tokenizer.encode_batch_fast(some, add_special_tokens=False))))
        seen = self.seen
        return np.fromiter((seen[a] + seen[b] for a, b in parts), np.int64, len(words))

    @staticmethod
    def _parts(word: str) -> tuple[str, str]:
        """The word in small letters without closing marks, and the marks, where that cannot change the count.

        The splitter never joins a letter and a closing mark but in the endings
        that begin with an apostrophe; special names and letters beyond ASCII
        (whose small forms may combine otherwise) are left alone.
        """
        if "'" in word or "<|" in word:
            return word, ""
        stem = word.rstrip(ENDINGS)
        if stem != word and (not stem or not stem[-1].isalpha()):
            stem = word
        return stem.lower() if stem.isascii() else stem, word[len(stem):]

    def starts(self, texts: list[str]) -> list[np.ndarray]:
        """Begin of every token of every text."""
        return [np.array([a for a, _ in e.offsets], np.int64)
                for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def _count(path: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for block in tb.blocks(batches, "text", 4 * tb.BLOCK_BYTES):
            text = pc.fill_null(block.column(block.schema.get_field_index("text")).cast(pa.large_string()), "")
            split = pc.split_pattern(pc.replace_substring(text, "\n", " "), " ")
            coded = split.flatten().dictionary_encode()
            counts = own.words(coded.dictionary.to_pylist())
            total = np.concatenate([[0], np.cumsum(counts[np.asarray(coded.indices)])])
            cuts = np.asarray(split.offsets, dtype=np.int64)
            n = total[cuts[1:] - cuts[0]] - total[cuts[:-1] - cuts[0]]
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(n)], [*names, "n_tokens"])
    return run


def _cut(chunk: int):
    """Overlapping chunks of each text: rid, chunk number, number of chunks, first place, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rid, overlap, text = (batch.column(k)[i].as_py() for k in range(3))
                first = list(range(0, max(len(text) - overlap, 1), chunk))
                last = len(first) - 1
                for at in range(0, len(first), 64):
                    some = first[at:at + 64]
                    n = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rid] * n, pa.int64()), pa.array([overlap] * n, pa.int64()), pa.array(range(at, at + n), pa.int64()),
                         pa.array([last + 1] * n, pa.int64()), pa.array(some, pa.int64()),
                         pa.array([text[a:] if at + k == last else text[a:a + chunk + overlap] for k, a in enumerate(some)], pa.string())],
                        ["rid", "overlap", "chunk", "chunks", "first", "text"])
    return run


def _encode(path: str, chunk: int):
    """Tokens of each chunk, with the token begins and splice places in both overlaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for block in tb.blocks(batches, "text"):
            rows = block.to_pylist()
            out = []
            for r, s in zip(rows, own.starts([r["text"] for r in rows])):
                stable = np.array([p for p in np.unique(s).tolist() if p and r["text"][p - 1] in " \n"], np.int64)
                head = s[s < r["overlap"]] if r["chunk"] else s[:0]
                tail = s[s >= chunk] if r["chunk"] < r["chunks"] - 1 else s[:0]
                zone = lambda x, lo, hi: (x[(x >= lo) & (x < hi)] + r["first"]).tolist()
                out.append((r["rid"], r["chunk"], r["chunks"], len(s), (head + r["first"]).tolist(), (tail + r["first"]).tolist(),
                            zone(stable, 1, r["overlap"]) if r["chunk"] else [],
                            zone(stable, chunk + 1, chunk + r["overlap"]) if r["chunk"] < r["chunks"] - 1 else []))
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             ["rid", "chunk", "chunks", "n", "head", "tail", "left_places", "right_places"])
    return run


def huge_counts(texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """rid, n_tokens of texts (rid, text) by overlapping chunks."""
    done, todo = None, texts.select("rid", F.lit(overlap).cast("long").alias("overlap"), "text")
    while True:
        parts = (todo.mapInArrow(_cut(chunk), "rid long, overlap long, chunk long, chunks long, first long, text string")
                 .repartition(F.col("rid"), F.col("chunk"))
                 .mapInArrow(_encode(path, chunk), "rid long, chunk long, chunks long, n long, head array<long>, tail array<long>, "
                             "left_places array<long>, right_places array<long>"))
        parts = stored(parts, "token-chunks")
        left = parts.select("rid", (F.col("chunk") + 1).alias("chunk"), "tail", "right_places")
        right = parts.filter("chunk > 0").select("rid", "chunk", "head", "left_places")
        seam = (left.join(right, ["rid", "chunk"])
                .withColumn("place", F.array_min(F.array_intersect("left_places", "right_places")))
                .select("rid", "place", (F.size(F.filter("tail", lambda p: p >= F.col("place")))
                                         + F.size(F.filter("head", lambda p: p < F.col("place")))).alias("twice")))
        lost = seam.filter("place is null").select("rid").distinct()
        total = parts.groupBy("rid").agg(F.sum("n").alias("n"))
        twice = seam.groupBy("rid").agg(F.sum("twice").alias("twice"))
        good = (total.join(lost, "rid", "left_anti").join(twice, "rid", "left")
                .select("rid", (F.col("n") - F.coalesce("twice", F.lit(0))).alias("n_tokens")))
        done = good if done is None else done.union(good)
        again = stored(texts.join(lost, "rid").select("rid", "text"), "token-again")
        if again.isEmpty():
            return done
        overlap *= WIDER  # ends when the overlap is longer than the text: then it is one chunk
        todo = again.select("rid", F.lit(overlap).cast("long").alias("overlap"), "text")


def count_tokens(docs: DataFrame, path: str, huge: int = HUGE) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``docs`` (doc_id, text).

    Counts are those of the library without begin, end or other added pieces;
    names of special pieces inside a text count as the library counts them.
    Null and empty texts have no bytes and no tokens; a null doc_id and equal
    rows keep their rows; other columns are not looked at.  ``path`` is a
    tokenizer file that all executors have.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long").alias("n_bytes")
    plain = (rows.filter(F.char_length("text") <= huge).select("doc_id", size, "text")
             .mapInArrow(_count(path, ["doc_id", "n_bytes", "text"]), "doc_id long, n_bytes long, text string, n_tokens long")
             .drop("text"))
    # numbers for the long rows hold because the rows are stored with them
    long_ = stored(rows.filter(F.char_length("text") > huge).withColumn("rid", F.monotonically_increasing_id()), "token-huge")
    counts = huge_counts(long_.select("rid", "text"), path)
    return plain.union(long_.select("rid", "doc_id", size).join(counts, "rid").select("doc_id", "n_bytes", "n_tokens"))
