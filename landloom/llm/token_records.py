"""Token ids of documents as length-delimited binary records with an offset index.

A folder holds one pair of files for every range of documents and a manifest:

* ``part-....rec``: records one behind the other.  A record is the payload's
  length (8 bytes), the masked checksum of these 8 bytes (4), the payload, the
  masked checksum of the payload (4).  The payload is the document's id (8), 1
  if the id is null (2), the bytes of a token id (2), the number of token ids
  (4), the token ids (2 bytes each where the vocabulary has no more than 65,536
  entries, else 4), zeros up to a multiple of 4 bytes.  All numbers are unsigned
  and little-endian; the document's id is signed.
* ``part-....idx``: for every record, and once more behind the last, the place
  of its first byte in the record file and the number of token ids before it in
  that file (8 bytes each).  A record is found without reading others.
* ``manifest.json``: the files in the order of documents with their records,
  token ids and bytes.  It is written last; a folder without it is not complete.

The checksum is CRC-32C, masked by a turn of 15 bits and a constant, so that a
checksum of bytes that hold checksums is no special case.

Documents are dealt out by ranges of their id, so files follow each other in
ascending order and no task holds more than its range.  Files of failed or
repeated tasks have names of their own and never get into the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from . import textblocks as tb
from .token_counts import Counter

NAME = "token_records"
#: CRC-32C (reflected polynomial) and the mask of stored checksums.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
PIECE = 64
#: 32-bit words of a record besides its token ids, and of those before the first token id.
FRAME, FRONT = 8, 7
#: Bytes of records that a reader holds at once, and of a file that one task reads.
READ_BYTES, TASK_BYTES = 1 << 22, 1 << 27


# checksums

def _shifted(images: np.ndarray, states: np.ndarray) -> np.ndarray:
    """States after the zero bytes that ``images`` (of the 32 unit states) stand for."""
    bits = np.arange(256)
    out = np.zeros_like(states)
    for k in range(4):
        table = np.zeros(256, np.uint32)
        for j in range(8):
            table ^= np.where(bits >> j & 1, images[8 * k + j], 0).astype(np.uint32)
        out ^= table[states >> np.uint32(8 * k) & np.uint32(255)]
    return out


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """States by place and value of a byte in a piece, and images of 1, 2, 4 .. zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, byte >> np.uint32(1) ^ np.uint32(POLYNOMIAL), byte >> np.uint32(1)).astype(np.uint32)
    places = np.zeros((PIECE, 256), np.uint32)
    places[-1] = byte
    for k in range(PIECE - 2, -1, -1):
        places[k] = byte[places[k + 1] & np.uint32(255)] ^ places[k + 1] >> np.uint32(8)
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    images = [byte[unit & np.uint32(255)] ^ unit >> np.uint32(8)]
    for _ in range(40):
        images.append(_shifted(images[-1], images[-1]))
    return places, images


def _after_zeros(states: np.ndarray, n: np.ndarray) -> np.ndarray:
    """States after ``n`` zero bytes each."""
    images = _tables()[1]
    for k in range(int(n.max(initial=0)).bit_length()):
        rows = np.flatnonzero(n >> k & 1)
        states[rows] = _shifted(images[k], states[rows])
    return states


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32C of byte ranges of ``data``.

    Ranges are cut into pieces from their end; zeros in front of the first do
    not change a state that begins with zero.  The states of all pieces are
    looked up at once, carried over the bytes behind them and summed.
    """
    size = end - start
    pieces = -(-size // PIECE)
    whole = np.zeros(len(size), np.uint32)
    filled = np.flatnonzero(pieces)
    if len(filled):
        places = _tables()[0]
        n = pieces[filled]
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        behind = np.repeat(first + n, n) - 1 - np.arange(n.sum())  # pieces behind each
        windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(PIECE, np.uint8), data]), PIECE)
        rows = windows[np.repeat(end[filled], n) - PIECE * behind]
        rows[first] *= np.arange(PIECE) >= (n * PIECE - size[filled])[:, None]
        rows = np.ascontiguousarray(rows.T)
        states = np.zeros(rows.shape[1], np.uint32)
        for k in range(PIECE):
            states ^= places[k][rows[k]]
        whole[filled] = np.bitwise_xor.reduceat(_after_zeros(states, behind * PIECE), first)
    ones = np.full(len(size), 0xFFFFFFFF, np.uint32)
    return whole ^ _after_zeros(ones, size) ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(MASK)


# token ids

def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first .. first + size - 1 of every entry, one behind the other."""
    done = np.cumsum(size)
    return np.repeat(first - done + size, size) + np.arange(done[-1] if len(done) else 0)


class Pool:
    """Token ids by name, one behind the other."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.first, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.flat, self.used = np.zeros(1 << 14, np.uint32), 0

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        return array if n <= len(array) else np.concatenate([array, np.zeros(max(len(array), n - len(array)), array.dtype)])

    def find(self, names: list[str]) -> np.ndarray:
        """Numbers of names, -1 for new ones."""
        return np.fromiter(map(self.number.get, names, repeat(-1)), np.int64, len(names))

    def add(self, names: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        known, used = len(self.number), self.used
        self.first, self.size = (self._room(x, known + len(names)) for x in (self.first, self.size))
        self.flat = self._room(self.flat, used + len(ids))
        self.flat[used:used + len(ids)] = ids
        self.first[known:known + len(names)] = used + np.cumsum(size) - size
        self.size[known:known + len(names)] = size
        self.used += len(ids)
        self.number.update(zip(names, range(known, known + len(names))))

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.first[numbers], self.size[numbers])]


class Memory:
    """Names seen lately: what is not asked for while ``limit`` others come is forgotten."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, Pool(), Pool()

    def numbers(self, names: list[str], learn) -> np.ndarray:
        """Places of names (each once) in ``young``; ``learn`` gives ids and sizes of new ones."""
        if len(self.young.number) > self.limit:
            self.young, self.old = Pool(), self.young
        out = self.young.find(names)
        missing = np.flatnonzero(out < 0)
        found = self.old.find([names[i] for i in missing.tolist()])
        for rows, pick in ((missing[found >= 0], True), (missing[found < 0], False)):
            some = [names[i] for i in rows.tolist()]
            if some:
                out[rows] = len(self.young.number) + np.arange(len(rows))
                known = found[found >= 0]
                self.young.add(some, *((self.old.ids(known), self.old.size[known]) if pick else learn(some)))
        return out


class Encoder:
    """Token ids of texts by the library; words that a worker has seen are looked up.

    Words between blanks are encoded on their own where the tokenizer marks word
    ends and makes small letters, as then no token goes across a blank and the
    word's parts count as in :class:`Counter`; other tokenizers get whole texts.
    """

    #: Words and parts of words that a worker remembers.
    REMEMBERED = 120_000
    #: Parts given to the library as one text.
    JOINED = 200

    def __init__(self, path: str):
        own = Counter(path)
        self.tokenizer, self.parts = own.tokenizer, own._parts
        settings = json.loads(self.tokenizer.to_str())
        mark = settings["model"].get("end_of_word_suffix")
        self.by_words = bool(mark) and '"Lowercase"' in json.dumps(settings["normalizer"])
        n = self.tokenizer.get_vocab_size()
        self.width = 2 if n <= 1 << 16 else 4
        self.closing = np.array([bool(mark) and (self.tokenizer.id_to_token(i) or "").endswith(mark) for i in range(n)])
        self.words_, self.parts_ = Memory(self.REMEMBERED), Memory(self.REMEMBERED)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size

    def _learn_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of parts.

        Many parts of letters make one text for the library.  It marks the end
        of at least one word for each; where it marks no more than there are
        parts, the marks tell where each part ends.
        """
        single = np.fromiter(map(str.isalpha, parts), bool, len(parts))
        ids, sizes, order = [], [], []
        letters, others = np.flatnonzero(single), [np.flatnonzero(~single)]
        groups = [letters[k:k + self.JOINED] for k in range(0, len(letters), self.JOINED)]
        for rows, e in zip(groups, self.tokenizer.encode_batch_fast(
                [" ".join([parts[i] for i in rows.tolist()]) for rows in groups], add_special_tokens=False)):
            got = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.closing[got])
            if len(ends) != len(rows) or ends[-1] != len(got) - 1:
                others.append(rows)
                continue
            ids.append(got)
            sizes.append(np.diff(ends, prepend=-1))
            order.append(rows)
        rest = np.concatenate(others)
        got, size = self._library([parts[i] for i in rest.tolist()])
        size, order = np.concatenate([*sizes, size]), np.concatenate([*order, rest])
        at = np.argsort(order)
        return np.concatenate([*ids, got])[spread((np.cumsum(size) - size)[at], size[at])], size[at]

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pairs = [p for w in words for p in self.parts(w)]
        names = list(dict.fromkeys(pairs))
        at = dict(zip(names, self.parts_.numbers(names, self._learn_parts).tolist()))
        number = np.fromiter(map(at.__getitem__, pairs), np.int64, len(pairs))
        pool = self.parts_.young
        return pool.ids(number), pool.size[number].reshape(-1, 2).sum(1)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one behind the other, and the place where each text begins (and the end)."""
        text = pc.fill_null(column.cast(pa.large_string()), "")
        if not self.by_words:
            ids, size = self._library(text.to_pylist())
            return ids, np.concatenate([[0], np.cumsum(size)])
        split = pc.split_pattern(pc.replace_substring(text, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = self.words_.numbers(words, self._learn_words)[np.asarray(coded.indices)]
        cuts, pool = np.asarray(split.offsets, dtype=np.int64), self.words_.young
        return pool.ids(at), np.concatenate([[0], np.cumsum(pool.size[at])])[cuts - cuts[0]]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _list(ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.uint32, copy=False).view(np.int32)))


def _encode(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for block in tb.blocks(batches, "text", 2 * tb.BLOCK_BYTES):
            ids, cuts = own.encode(block.column(1))
            if end_id is not None:
                ids = np.insert(ids, cuts[1:], np.uint32(end_id))
                cuts = cuts + np.arange(len(cuts))
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(np.full(block.num_rows, own.width, np.int32)), _list(ids, cuts)],
                                             ["doc_id", "width", "ids"])
    return run


def encode(docs: DataFrame, path: str, end_id: int | None = None) -> DataFrame:
    """``doc_id``, ``width`` (bytes that hold any id of the vocabulary) and ``ids`` of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(path, end_id), "doc_id long, width int, ids array<int>")


# files

def _folder(path: str):
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def frames(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records of a batch (doc_id, width, ids) as 32-bit words, the first word of each (and the end), and their numbers of ids."""
    doc, width, lists = batch.column(0), np.asarray(batch.column(1), dtype=np.int64), batch.column(2)
    null = np.asarray(doc.is_null())
    n = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    ids = np.asarray(lists.flatten()).view(np.uint32)
    size = -(-n * width // 4)
    begin = np.concatenate([[0], np.cumsum(size + FRAME)])
    out = np.zeros(begin[-1], "<u4")
    at = begin[:-1]
    key = np.asarray(pc.fill_null(doc, 0)).astype("<i8").view("<u4").reshape(-1, 2)
    out[at] = (4 * size + 16 & 0xFFFFFFFF).astype(np.uint32)
    out[at + 1] = (4 * size + 16 >> 32).astype(np.uint32)
    out[at + 3], out[at + 4], out[at + 5], out[at + 6] = key[:, 0], key[:, 1], null + (width << 16), n
    for w, kind in ((2, "<u2"), (4, "<u4")):
        if (width == w).any():
            mine = width == w
            out.view(kind)[spread((at[mine] + FRONT) * (4 // w), n[mine])] = ids if mine.all() else ids[np.repeat(mine, n)]
    raw = out.view(np.uint8)
    out[at + 2] = masked(checksums(raw, 4 * at, 4 * at + 8))
    out[at + 7 + size] = masked(checksums(raw, 4 * at + 12, 4 * (at + 7 + size)))
    return out, begin, n


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about ``READ_BYTES`` bytes of ids, one row at least."""
    total = np.cumsum(4 * np.asarray(pc.list_value_length(batch.column(2)), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + READ_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


class Written(WriterCommitMessage):
    def __init__(self, part: int, name: str | None, records: int, tokens: int, size: int):
        self.part, self.name, self.records, self.tokens, self.size = part, name, records, tokens, size


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, tokenizer: str | None, end_id: int | None):
        self.path, self.overwrite, self.tokenizer, self.end_id = path, overwrite, tokenizer, end_id
        fs, root = _folder(path)
        if not overwrite and fs.get_file_info(f"{root}/manifest.json").is_file:
            raise ValueError(f"{path} holds records; only overwriting is possible")
        fs.create_dir(root, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        fs, root = _folder(self.path)
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        records = tokens = size = 0
        files = None
        for batch in _encode(self.tokenizer, self.end_id)(iterator) if self.tokenizer else iterator:
            for block in _pieces(batch):
                if files is None:
                    files = fs.open_output_stream(f"{root}/{name}.rec"), fs.open_output_stream(f"{root}/{name}.idx")
                words, begin, n = frames(block)
                places = np.stack([size + 4 * begin[:-1], tokens + np.cumsum(n) - n], 1)
                files[0].write(pa.py_buffer(words))
                files[1].write(pa.py_buffer(np.ascontiguousarray(places, "<u8")))
                records, tokens, size = records + len(n), tokens + int(n.sum()), size + 4 * int(begin[-1])
        if files is None:
            return Written(part, None, 0, 0, 0)
        files[1].write(np.array([size, tokens], "<u8").tobytes())
        for f in files:
            f.close()
        return Written(part, name, records, tokens, size)

    def commit(self, messages: list[Written]) -> None:
        fs, root = _folder(self.path)
        done = sorted((m for m in messages if m is not None and m.name), key=lambda m: m.part)
        entries = [{"name": m.name, "records": m.records, "tokens": m.tokens, "bytes": m.size} for m in done]
        with fs.open_output_stream(f"{root}/manifest.json.new") as f:
            f.write(json.dumps({"format": NAME, "files": entries}).encode())
        before = []
        if fs.get_file_info(f"{root}/manifest.json").is_file:
            before = _manifest(self.path)
            fs.delete_file(f"{root}/manifest.json")
        fs.move(f"{root}/manifest.json.new", f"{root}/manifest.json")
        self._delete([e["name"] for e in before])

    def abort(self, messages: list[Written]) -> None:
        self._delete([m.name for m in messages if m is not None and m.name])

    def _delete(self, names: list[str]) -> None:
        fs, root = _folder(self.path)
        for name in names:
            for kind in ("rec", "idx"):
                fs.delete_file(f"{root}/{name}.{kind}")


def _manifest(path: str) -> list[dict]:
    fs, root = _folder(path)
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        return json.loads(f.read())["files"]


class Slice(InputPartition):
    """Records ``lo`` to ``hi`` of a file with ``before`` token ids in earlier files."""

    def __init__(self, name: str, lo: int, hi: int, before: int):
        self.name, self.lo, self.hi, self.before = name, lo, hi, before


def _index(fs, root: str, name: str, lo: int, hi: int) -> np.ndarray:
    """Place and token ids before of records lo .. hi (inclusive: the end of the last)."""
    with fs.open_input_file(f"{root}/{name}.idx") as f:
        f.seek(16 * lo)
        found = f.read(16 * (hi + 1 - lo))
    if len(found) != 16 * (hi + 1 - lo):
        raise ValueError(f"{name}.idx is too short")
    return np.frombuffer(found, "<u8").astype(np.int64).reshape(-1, 2)


def unframed(raw: bytes, begin: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, whether they are null, numbers of token ids and all token ids of records; checks every frame."""
    data = np.frombuffer(raw, np.uint8)
    if len(data) != begin[-1] or (begin % 4).any() or (np.diff(begin) < 4 * FRAME).any():
        raise ValueError(f"{name}: records are cut off")
    words, at = data.view("<u4"), begin[:-1] // 4
    size = np.diff(begin) // 4 - FRAME
    n, width = words[at + 6].astype(np.int64), (words[at + 5] >> np.uint32(16)).astype(np.int64)
    length = words[at].astype(np.int64) | words[at + 1].astype(np.int64) << 32
    good = (words[at + 2] == masked(checksums(data, 4 * at, 4 * at + 8))) & (length == 4 * size + 16)
    good &= ((width == 2) | (width == 4)) & (size == -(-n * width // 4))
    good &= words[at + 7 + size] == masked(checksums(data, 4 * at + 12, 4 * (at + 7 + size)))
    if not good.all():
        raise ValueError(f"{name}: wrong checksum or length at byte {int(begin[np.flatnonzero(~good)[0]])}")
    key = np.stack([words[at + 3], words[at + 4]], 1).copy().view("<i8").ravel()
    ids = np.zeros(int(n.sum()), np.uint32)
    for w, kind in ((2, "<u2"), (4, "<u4")):
        mine = width == w
        if mine.any():
            ids[np.repeat(mine, n)] = data.view(kind)[spread((at[mine] + FRONT) * (4 // w), n[mine])]
    return key, words[at + 5] & np.uint32(1) != 0, n, ids


def _batch(columns: list[str], types: pa.Schema, values: dict) -> pa.RecordBatch:
    key, null, n, ids = values["records"]
    cuts = np.concatenate([[0], np.cumsum(n)])
    made = {
        "doc_id": lambda: pa.array(key, pa.int64(), mask=null),
        "start": lambda: pa.array(values["start"]),
        "n_tokens": lambda: pa.array(n.astype(np.int64)),
        "ids": lambda: _list(ids, cuts),
        "data": lambda: pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((4 * cuts).astype(np.int32)), pa.py_buffer(ids)])}
    return pa.RecordBatch.from_arrays([made[c]().cast(types.field(c).type) for c in columns], columns)


class Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, index: bool):
        self.path, self.columns, self.index = path, schema.names, index
        self.schema = schema

    def partitions(self) -> list[Slice]:
        out, before = [], 0
        for e in _manifest(self.path):
            k = max(1, min(e["records"], -(-e["bytes"] // TASK_BYTES)))
            cuts = [e["records"] * i // k for i in range(k + 1)]
            out += [Slice(e["name"], lo, hi, before) for lo, hi in zip(cuts, cuts[1:])]
            before += e["tokens"]
        return out or [Slice("", 0, 0, 0)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        if part.hi == part.lo:
            return
        fs, root = _folder(self.path)
        places = _index(fs, root, part.name, part.lo, part.hi)
        types = to_arrow_schema(self.schema)
        if self.index:
            n = part.hi - part.lo
            made = {"file": pa.array([part.name] * n), "record": pa.array(np.arange(part.lo, part.hi)), "place": pa.array(places[:-1, 0]),
                    "size": pa.array(np.diff(places[:, 0])), "start": pa.array(places[:-1, 1] + part.before)}
            yield pa.RecordBatch.from_arrays([made[c].cast(types.field(c).type) for c in self.columns], self.columns)
            return
        with fs.open_input_file(f"{root}/{part.name}.rec") as f:
            at = 0
            while at < part.hi - part.lo:
                end = max(at + 1, int(np.searchsorted(places[:, 0], places[at, 0] + READ_BYTES, "right")) - 1)
                f.seek(int(places[at, 0]))
                raw = f.read(int(places[end, 0] - places[at, 0]))
                found = unframed(raw, places[at:end + 1, 0] - places[at, 0], part.name)
                yield _batch(self.columns, types, {"records": found, "start": places[at:end, 1] + part.before})
                at = end


class TokenRecords(DataSource):
    """Spark format ``token_records``.

    Reading gives doc_id, start (token ids of all documents before), n_tokens
    and ids, or the columns of a given schema (``data`` for the ids as bytes, 4
    each).  With the option ``index`` it gives the offset index: file, record,
    place, size, start.

    Writing takes doc_id, width (bytes of a token id), ids; with the option
    ``tokenizer`` it takes doc_id, text and encodes them in the writing task,
    with ``end_id`` behind each document if that option is given.
    """

    COLUMNS = "doc_id long, start long, n_tokens long, ids array<int>"
    INDEX = "file string, record long, place long, size long, start long"

    @classmethod
    def name(cls) -> str:
        return NAME

    def _is_index(self) -> bool:
        return str(self.options.get("index", "false")).lower() == "true"

    def schema(self) -> str:
        return self.INDEX if self._is_index() else self.COLUMNS

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(self.options["path"], schema, self._is_index())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        tokenizer, end_id = self.options.get("tokenizer"), self.options.get("end_id")
        if schema.names != (["doc_id", "text"] if tokenizer else ["doc_id", "width", "ids"]):
            raise ValueError("records are written from doc_id, width, ids, or with a tokenizer from doc_id, text")
        return Writer(self.options["path"], overwrite, tokenizer, None if end_id is None else int(end_id))


def write_records(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = None) -> None:
    """Writes the token ids of ``docs`` (doc_id, text) to the folder ``path`` in ascending order of doc_id.

    Null ids come first; rows with one id are ordered by their text's hash, and
    equal rows are spread by their number, so that no id is a single task's
    work.  A null or empty text has no tokens but ``end_id``, if one is given;
    an empty table gives a folder without records.  Other columns are not
    looked at.  ``tokenizer`` is a file that all executors have; special names
    inside texts are encoded as the library does by default.  An existing
    folder of records is replaced once the new files are complete.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenRecords)
    keys = ["doc_id", "_hash", "_row"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"),
                       F.monotonically_increasing_id().alias("_row"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    sink = ordered.select("doc_id", "text").write.format(NAME).option("tokenizer", tokenizer)
    (sink if end_id is None else sink.option("end_id", str(end_id))).mode("overwrite").save(path)


def read_records(spark: SparkSession, path: str, columns: str = TokenRecords.COLUMNS) -> DataFrame:
    """Records of a folder in the order of the files; every frame is checked, a broken one ends the read with an error."""
    spark.dataSource.register(TokenRecords)
    return spark.read.format(NAME).schema(columns).load(path)


def _fetch(path: str, columns: list[str], types: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _folder(path)
        for batch in batches:
            rows = batch.to_pydict()
            at = 0
            while at < batch.num_rows:  # pieces of bounded size, read by file and place, handed out as they stand
                sizes = np.cumsum(rows["size"][at:])
                end = at + max(1, int(np.searchsorted(sizes, READ_BYTES, "right")))
                found: dict[int, bytes] = {}
                names = sorted(range(at, end), key=lambda i: (rows["file"][i], rows["place"][i]))
                open_name, f = None, None
                for i in names:
                    if rows["file"][i] != open_name:
                        if f:
                            f.close()
                        open_name, f = rows["file"][i], fs.open_input_file(f"{root}/{rows['file'][i]}.rec")
                    f.seek(rows["place"][i])
                    found[i] = f.read(rows["size"][i])
                f.close()
                begin = np.concatenate([[0], np.cumsum([rows["size"][i] for i in range(at, end)])]).astype(np.int64)
                records = unframed(b"".join(found[i] for i in range(at, end)), begin, "shuffled records")
                yield _batch(columns, types, {"records": records, "start": np.array(rows["start"][at:end], np.int64)})
                at = end
    return run


def read_shuffled(spark: SparkSession, path: str, seed: int, columns: str = TokenRecords.COLUMNS) -> DataFrame:
    """All records in a random order that depends on ``seed`` alone.

    Only the offset index is sorted; every task then fetches its records by
    their places.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    spark.dataSource.register(TokenRecords)
    index = spark.read.format(NAME).option("index", "true").load(path)
    # file names differ between runs, positions do not
    order = [F.xxhash64(F.lit(seed), "start", "record"), F.col("start"), F.col("record")]
    kind = _parse_datatype_string(columns)
    return index.orderBy(*order).mapInArrow(_fetch(path, kind.names, to_arrow_schema(kind)), columns)
