"""Removal of repeated passages by suffix arrays of the places that can repeat.

Step 1 cuts every text into segments: neighbouring windows of ``SIZE`` bytes
whose leftmost smallest hash among their ``GRAM``-byte parts stands at the same
place.  That hash is the segment's key.  Equal windows have equal parts, so they
fall into segments with the same key, wherever they stand, and two windows of
one segment differ.  A key that comes once holds no repeat.  A key whose segments are all equal
byte for byte holds nothing but repeats.

Step 2 takes one segment of each different content under the other keys, and
sorts the windows of all segments of a key in one suffix array by two-stage
sorting: suffixes smaller than their successor are sorted directly, all others
are induced bucket by bucket from the order of what follows them.  A window is a
repeat where the common prefix with a neighbour reaches ``SIZE``.

A key with more than ``HOT_SEGMENTS`` different segments is too much for one
task.  Step 3 cuts its segments into pieces of 16 neighbouring windows, counted
from the place of the key.  All windows of a piece share their middle, 185 bytes
of the 200, and its hash is the new key; equal windows have equal middles.
Middles that come once hold no repeat, pieces that are all equal are repeats, the
others are sorted as in step 2.  Where a middle is hot again, pieces of 4 windows
share 197 bytes, and pieces of one window are their own middle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textblocks as tb
from .minhash import stored

SIZE = 200
GRAM = 64
HOT_SEGMENTS = 1000
#: Windows of a piece of a hot key's segment, step by step.
PIECES = (16, 4, 1)
#: Bytes sorted at once; a key's segments stay together.
SORT_BYTES = 1 << 20
#: Codes of nine bits (a byte plus one, 0 ends a segment) packed into one word.
PACKED = 7


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by running minima from both sides of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    rows = -(-len(values) // width)
    square = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    square[:len(values)] = values
    square = square.reshape(rows, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def _segments(size: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "text"):
            data, offsets = tb.byte_view(block.column(2))
            ends = np.repeat(offsets[1:], np.diff(offsets))
            if len(data) < size:
                continue
            rolling = tb.Rolling(data)
            grams = rolling.windows(gram)
            # least by the upper half of the hash, the leftmost of equal ones
            half = tb.U(32)
            least = sliding_least((grams >> half << half) | np.arange(len(grams), dtype=tb.U), size - gram + 1)
            starts = np.flatnonzero(np.arange(len(least)) + size <= ends[:len(least)])
            if not len(starts):
                continue
            at = (least[starts] & tb.U(0xFFFFFFFF)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            count = np.diff(np.concatenate([first, [len(starts)]]))
            begin, key = starts[first], grams[at[first]]
            row = np.searchsorted(offsets, begin, "right") - 1
            content = rolling.ranges(begin, begin + count + size - 1)
            rows, at = np.unique(row, return_index=True)
            cuts = pa.array(np.concatenate([at, [len(row)]]), pa.int32())
            listed = lambda x: pa.ListArray.from_arrays(cuts, pa.array(x))
            yield pa.RecordBatch.from_arrays(
                [block.column(0).take(pa.array(rows)), block.column(1).take(pa.array(rows)), listed(key.view(np.int64)),
                 listed(content.view(np.int64)), listed((begin - offsets[row]).astype(np.int32)), listed(count.astype(np.int32))],
                ["doc_id", "th", "key", "content", "start", "windows"])
    return run


def _cut(size: int, names: list[str]):
    """Bytes of the wanted segments or pieces of each text, with the fields ``names`` of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "text"):
            data, offsets = tb.byte_view(block.column(0))
            wanted, view = block.column(1), memoryview(data)
            cuts = np.asarray(wanted.offsets, dtype=np.int64)
            parts = wanted.flatten()
            start, windows = np.asarray(parts.field("start"), dtype=np.int64), np.asarray(parts.field("windows"), dtype=np.int64)
            begin = start + np.repeat(offsets[:-1], np.diff(cuts))
            taken = [bytes(view[a:b]) for a, b in zip(begin.tolist(), (begin + windows + size - 1).tolist())]
            yield pa.RecordBatch.from_arrays([*(parts.field(n) for n in names), pa.array(taken, pa.binary())], [*names, "bytes"])
    return run


def _leads(size: int, gram: int):
    """Adds ``lead``, the place of a segment's key in its first window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "bytes"):
            data, offsets = tb.byte_view(block.column(3))
            grams, half = tb.Rolling(data).windows(gram), tb.U(32)
            least = sliding_least((grams >> half << half) | np.arange(len(grams), dtype=tb.U), size - gram + 1)
            lead = (least[offsets[:-1]] & tb.U(0xFFFFFFFF)).astype(np.int64) - offsets[:-1]
            yield pa.RecordBatch.from_arrays([*(block.column(k) for k in range(4)), pa.array(lead.astype(np.int32))],
                                             ["key", "content", "windows", "bytes", "lead"])
    return run


def _pieces(size: int, width: int):
    """Pieces of at most ``width`` windows whose key stands in the same ``width`` places, named by what all these windows share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "bytes"):
            data, offsets = tb.byte_view(block.column(3))
            rolling = tb.Rolling(data)
            lead, windows = np.asarray(block.column(4), dtype=np.int64), np.asarray(block.column(2), dtype=np.int64)
            last = lead - windows + 1  # place of the key in the last window
            n = lead // width - last // width + 1
            row = np.repeat(np.arange(len(n)), n)
            slot = (lead // width)[row] - (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
            high, low = np.minimum(lead[row], slot * width + width - 1), np.maximum(last[row], slot * width)
            anchor = offsets[row] + lead[row]
            shared = rolling.ranges(anchor - slot * width, anchor - slot * width - width + 1 + size)
            name = tb.mix(shared + np.asarray(block.column(0), dtype=np.int64)[row].view(tb.U) * tb.U(tb.BASE) + slot.astype(tb.U))
            content = rolling.ranges(anchor - high, anchor - low + size)
            index, small = pa.array(row), lambda x: pa.array(x.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [block.column(0).take(index), block.column(1).take(index), small(lead[row] - high), small(high - low + 1), small(high),
                 pa.array(name.view(np.int64)), pa.array(content.view(np.int64))],
                ["of_key", "of_content", "start", "windows", "lead", "key", "content"])
    return run


def packed(codes: np.ndarray) -> np.ndarray:
    """The next ``PACKED`` codes of every position as one number; zeros beyond the end."""
    room = np.zeros(len(codes) + PACKED, np.int64)
    room[:len(codes)] = codes
    out = np.zeros(len(codes), np.int64)
    for k in range(PACKED):
        out = (out << 9) | room[k:k + len(codes)]
    return out


def direct_order(pos: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``pos`` in order of their first ``depth`` codes; ties of that length stay in any order."""
    at = lambda p: words[np.minimum(p, len(words) - 1)] * (p < len(words))
    key = at(pos)
    turn = np.argsort(key, kind="stable")
    pos, key = pos[turn], key[turn]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(pos) else np.zeros(0, bool)
    for d in range(PACKED, depth, PACKED):
        alone = new & np.concatenate([new[1:], [True]])
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        key = at(pos[tied] + d)
        turn = np.lexsort((key, group))
        pos[tied] = pos[tied][turn]
        key = key[turn]
        new[tied[1:]] |= key[1:] != key[:-1]
    return pos


def two_stage_order(codes: np.ndarray, need: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``need`` (a mask) in order of their suffixes up to ``depth`` codes.

    Stage 1 sorts the suffixes that are smaller than their successor.  Stage 2
    goes through the buckets of the first code upwards.  Any other suffix begins
    with a run of one code and goes on with a smaller one, whose bucket is done:
    within its bucket it is ordered by the length of the run, then by the rank of
    what follows, and stands before the directly sorted ones.
    """
    n = len(codes)
    change = np.flatnonzero(codes[1:] != codes[:-1]) + 1
    run = np.zeros(n, np.int64)
    run[change] = 1
    follow = np.concatenate([change, [n]])[np.cumsum(run)]  # first place after the run
    after = np.concatenate([codes, [0]])[follow]
    smaller = (after > codes) & (codes > 0)
    chosen = need & (codes > 0)
    edge = np.flatnonzero(chosen & ~smaller)
    while len(edge):  # what an induced suffix goes on with has to be ordered too; codes fall, so this ends
        to = np.unique(follow[edge][after[edge] > 0])
        to = to[~chosen[to]]
        chosen[to] = True
        edge = to[~smaller[to]]
    direct = direct_order(np.flatnonzero(chosen & smaller), words, depth)
    induced = np.flatnonzero(chosen & ~smaller)
    induced = induced[np.argsort(codes[induced], kind="stable")]
    cuts_d = np.searchsorted(codes[direct], np.arange(1, 259))
    cuts_i = np.searchsorted(codes[induced], np.arange(1, 259))
    rank = np.full(n + 1, -1, np.int64)
    order, filled = np.empty(len(direct) + len(induced), np.int64), 0
    for c in range(257):
        part = induced[cuts_i[c]:cuts_i[c + 1]]
        if len(part):
            part = part[np.lexsort((np.where(after[part] > 0, rank[follow[part]], -1), follow[part] - part))]
        part = np.concatenate([part, direct[cuts_d[c]:cuts_d[c + 1]]])
        order[filled:filled + len(part)] = part
        rank[part] = np.arange(filled, filled + len(part))
        filled += len(part)
    return order[need[order]]


def reaches(p: np.ndarray, q: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Whether the common prefix of the suffixes at ``p`` and ``q`` has at least ``depth`` codes."""
    left = np.arange(len(p))
    for d in range(0, depth, PACKED):
        drop = 9 * max(0, d + PACKED - depth)
        left = left[(words[p[left] + d] >> drop) == (words[q[left] + d] >> drop)]
    out = np.zeros(len(p), bool)
    out[left] = True
    return out


def repeated_windows(parts: list[bytes], windows: np.ndarray, size: int) -> list[np.ndarray]:
    """Mask over the windows of each part: does the window stand anywhere else in ``parts``?"""
    lengths = np.array([len(x) + 1 for x in parts])
    begin = np.concatenate([[0], np.cumsum(lengths)])
    codes = np.zeros(begin[-1], np.int16)
    codes[:] = np.frombuffer(b"\0".join([*parts, b""]), np.uint8)
    codes += 1
    codes[begin[1:] - 1] = 0
    need = np.zeros(len(codes) + 1, np.int64)
    np.add.at(need, begin[:-1], 1)
    np.add.at(need, begin[:-1] + windows, -1)
    need = np.cumsum(need)[:-1] > 0
    words = packed(codes)
    order = two_stage_order(codes, need, words, size)
    same = reaches(order[:-1], order[1:], words, size)
    found = np.zeros(len(codes), bool)
    found[order[:-1][same]] = True
    found[order[1:][same]] = True
    return [found[a:a + w] for a, w in zip(begin[:-1], windows)]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    at = np.flatnonzero(edge == 1)
    return at, np.flatnonzero(edge == -1) - at


def _sorted_keys(size: int):
    """Repeated windows of each segment; rows come in order of key and content."""
    def settle(rows: list[tuple]) -> pa.RecordBatch:
        masks = repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows]), size)
        out = [(r[0], r[1], int(a), int(c)) for r, m in zip(rows, masks) if m.any() for a, c in zip(*_runs(m))]
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                          ["key", "content", "at", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, seen = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if row[:2] == seen:
                    continue  # equal documents name the same segment
                if total > SORT_BYTES and row[0] != seen[0]:
                    yield settle(rows)
                    rows, total = [], 0
                seen = row[:2]
                rows.append(row)
                total += len(row[3])
        if rows:
            yield settle(rows)
    return run


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose key comes twice; ``plain`` if all of the key have the same content."""
    keys = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"))
            .filter("n > 1").select("key", (F.col("lo") == F.col("hi")).alias("plain")))
    return rows.join(keys, "key")


def _kinds(members: DataFrame, place: list[str]) -> DataFrame:
    """One row for each different content of a key that is not plain: how often it comes, and where it stands once."""
    return (members.filter("not plain").groupBy("key", "content")
            .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*place)).alias("one")))


def _placed(members: DataFrame, kinds: DataFrame, found: DataFrame, owner: list[str]) -> DataFrame:
    """Repeated windows of the owners of ``members``: all of what stands twice, else those ``found`` in its content."""
    runs = found.groupBy("key", "content").agg(F.collect_list(F.struct("at", "count")).alias("runs"))
    mixed = (members.filter("not plain").join(kinds.select("key", "content", "copies"), ["key", "content"])
             .join(runs, ["key", "content"], "left"))
    each = F.when(F.col("copies") > 1, F.array(F.struct(F.lit(0).alias("at"), F.col("windows").alias("count")))).otherwise(F.col("runs"))
    shifted = (mixed.select(*owner, "start", F.explode(each).alias("r"))
               .select(*owner, (F.col("start") + F.col("r.at")).alias("start"), F.col("r.count").alias("count")))
    return members.filter("plain").select(*owner, "start", F.col("windows").alias("count")).unionByName(shifted)


def _found(parts: DataFrame, kinds: DataFrame, size: int, gram: int, widths: tuple[int, ...] = PIECES) -> DataFrame:
    """key, content, at, count: windows of each content that stand elsewhere under the same key.

    ``parts`` holds the bytes of ``kinds``, one row or more of each; hot keys go on in pieces.
    """
    hot = stored(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_SEGMENTS).select("key"), "suffix-hot")
    out = (parts.join(hot, "key", "left_anti").select("key", "content", "windows", "bytes").repartition("key").sortWithinPartitions("key", "content")
           .mapInArrow(_sorted_keys(size), "key long, content long, at int, count int"))
    if hot.isEmpty():
        return out
    width, *rest = widths
    wide = parts.join(hot, "key", "left_semi").dropDuplicates(["key", "content"])
    if "lead" not in wide.columns:
        wide = wide.mapInArrow(_leads(size, gram), "key long, content long, windows int, bytes binary, lead int")
    wide = stored(wide.select("key", "content", "windows", "bytes", "lead"), "suffix-hot-parts")
    pieces = stored(wide.mapInArrow(_pieces(size, width), "of_key long, of_content long, start int, windows int, lead int, key long, content long"),
                    "suffix-pieces")
    members = stored(_shared(pieces), "suffix-piece-members")
    owner = ["of_key", "of_content"]
    place = [*owner, "start", "windows", "lead"]
    if rest:
        finer = stored(_kinds(members, place), "suffix-piece-kinds")
        wanted = (finer.select("key", "content", "one.*").groupBy(*owner)
                  .agg(F.collect_list(F.struct("key", "content", "start", "windows", "lead")).alias("wanted")))
        here = wide.join(wanted, (F.col("key") == F.col("of_key")) & (F.col("content") == F.col("of_content"))).select(F.col("bytes").alias("text"), "wanted")
        cut = stored(here.mapInArrow(_cut(size, ["key", "content", "windows", "lead"]), "key long, content long, windows int, lead int, bytes binary"),
                     "suffix-piece-parts")
        again = _placed(members, finer, _found(cut, finer, size, gram, tuple(rest)), owner)
    else:  # a piece of one window is its own middle: all of a key are equal
        again = members.select(*owner, "start", F.col("windows").alias("count"))
    return out.unionByName(again.select(F.col("of_key").alias("key"), F.col("of_content").alias("content"), F.col("start").alias("at"), "count"))


def repeated_spans(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """doc_id, th (hash of the text), windows: places (start, count) of windows that stand somewhere else too."""
    named = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    segments = stored(named.mapInArrow(_segments(size, gram), "doc_id long, th long, key array<long>, content array<long>, "
                                       "start array<int>, windows array<int>"), "suffix-segments")
    each = segments.select("doc_id", "th", F.explode(F.arrays_zip("key", "content", "start", "windows")).alias("s")) \
        .select("doc_id", "th", "s.key", "s.content", "s.start", "s.windows")
    members = stored(_shared(each), "suffix-members")

    # different segments of one key: one of each, with its bytes
    kinds = stored(_kinds(members, ["doc_id", "th", "start", "windows"]), "suffix-kinds")
    wanted = (kinds.select("key", "content", "one.*").groupBy("doc_id", "th")
              .agg(F.collect_list(F.struct("key", "content", "start", "windows")).alias("wanted")))
    here = named.alias("d").join(wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.th") == F.col("w.th")))
    parts = stored(here.select("d.text", "w.wanted").mapInArrow(_cut(size, ["key", "content", "windows"]),
                                                                "key long, content long, windows int, bytes binary"), "suffix-parts")
    every = _placed(members, kinds, _found(parts, kinds, size, gram), ["doc_id", "th"])
    # equal rows name the same places, each of which counts once
    return every.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "count")).alias("windows"))


def _remove(size: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "text"):
            data, offsets = tb.byte_view(block.column(block.schema.get_field_index("text")))
            found = block.column(block.num_columns - 1)
            parts, cuts = found.flatten(), np.asarray(found.offsets, dtype=np.int64)
            if found.null_count:
                cuts = np.concatenate([[0], np.cumsum(np.nan_to_num(np.asarray(found.value_lengths().fill_null(0), dtype=np.int64)))])
            start = np.asarray(parts.field("start"), dtype=np.int64) + np.repeat(offsets[:-1], np.diff(cuts))
            cover = np.zeros(len(data) + 1, np.int32)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + np.asarray(parts.field("count"), dtype=np.int64) + size - 1, -1)
            gone = np.cumsum(cover)[:-1] > 0
            # maximal removed runs, cut at the rows' borders
            row = np.repeat(np.arange(block.num_rows), np.diff(offsets))
            before = np.concatenate([[False], gone[:-1] & (row[1:] == row[:-1])]) if len(data) else gone
            opens = np.flatnonzero(gone & ~before)
            behind = np.concatenate([gone[1:] & (row[1:] == row[:-1]), [False]]) if len(data) else gone
            closes = np.flatnonzero(gone & ~behind) + 1
            per = np.bincount(row[opens], minlength=block.num_rows) if len(opens) else np.zeros(block.num_rows, np.int64)
            spans = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(opens - offsets[row[opens]]), pa.array(closes - offsets[row[opens]])], ["start", "end"]))
            removed = np.bincount(row, weights=gone, minlength=block.num_rows).astype(np.int64) if len(data) else np.zeros(block.num_rows, np.int64)
            kept = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)])
            # a letter with a byte left stays whole, so that the kept text is text
            letter = np.cumsum((data & 0xC0) != 0x80) if len(data) else np.zeros(0, np.int64)
            part = np.zeros(letter[-1] + 1 if len(letter) else 1, bool)
            part[letter[~gone]] = True
            stay = part[letter] if len(letter) else gone
            whole = np.concatenate([[0], np.cumsum(np.bincount(row, weights=stay, minlength=block.num_rows).astype(np.int64))]) \
                if len(data) else np.zeros(block.num_rows + 1, np.int64)
            large = lambda kind, cut, x: pa.Array.from_buffers(kind, block.num_rows, [None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [*(block.column(k) for k in range(block.num_columns - 1)), pa.array(np.diff(offsets)), pa.array(removed),
                 pa.array(per.astype(np.int64)), spans, large(pa.binary(), kept, data[~gone]), large(pa.string(), whole, data[stay])],
                [*names, "n_bytes", "n_removed", "n_spans", "spans", "kept_bytes", "kept_text"])
    return run


RESULT = "n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept_bytes binary, kept_text string"


def remove_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, spans (start, end of removed bytes), kept_bytes and kept_text.

    ``docs`` has doc_id and text; its other columns come through, those named
    like a result are replaced.  A byte is removed if a string of ``size`` bytes
    that covers it also starts anywhere else, in the same or another document;
    strings never cross documents and are judged on the input.  ``kept_text``
    keeps a letter of several bytes whole if one of its bytes stays.  Null and
    empty texts have 0 bytes; texts shorter than ``size`` lose nothing.  Equal
    rows repeat each other.  Rows are told apart by doc_id (null is a value like
    others) and text.
    """
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "spans", "kept_bytes", "kept_text", "_th", "_windows")
    spans = repeated_spans(docs, size, gram).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th2"), F.col("windows").alias("_windows"))
    marked = docs.withColumn("_th", F.xxhash64("text"))
    marked = marked.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_th2")), "left") \
        .drop("_id", "_th", "_th2")
    marked = marked.withColumn("_windows", F.coalesce("_windows", F.array().cast("array<struct<start:int,count:int>>")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return marked.mapInArrow(_remove(size, docs.columns), f"{fields}, {RESULT}")
