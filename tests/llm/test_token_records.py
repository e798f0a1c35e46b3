import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from landloom.llm import token_records as tr
from landloom.llm.queries import QUERIES, tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_tokens int, data string"


def crc32c(data):
    """Bit by bit."""
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def texts():
    draw = random.Random(2)
    words = ["The", "QUICK", "it's", "naïve", "x-ray", "<|endoftext|>", "12.5", "don't!", "ÅNGSTRÖM", "Å", "東京", "🙂🙂", "end.", "Á", "a,b", " "]
    rows = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 60))) for _ in range(40)]
    return rows + [None, "", " ", "\n\n", "same text", "same text", "w" * 3000, "tab\there\r\nand\x0bthere", " ".join(draw.choice(words) for _ in range(60_000))]


def test_checksums():
    assert crc32c(b"123456789") == 0xE3069283
    draw = random.Random(1)
    data = np.array([draw.randrange(256) for _ in range(5000)], np.uint8)
    ranges = [(0, 0), (0, 1), (7, 71), (7, 72), (100, 1500), (0, 5000), (4999, 5000), (64, 128), (63, 128), (5000, 5000)]
    start, end = np.array(ranges).T
    assert tr.checksums(data, start, end).tolist() == [crc32c(data[a:b].tobytes()) for a, b in ranges]


def test_files_hold_what_the_library_gives(spark, library, tmp_path):
    rows = [(i * 7 % 50 - 20, t, 9, "other") for i, t in enumerate(texts())] + [(None, "no id", 0, ""), (None, None, 0, ""), (3, "twice", 0, ""), (3, "twice", 0, "")]
    path = f"file://{tmp_path}/records"
    for end in (1, None):
        tr.write_records(spark.createDataFrame(rows, SCHEMA), PATH, path, end)
        got = tr.read_records(spark, path).collect()
        want = sorted((r[0] is not None, r[0] or 0, [*library(r[1]), *([end] if end else [])]) for r in rows)
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
        order = sorted(got, key=lambda r: (r.start, r.n_tokens))
        assert [(r.doc_id is not None, r.doc_id or 0) for r in order] == [w[:2] for w in want]
        at = 0
        for r in order:
            assert r.start == at and r.n_tokens == len(r.ids)
            at += r.n_tokens
    # one frame by hand
    import json
    entries = json.loads((tmp_path / "records/manifest.json").read_text())["files"]
    assert sum(e["records"] for e in entries) == len(rows)
    assert len(list((tmp_path / "records").iterdir())) == 2 * len(entries) + 1  # replaced files are gone
    raw = (tmp_path / f"records/{entries[0]['name']}.rec").read_bytes()
    size = int.from_bytes(raw[:8], "little")
    mask = lambda c: ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF
    assert int.from_bytes(raw[8:12], "little") == mask(crc32c(raw[:8]))
    assert int.from_bytes(raw[12 + size:16 + size], "little") == mask(crc32c(raw[12:12 + size]))
    assert raw[20:24] == b"\1\0\2\0"  # null ids come first; two bytes a token id
    n = int.from_bytes(raw[24:28], "little")
    assert size == 16 + -(-2 * n // 4) * 4
    assert [int.from_bytes(raw[28 + 2 * k:30 + 2 * k], "little") for k in range(n)] in [list(library(t)) for t in ("no id", None)]
    # shuffled by the index: the same records, another order, and the same one again
    once, again, other = (tr.read_shuffled(spark, path, s).collect() for s in (5, 5, 6))
    assert once == again and once != other and sorted(map(str, once)) == sorted(map(str, got)) == sorted(map(str, other))


def test_broken_files_and_second_writes(spark, tmp_path):
    path = str(tmp_path / "r")
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string").coalesce(1)
    tr.write_records(docs, PATH, path)
    with pytest.raises(Exception, match="only overwriting"):
        tr.encode(docs, PATH).write.format(tr.NAME).mode("append").save(path)
    for f in (tmp_path / "r").glob("*.rec"):
        raw = bytearray(f.read_bytes())
        raw[-6] ^= 1
        f.write_bytes(raw)
    with pytest.raises(Exception, match="wrong checksum"):
        tr.read_records(spark, path).collect()


def test_empty_table_and_whole_texts(spark, tmp_path):
    tr.write_records(spark.createDataFrame([], SCHEMA), PATH, str(tmp_path / "e"), 1)
    assert tr.read_records(spark, str(tmp_path / "e")).collect() == []
    assert tr.read_shuffled(spark, str(tmp_path / "e"), 1).collect() == []
    # a tokenizer whose tokens hold blanks gets whole texts
    other = tokenizer_file("byte_bpe_50k.json")
    assert not tr.encoder(other).by_words and tr.encoder(PATH).by_words
    from tokenizers import Tokenizer
    got = tr.encode(spark.createDataFrame([(1, "a  b c\n d")], "doc_id long, text string"), other).first().ids
    assert got == Tokenizer.from_file(other).encode("a  b c\n d", add_special_tokens=False).ids


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op11_token_records"](spark, sf).collect()}
    at = 0
    for doc_id, text in sorted(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())):
        ids = [*library(text), 1]
        assert tuple(got[doc_id]) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_ids_of_four_bytes_and_mixed_widths():
    import pyarrow as pa
    lists = [[1, 2, 3], [], [70_000], [65_535] * 5, [2**31 - 1, 0]]
    batch = pa.RecordBatch.from_arrays([pa.array([5, None, -7, 1, 2]), pa.array([2, 4, 4, 2, 4], pa.int32()), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "width", "ids"])
    words, begin, n = tr.frames(batch)
    key, null, m, ids = tr.unframed(words.tobytes(), 4 * begin, "x")
    assert null.tolist() == [False, True, False, False, False] and m.tolist() == n.tolist() == [3, 0, 1, 5, 2]
    assert [k for k, x in zip(key.tolist(), null) if not x] == [5, -7, 1, 2] and ids.tolist() == sum(lists, [])


def test_forgetting_changes_nothing(library, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(tr.Encoder, "REMEMBERED", 3)
    monkeypatch.setattr(tr.Encoder, "JOINED", 4)
    own = tr.Encoder(PATH)
    draw = random.Random(8)
    odd = ["İstanbul", "ǆ", "ß", "ﬁn", "a1b", "한국", "e\u0301", "ÅB", "one", "two", "three", "four", "five,", "6.", "ª", "x²"]
    for _ in range(12):
        some = [" ".join(draw.choice(odd) for _ in range(draw.randint(0, 9))) for _ in range(5)]
        ids, cuts = own.encode(pa.array(some, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [library(t) for t in some]
