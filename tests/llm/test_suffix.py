import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landloom.llm import suffix
from .helpers import covered, prose

SIZE, GRAM = 40, 16


def texts():
    draw = random.Random(4)
    passage = prose(draw, 30)
    out = [prose(draw, 12) + passage[draw.randrange(20):] + prose(draw, 9) for _ in range(12)]
    out += ["ab" * 60, "ab" * 60 + "c", "x" * 39, "x" * 40, "x" * 300, passage, passage, None, "", "é" * 50, "aé" * 30 + "b", "é" + "aé" * 30]
    return out


@pytest.mark.parametrize("hot", [1000, 1])
def test_removed_bytes(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT_SEGMENTS", hot)
    rows = [(i, t, "k", i) for i, t in enumerate(texts())] + [(None, "null id " + texts()[0], "k", 1), (3, texts()[3], "k", 3), (3, "other text", "k", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, extra int")
    got = suffix.remove_repeats(df, SIZE, GRAM).collect()
    raw, masks = covered([r[1] for r in rows], SIZE)
    want = {}
    for r, b, m in zip(rows, raw, masks):
        runs = sum(1 for k in range(len(m)) if m[k] and (k == 0 or not m[k - 1]))
        want[r[0], r[1]] = (len(b), sum(m), runs, bytes(x for x, gone in zip(b, m) if not gone))
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_bytes"])) == want[r["doc_id"], r["text"]]
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and r["extra"] is not None
        whole = r["kept_text"].encode()
        assert len(r["kept_bytes"]) <= len(whole) <= len(r["kept_bytes"]) + 6 * r["n_spans"]


def test_empty_table(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_two_stages_sort_suffixes():
    draw = np.random.default_rng(1)
    for n, letters in ((50, 2), (400, 3), (3000, 5)):
        codes = draw.integers(1, letters + 1, n).astype(np.int16)
        codes[draw.integers(0, n, 3)] = 0
        codes[-1] = 0
        got = suffix.two_stage_order(codes, codes > 0, suffix.packed(codes), 64)
        assert sorted(got) == np.flatnonzero(codes > 0).tolist()
        key = [tuple(codes[p:p + 64].tolist()[:k] if 0 in codes[p:p + 64] and (k := codes[p:p + 64].tolist().index(0)) else codes[p:p + 64].tolist()) for p in got]
        assert key == sorted(key)


def test_sliding_least():
    x = np.random.default_rng(2).integers(0, 99, 500)
    for w in (1, 7, 500):
        assert suffix.sliding_least(x, w).tolist() == [x[i:i + w].min() for i in range(len(x) - w + 1)]


@pytest.mark.parametrize("hot", [1000, 5, 1])
def test_one_passage_in_many_texts(spark, monkeypatch, hot):
    """A key under every text: pieces of 16, of 4 and of one window give what comparing all windows gives."""
    monkeypatch.setattr(suffix, "HOT_SEGMENTS", hot)
    draw = random.Random(9)
    letters = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage = letters(230)
    texts = [letters(draw.randrange(60)) + passage[draw.randrange(40):230 - draw.randrange(40)] + letters(draw.randrange(60)) for _ in range(60)]
    texts += [letters(3) + passage[15:] for _ in range(40)] + [passage, passage]
    got = {r["doc_id"]: r for r in suffix.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    raw, masks = covered(texts, suffix.SIZE)
    assert any(map(any, masks))
    for i, (b, m) in enumerate(zip(raw, masks)):
        assert bytes(got[i]["kept_bytes"]) == bytes(x for x, gone in zip(b, m) if not gone)


def test_many_equal_rows(spark):
    text = prose(random.Random(2), 300)
    rows = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(8, "#" + text[:700] + "#")], "doc_id long, text string"))
    got = suffix.remove_repeats(rows).groupBy("doc_id").agg(F.count(F.lit(1)), F.min("n_removed"), F.max("n_removed")).orderBy("doc_id").collect()
    whole, part = len(text.encode()), len(text[:700].encode())
    assert [tuple(r) for r in got] == [(7, 5000, whole, whole), (8, 1, part, part)]
