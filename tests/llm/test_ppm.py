import random
from collections import Counter, defaultdict
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from landloom.llm import ppm, textblocks as tb
from .helpers import prose, words

ORDER = 3


def plain_log10(tables, totals, keys, order):
    """Escape by escape, excluding symbol by symbol."""
    out = []
    for key in keys:
        excluded, symbol, total = set(), key & 255, 0.0
        for o in range(order, -1, -1):
            context = (key >> 8) & ((1 << 8 * o) - 1)
            counts = tables[o].get(context)
            if not counts:
                continue
            left = {s: c for s, c in counts.items() if s not in excluded}
            lost = totals[o][context] - sum(counts.values())
            weight = sum(left.values()) + lost
            if symbol in left:
                total += log10((left[symbol] - 0.5) / weight)
                break
            if left or lost:
                total += log10((lost + len(left) / 2) / weight)
            excluded |= left.keys()
        else:
            total -= log10(max(ppm.SYMBOLS - len(excluded), 1))
        out.append(total)
    return out


def gram_keys(text, order):
    room = bytes([ppm.START]) * order + bytes(tb.LOWER[np.frombuffer((text or "").encode(), np.uint8)]) + bytes([ppm.END])
    return [int.from_bytes(room[i - order:i + 1], "big") for i in range(order, len(room))]


def test_scores_by_definition(spark):
    draw = random.Random(6)
    texts = [prose(draw, draw.randint(0, 60)) for _ in range(40)] + ["", None, "WHOLLY Unseen §§ words"]
    rows = [(i, t, 1.0) for i, t in enumerate(texts)] + [(None, "null id learns", 0.0), (0, texts[0], 2.0)]
    share, word_share = 400, 60  # so that some n-grams and words are below the shares
    got = ppm.pretrained(spark.createDataFrame(rows, "doc_id long, text string, score double"), ORDER, share, word_share).collect()
    held = lambda i: i is not None and crc32(str(i).encode()) % 10 == 0
    learnt = [t for i, t, _ in rows if not held(i)]
    full = Counter(k for t in learnt for k in gram_keys(t, ORDER))
    tables, totals = [defaultdict(dict) for _ in range(ORDER + 1)], [Counter() for _ in range(ORDER + 1)]
    for o in range(ORDER + 1):
        level = Counter()
        for k, c in full.items():
            level[k & ((1 << 8 * (o + 1)) - 1)] += c
        for k, c in level.items():
            totals[o][k >> 8] += c
            if c * share >= sum(full.values()):
                tables[o][k >> 8][k & 255] = c
    counts = Counter(w for t in learnt for w in words(t))
    total, kinds = sum(counts.values()) + len(learnt), len(counts) + 1
    assert len(got) == len(rows)
    by_id = {(i, t): None for i, t, _ in rows}
    for r in got:
        own = [(i, t) for i, t in by_id if i == r["doc_id"]]
        assert len(own) == 1 and r["held_out"] == held(r["doc_id"])
        w, text = words(own[0][1]), own[0][1]
        c = [*(counts[x] for x in w), len(learnt)]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(c), sum(x > 0 for x in c), total)
        assert r["base_score"] == pytest.approx(sum(log10((x + 0.1) / (total + 0.1 * (kinds + 1))) for x in c), abs=1e-6)
        assert r["score"] == pytest.approx(sum(plain_log10(tables, totals, gram_keys(text, ORDER), ORDER)), abs=1e-6)


def test_probabilities_of_a_context_sum_to_one():
    keys, _ = ppm.grams(*tb.byte_view(pa.array(["abracadabra abraca", "cabra"])), 2)
    levels = []
    for o in range(3):
        key, count = np.unique(keys & ((1 << 8 * (o + 1)) - 1), return_counts=True)
        every, of = np.unique(key >> 8, return_inverse=True)
        kept = count > 1 if o else count > 0
        levels.append((key[kept], count[kept], every, np.bincount(of, weights=count).astype(int)))
    trie = ppm.Trie(levels)
    for context in (b"ab", b"ra", b"zz", b"za"):
        every = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256) if s != ppm.START])
        assert (10 ** trie.log10s(every)).sum() == pytest.approx(1)


def test_held_out_texts_beat_the_words(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    r = ppm.pretrained(df).filter("held_out").groupBy().sum("score", "base_score").first()
    assert r[0] > r[1]


def test_empty_and_untrained(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ppm.pretrained(empty).count() == 0
    held = next(i for i in range(99) if crc32(str(i).encode()) % 10 == 0)
    r = ppm.pretrained(spark.createDataFrame([(held, "ab")], "doc_id long, text string")).first()
    assert r["score"] == pytest.approx(-3 * log10(255)) and r["n_known"] == 0 and r["train_tokens"] == 0


def test_adaptive_learns_while_reading(spark):
    rows = [(1, "abcabcabcabc" * 20), (2, "".join(chr(97 + (i * i * 7 + i) % 23) for i in range(240))), (3, None)]
    got = dict(tuple(r) for r in ppm.adaptive(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect())
    assert got[1] > got[2] / 3 and got[3] == pytest.approx(-log10(255))


def test_all_ngrams_count(spark):
    """A megabyte of one text does not drive out n-grams that come once; sent and joined scores are the same."""
    draw = random.Random(8)
    texts = [prose(draw, draw.randint(0, 40)) for _ in range(30)] + ["ab " * 400_000, "", None, "held §§ out"]
    rows = list(enumerate(texts, 100))
    learnt = [t for i, t in rows if crc32(str(i).encode()) % 10]
    assert len(learnt) < len(texts)
    tables = [defaultdict(Counter) for _ in range(ORDER + 1)]
    for k, c in Counter(k for t in learnt for k in gram_keys(t, ORDER)).items():
        for o in range(ORDER + 1):
            tables[o][(k & ((1 << 8 * (o + 1)) - 1)) >> 8][k & 255] += c
    totals = [{c: sum(x.values()) for c, x in t.items()} for t in tables]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for settings in ({}, {"hot": 40}, {"hot": 0}):
        got = {r["doc_id"]: r["score"] for r in ppm.pretrained(docs, ORDER, **settings).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            if len(t or "") < 1000:
                assert got[i] == pytest.approx(sum(plain_log10(tables, totals, gram_keys(t, ORDER), ORDER)), abs=1e-6)
