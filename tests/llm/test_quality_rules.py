import random
import re
from collections import Counter
from math import log

import pytest
import xxhash

from landloom.llm import quality_rules as qr
from .helpers import prose, words


def repeated(w):
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    return len(hit)


def base(text):
    w = [x.decode() for x in words(text, lower=False)]
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = repeated(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, n, len(w) < 20 or 100 * n > 30 * len(w))


def bucket(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed=seed)
    return (seed - (1 << 64) if seed >> 63 else seed) % qr.BUCKETS


def grams(text):
    w = words(text, lower=False)
    return [bucket(x) for x in w] + [bucket(x, y) for x, y in zip(w, w[1:])]


def texts():
    draw = random.Random(9)
    same = prose(draw, 12)
    return [prose(draw, draw.randint(1, 60)) for _ in range(25)] + [
        same + " mid " + same, same * 3, "a b " * 30, "line one two\nline one two\n\n \nx\nline one two", "#x $y %&| <>" * 9,
        "", None, "   \n\t ", "Über\x0bÉtat\x0c" + prose(draw, 30), "word", "w " * 8, "w " * 9]


def test_counts_and_ratio(spark):
    rows = [(i, t, 3, "z") for i, t in enumerate(texts())] + [(None, texts()[0], 3, "z"), (1, texts()[1], 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, other string")
    trusted = list(range(0, 20, 2))
    got = qr.quality_rules(docs, spark.createDataFrame([(i,) for i in [*trusted, None, 0, 0, 999]], "doc_id long")).collect()
    raw = Counter(g for _, t, *_ in rows for g in grams(t))
    target = Counter(g for i, t, *_ in rows if i in trusted for g in grams(t))
    llr = lambda b: log((target[b] + 1) / (target.total() + qr.BUCKETS)) - log((raw[b] + 1) / (raw.total() + qr.BUCKETS))
    assert len(got) == len(rows)
    for r in got:
        want = base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        g = grams(r["text"])
        score = sum(map(llr, g)) / len(g) if g else 0.0
        assert r["llr_score"] == pytest.approx(score, abs=1e-9) and r["other"] == "z"
        assert r["kept"] == (not want[5] and score >= qr.LEAST_SCORE)


def test_nothing_trusted_and_empty(spark):
    docs = spark.createDataFrame([(1, prose(random.Random(1), 40)), (2, "short")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert {r["doc_id"]: r["kept"] for r in qr.quality_rules(docs, none).collect()} == {1: True, 2: False}
    assert qr.quality_rules(docs.limit(0), none).count() == 0


def test_all_trusted_documents_count(spark):
    """12,000 trusted documents of one word: each adds one to its bucket."""
    docs = spark.range(12_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'alpha', 'beta') as text")
    llr = qr.ratios(docs, docs.select("doc_id")).first()[0]
    for word, n in (("alpha", 4000), ("beta", 8000)):
        assert llr[bucket(word.encode())] == pytest.approx(log((n + 1) / (12_000 + qr.BUCKETS)) - log((n + 1) / (12_000 + qr.BUCKETS)), abs=1e-9)
    llr = qr.ratios(docs.unionAll(docs.selectExpr("doc_id + 12000", "text")), docs.select("doc_id")).first()[0]
    assert llr[bucket(b"alpha")] == pytest.approx(log(4001 / (12_000 + qr.BUCKETS)) - log(8001 / (24_000 + qr.BUCKETS)), abs=1e-9)


def test_filters_on_results_cost_nothing(spark):
    """Filters and sorts on the verdict leave each step worked out once, also in very long texts."""
    import time
    draw = random.Random(4)
    long_ = [" ".join(f"w{draw.randrange(5_000)}" for _ in range(20_000)) for _ in range(6)] + [prose(draw, 3_000) * 7, "x" * 3_000_000]
    docs = spark.createDataFrame(list(enumerate(long_)), "doc_id long, text string")
    out = qr.quality_rules(docs, spark.createDataFrame([(i,) for i in range(6)], "doc_id long"))
    began = time.time()
    kept = out.filter("kept").select("doc_id", "n_words").collect()
    failed = out.filter("base_failed").orderBy("llr_score").select("doc_id").collect()
    assert time.time() - began < 60
    assert {r.doc_id for r in failed} == {6, 7}
    assert sorted(r.doc_id for r in kept) == list(range(6)) and all(r.n_words == 20_000 for r in kept)
