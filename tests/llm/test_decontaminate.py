import random

import pytest

from landloom.llm import decontaminate as dc
from .helpers import ITEM, prose, words


def plain(docs, items, width):
    grams = {}
    for i, t in items:
        w = words(t, ITEM)
        for k in range(max(len(w) - width, 0) + 1 if w else 0):
            grams.setdefault(tuple(w[k:k + width]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t, ITEM), set(), set()
        for g, own in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found |= own
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def data():
    draw = random.Random(12)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "the", "of"]
    say = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(say(draw.choice([1, 2, 6, 9, 14])))) for k in range(12)] + [(20, "rare1 rare2"), (21, "a a a"), (22, ""), (23, None), (24, "!!!"), (None, "null item")]
    docs = []
    for k in range(60):
        w = say(draw.randint(0, 50))
        if draw.random() < 0.5:
            w[len(w) // 2:len(w) // 2] = items[draw.randrange(12)][1].split()
        docs.append((k, draw.choice([" ", ", ", "-\n"]).join(w)))
    return docs + [(70, "A a, a a! RARE1 (Rare2)"), (71, None), (72, ""), (73, "null item here"), (None, "rare1 rare2 x"), (5, docs[5][1])], items


@pytest.mark.parametrize("rarest", [1, 2, 4])
def test_exact_matches(spark, rarest):
    docs, items = data()
    df = spark.createDataFrame([(i, t, "e") for i, t in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in dc.decontaminate(df, bench, 6, rarest).collect()]
    assert sorted(got, key=repr) == sorted(((*r, r[2] > 0) for r in plain(docs, items, 6)), key=repr)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs, items = data()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(dc.decontaminate(df, bench, 6).collect(), key=repr)
    monkeypatch.setattr(dc, "small", lambda x, rows=0: x)
    assert sorted(dc.decontaminate(df, bench, 6).collect(), key=repr) == want


def test_empty_tables(spark):
    docs, items = data()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert dc.decontaminate(df.limit(0), bench).count() == 0
    assert not [r for r in dc.decontaminate(df, bench.limit(0)).collect() if r["contaminated"]]


def test_near_matches(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "four x three y one two"), (3, "one two three " + "z " * 20 + "four"), (4, "one two four")],
                                 "row long, text string")
    windows = dc.windows_of(spark.createDataFrame([(7, "one two three four")], "item_id long, text string"), 4)
    assert sorted(r["row"] for r in dc.near_matches(docs, windows, 3).collect()) == [1, 2]


def test_many_equal_rows(spark):
    """Equal rows cost no more than their number, also where their text is a benchmark item."""
    import time
    text = prose(random.Random(6), 400)
    docs = spark.createDataFrame([(1, text)] * 1500 + [(2, "clean words"), (None, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text)], "item_id long, text string")
    began = time.time()
    got = dc.decontaminate(docs, bench).groupBy("doc_id", "n_hit", "n_words", "contaminated").count().collect()
    assert time.time() - began < 60
    n = len(words(text, ITEM))
    assert {tuple(r) for r in got} == {(1, n, n, True, 1500), (2, 0, 2, False, 1), (None, n, n, True, 1)}
