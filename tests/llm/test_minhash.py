import random

import pytest

from landloom.llm import minhash
from .helpers import components, near_copies, shingles


@pytest.mark.parametrize("width", [2, 5])
def test_components_are_those_of_all_pairs(spark, width):
    docs = near_copies()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, signature string, component_id int")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df, width).collect()}
    want = components(docs, width)
    assert len(got) == len(docs)
    for i, t in docs:
        assert got[i]["n_shingles"] == len(shingles(t, width))
        assert got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i)


def test_chain_and_large_group(spark):
    """A chain of likes of likes is one group; so are many copies of slightly different texts."""
    chain = [" ".join(f"w{k}" for k in range(s, s + 60)) for s in range(0, 30, 3)]
    group = [" ".join([f"g{k}" for k in range(80)] + [f"own{i}"]) for i in range(40)]
    docs = list(enumerate(chain + group + ["alone here"]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 2).collect()}
    assert got == components(docs, 2)


def test_odd_rows(spark):
    text = "a b c d e f g"
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (3, "x y"), (4, "x y"), (5, "")]
    got = sorted((tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()), key=repr)
    assert got == sorted([(1, 6, 1, True), (1, 6, 1, True), (2, 6, 1, False), (None, 6, None, True), (3, 0, 3, True), (3, 1, 3, True),
                          (4, 1, 3, False), (5, 0, 5, True)], key=repr)
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), 2).count() == 0


def test_documents_beside_a_pivot_tie_components_not_pairs(spark):
    """Sixty documents similar to the pivot and sixty beside it share differences: thousands of links, one component."""
    near = [(i, 0, 0, 100, list(range(15)) + [100 + i], []) for i in range(1, 61)]
    beside = [(i, i, 0, 100, list(range(15)) + [1000 + 10 * i + k for k in range(7)], []) for i in range(61, 121)]
    alone = [(i, i, 0, 100, list(range(10)) + [9000 + 20 * i + k for k in range(14)], []) for i in range(121, 126)]
    # another pivot: a chain, each similar to the next only
    chain = [(i, i, 500, 100, list(range(4 * i, 4 * i + 30)), []) for i in range(501, 521)]
    rows = [(*row, 5 * len(row[4]) - 100, len(row[4]), 0) for row in near + beside + alone + chain]
    pivots = spark.createDataFrame([(i, c, p, n, [v * 7919 for v in x], y, q, r, a) for i, c, p, n, x, y, q, r, a in rows],
                                   "doc_id long, component long, pivot long, na int, lacks array<long>, adds array<long>, q int, r int, p int")
    links = [tuple(r) for r in minhash._links_beside(pivots).collect()]
    assert len(links) < 2 * len(rows)
    parent = {c: c for _, c, *_ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def tie(a, b):
        parent[max(root(a), root(b))] = min(root(a), root(b))
    for a, b in links:
        tie(a, b)
    got = {i: root(c) for i, c, *_ in rows}
    parent = {c: c for _, c, *_ in rows}
    for i, c, p, n, x, _, q, *_ in rows:
        for j, d, o, _, y, _, t, *_ in rows:
            if i < j and p == o and 9 * len(set(x) & set(y)) >= q + t + n:
                tie(c, d)
    assert got == {i: root(c) for i, c, *_ in rows} and len(set(got.values())) == 7

def test_dissimilar_documents_of_one_pivot_make_no_pairs(spark, monkeypatch):
    """Thirty-two documents share fifty of 250 differences from their pivot, far from enough; two more share 180."""
    def lacks(i):
        own = [10_000 * k + 100 * min(i, i ^ (1 << k % 5)) + e for k in range(20) for e in range(10)]
        return [-1 - e for e in range(50)] + own
    rows = [(i, i, 0, 1000, lacks(i)) for i in range(1, 33)]
    rows += [(i, i, 0, 1000, list(range(10 ** 6, 10 ** 6 + 180)) + [i * 10 ** 6 + e for e in range(70)]) for i in (41, 42)]
    pivots = spark.createDataFrame([(i, c, p, n, [abs(v) * 7919 for v in x], [], 5 * len(x) - n, len(x), 0) for i, c, p, n, x in rows],
                                   "doc_id long, component long, pivot long, na int, lacks array<long>, adds array<long>, q int, r int, p int")
    met, confirm = set(), minhash._confirmed_beside
    monkeypatch.setattr(minhash, "_confirmed_beside", lambda pairs, each: met.update(
        (min(r["a"], r["b"]), max(r["a"], r["b"])) for r in pairs.collect()) or confirm(pairs, each))
    links = {(min(r), max(r)) for r in minhash._links_beside(pivots).collect()}
    assert links == {(41, 42)} and len(met) <= 5 * 32 // 2 + 1  # those that share more than the fifty; all 496 pairs share them


def test_groups_of_two_pivots_make_no_pairs(spark, monkeypatch):
    """Variants of two texts that are alike by signature: many pairs share rare lists, none is similar."""
    draw = random.Random(5)
    first = [f"w{k}" for k in range(200)]
    second = first[:170] + [f"z{k}" for k in range(30)]

    def variant(words, share):
        return " ".join(f"n{draw.random()}" if draw.random() < share else w for w in words)
    texts = [variant(t, 0.02) for t in (first, second) for _ in range(6)] + [variant(t, 0.09) for t in (first, second) for _ in range(40)]
    docs = list(enumerate(texts))
    met, likely = [], minhash._likely
    monkeypatch.setattr(minhash, "_likely", lambda pairs, reps, matches: met.append(pairs.count()) or likely(pairs, reps, matches))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()}
    want = components(docs, 2)
    assert got == want and len(set(want.values())) > 60
    assert met[1] < len(docs) // 4  # 96 without the sketches


def test_sketches_never_part_similar_sets(spark):
    """Sketches of two sets differ in at most as many bits as there are shingles in one set only, and in an even number less."""
    draw = random.Random(9)
    base = [f"w{k}" for k in range(300)]
    docs = [(i, " ".join(w for w in base if draw.random() > i / 40)) for i in range(20)] + [(20, ""), (21, "one"), (22, None)]
    rows = {r["doc_id"]: [r[c] for c in minhash.SKETCH] for r in
            minhash.signatures(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()}
    assert rows[20] == rows[22] == [0] * minhash.ODD and sum((v % 2 ** 64).bit_count() for v in rows[21]) == 1
    for i, t in docs:
        for j, u in docs:
            away = sum(((x ^ y) % 2 ** 64).bit_count() for x, y in zip(rows[i], rows[j], strict=True))
            only = len(shingles(t, 2) ^ shingles(u, 2))
            assert away <= only and (only - away) % 2 == 0
