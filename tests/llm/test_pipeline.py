import corpus_pipeline as cp
from landloom.llm import minhash
from .helpers import components, covered, prose


def test_stages_and_their_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in cp.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = minhash.stored(stage(spark, docs, sf), f"test-{name}")
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "near_duplicates":
            groups = components(sorted(before.items()), 5)
            assert set(after) == set(groups.values())
        if name == "suffix_repeats":
            _, masks = covered(list(before.values()), 200)
            for (i, t), m in zip(before.items(), masks):
                assert len((after[i]["text"]).encode()) >= m.count(False) and (after[i]["text"] == t) == (not any(m))
                assert after[i]["n_chars"] == len(after[i]["text"])
        if name != "encoding":
            assert docs.columns == columns
        else:
            assert set(after) == set(before) and all(r["round_trip"] for r in after.values())


def test_run_is_the_last_stage(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"] and out.count() > 50


def test_odd_rows(spark):
    import random
    text = prose(random.Random(2), 120)
    rows = [(1, text, "en", "s", 1, "e"), (1, text, "en", "s", 1, "e"), (2, text, None, None, None, None), (None, text + " own", "en", "s", 1, "e"), (3, None, "en", "s", 1, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for _, stage in cp.STAGES:
        for frame in (docs, docs.limit(0)):
            assert stage(spark, frame, "/root/testdata/sf0.001").count() <= frame.count()


def test_one_text_stays_of_repeated_and_null_id_rows(spark):
    """After stages 2 to 4 each group has one whole text; contaminated rows are gone whatever their id."""
    import random
    draw, sf = random.Random(4), "/root/testdata/sf0.001"
    twice, pair, nulls, alone = (f"{k} " + " ".join(f"{k}{draw.randrange(10 ** 6)}" for _ in range(120)) for k in ("aa", "bb", "cc", "dd"))
    bad = max((r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()), key=len)
    rows = [(5, twice), (5, twice), (None, pair + " own"), (6, pair), (None, nulls), (None, nulls), (7, alone), (7, bad), (None, "x " + bad + " y"),
            (8, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES[1:4]:
        docs = minhash.stored(stage(spark, docs, sf), f"test-odd-{name}")
    left = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted((x for x in left if x[1]), key=key) == sorted([(5, twice), (6, pair), (7, alone), (None, nulls)], key=key)
    assert {x for x in left if not x[1]} == {(8, None), (None, "")}
