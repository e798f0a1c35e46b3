import numpy as np
import pyarrow as pa

from landloom.llm import ranker

SF = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    from landloom.llm.queries import QUERIES
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality is not null")
    out = QUERIES["op6_quality_classifier"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    right = [r["predicted"] == r["quality"] for r in out]
    assert len(right) > 40 and sum(right) / len(right) >= 0.95


def test_pairs_order_the_classes():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(300, len(ranker.NAMES)))
    label = (x[:, 3] - x[:, 5] > 0.7).astype(int)
    s = ranker.Ranker(x, label, 20_000).scores(x)
    assert ((s >= ranker.CUT) == label).mean() > 0.97
    assert 0 <= s.min() and s.max() <= 1


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "Good words stand here in a line.", 1), (2, "### @@@ ###", 1), (2, "### @@@ ###", 1), (None, "x", 1), (4, None, 1), (5, "", 1)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (5, None)], "doc_id long, label int")
    got = sorted((tuple(r) for r in ranker.score(docs, ranker.fit(docs, labels)).collect()), key=repr)
    assert len(got) == 6 and all(0 <= r[1] <= 1 and r[2] == (r[1] >= ranker.CUT) for r in got)
    by = {r[0]: r for r in got}
    assert by[1][1] > by[2][1] and by[4][1] == by[5][1]
    none = ranker.fit(docs, labels.limit(0))  # nothing learnt: all alike
    assert all(abs(r["score"] - ranker.CUT) < 1e-9 for r in ranker.score(docs, none).collect())
    assert ranker.score(docs.limit(0), none).count() == 0


def test_fit_takes_every_labelled_row_and_pair(spark):
    """The loss over all pairs is least at the weights, and the cut is a quantile of all labelled rows; so are in-memory fits."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").withColumnRenamed("quality", "label")
    model = ranker.fit(docs, labels)
    rows = docs.join(labels.filter("label in (0, 1)"), "doc_id").select("label", "text").collect()
    block = pa.RecordBatch.from_arrays([pa.array([r["text"] for r in rows])], ["text"])
    x, label = ranker.vectors(*ranker.tb.byte_view(block.column(0))), np.array([r["label"] for r in rows])
    z = model.scaled(x)
    s = z @ model.weights
    p = 1 / (1 + np.exp(s[label == 1][:, None] - s[label == 0][None, :]))  # all pairs
    gradient = (p.sum(axis=0) @ z[label == 0] - p.sum(axis=1) @ z[label == 1]) / p.size + ranker.PENALTY * model.weights
    assert np.abs(gradient).max() < 1e-6
    bad = int((label == 0).sum())
    assert abs(model.cut - np.sort(s)[bad - 1:bad + 1].mean()) < 1e-9
    plain = ranker.Ranker(x, label, 77)
    assert np.abs(plain.weights - model.weights).max() < 1e-4 and abs(plain.cut - model.cut) < 1e-3


def test_more_labelled_rows_than_the_old_bound(spark):
    """Twelve thousand short texts: every one moves mean and cut."""
    docs = spark.range(12_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN concat('## @@ ', id) ELSE concat('plain words stand here ', id) END AS text")
    model = ranker.fit(docs, docs.selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS label"))
    words = ranker.NAMES.index("words")
    assert abs(model.mean[words] - (np.log1p(3) / 3 + np.log1p(5) * 2 / 3) / 10) < 1e-8
    out = ranker.score(docs, model)
    assert out.filter("predicted = 0").count() == 4_000
