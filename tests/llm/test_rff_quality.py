"""The quality classifier: parts against direct computation, held-out accuracy."""

import numpy as np
from pyspark.sql import functions as F

from vacancia.llm import queries, rff_quality as R

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op4_quality_classifier"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = rows.join(labels, "doc_id").select("held_out", "quality", "score", "predicted").toPandas()
    test = got[got.held_out]
    assert len(test) > 50 and (test.predicted == test.quality).mean() > 0.95
    assert rows.count() == 1000 and rows.filter("score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0


def test_normal_equations_and_tree(spark):
    rng = np.random.default_rng(1)
    blobs = rng.normal(size=(70, 5))
    df = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(blobs)], "place long, blob binary").repartition(70)
    assert np.allclose(R.tree_sum(df, 4), blobs.sum(0))


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20, R.WIDTH))
    model = {"mean": np.zeros(R.WIDTH), "scale": np.ones(R.WIDTH),
             "waves": rng.normal(0, R.WIDTH ** -0.5, (R.WIDTH, 20000)), "shifts": rng.uniform(0, 2 * np.pi, 20000)}
    z = R._fourier(x, model)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * R.WIDTH))
    assert np.abs(z @ z.T - kernel).max() < 0.05


def test_isotonic():
    at, values = R.isotonic(np.array([1, 2, 1, 4.]), np.array([1, 0, 1, 4.]), np.array([0, 1, 2, 3.]))
    assert values.tolist() == [1 / 3, 1.0] and np.all(np.diff(at) > 0)


def test_odd_rows_and_labels(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 1), (8, 0), (5, 1)], "doc_id long, quality int")
    model = R.fit(odd, labels)
    rows = R.score(odd, model, keep_row=True).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    same = {r.row.text or "": r.score for r in rows}
    assert all(abs(same[r.row.text or ""] - r.score) < 1e-12 for r in rows)
    assert R.fit(odd, labels.filter("false")) is None
    assert {r.score for r in R.score(odd, None).collect()} == {0.5}
    assert R.score(odd.limit(0), model).collect() == []


def test_labels_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = R.fit(docs, labels)
    a = {r.doc_id: r.score for r in R.score(docs, model).collect()}
    moved = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("s")).withColumn("doc_id", F.col("doc_id") + 10**6)
    b = {r.doc_id - 10**6: r.score for r in R.score(moved, model).collect()}
    assert a == b
