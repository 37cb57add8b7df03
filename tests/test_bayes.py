"""Naive Bayes in closed form against the sums written out."""

import math
import random
from collections import defaultdict

from vacancia.operators import bayes


def by_definition(rows, labels, vocabulary_size, asked):
    sums, totals = defaultdict(float), defaultdict(float)
    for key, term, weight in rows:
        if labels.get(key) is not None:
            sums[labels[key], term] += weight
            totals[labels[key]] += weight
    known = [x for x in labels.values() if x is not None]
    out = {}
    for key in asked:
        scores = {}
        for c in sorted(set(known)):
            below = totals[c] + vocabulary_size
            scores[c] = round(math.log(known.count(c) / len(known)) + sum(
                w * math.log((sums[c, t] + 1) / below) for k, t, w in rows if k == key), 9)
        out[key] = min(scores, key=lambda c: (-scores[c], c))
    return out


def test_predictions_equal_the_sums(spark):
    rng = random.Random(3)
    topics = {"a": "pqrst", "b": "stuvw", "c": "xyz"}
    labels = {i: rng.choice(["a", "b", "b", "c", None]) for i in range(60)}
    rows = [(i, t, rng.random()) for i, label in labels.items()
            for t in set(rng.choices(topics[label or "a"] + "mn", k=4)) if i % 9]  # some without terms
    weights = spark.createDataFrame(rows, "key long, term string, weight double").repartition(3)
    known = spark.createDataFrame(list(labels.items()), "key long, label string")
    model = bayes.fit(weights, known, 20, "key", "label")
    asked = spark.createDataFrame([(i, "kept") for i in [*labels, 99]], "key long, more string")
    got = {r.key: r.prediction for r in bayes.predict(weights, asked, model, "key").collect()}
    assert got == by_definition(rows, labels, 20, [*labels, 99]) and len(set(got.values())) == 3


def test_empty_tables(spark):
    weights = spark.createDataFrame([], "key long, term string, weight double")
    none = bayes.fit(weights, spark.createDataFrame([(1, None)], "key long, label string"), 5, "key", "label")
    asked = spark.createDataFrame([(1,)], "key long")
    assert [tuple(r) for r in bayes.predict(weights, asked, none, "key").collect()] == [(1, None)]
    some = bayes.fit(weights, spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "key long, label string"), 5, "key", "label")
    assert [tuple(r) for r in bayes.predict(weights, asked, some, "key").collect()] == [(1, "y")]
    assert bayes.predict(weights, asked.limit(0), some, "key").collect() == []


def test_term_counts_are_not_stored(spark, monkeypatch):
    """Stored term rows would be shuffled again by posting; weights of the split rows are stored once."""
    from vacancia.catalog import models

    stored = []
    keep = models.materialize
    monkeypatch.setattr(models, "materialize", lambda df, name: stored.append(df.columns) or keep(df, name))
    models._bayes.__wrapped__("test", spark, "/root/testdata/sf0.001")
    assert len(stored) == 3 and not any("tf" in columns for columns in stored)


def test_vectors_are_judged_like_their_rows(spark):
    """Vectors carry their label, so nothing is joined or grouped by document."""
    rng = random.Random(5)
    labels = {i: rng.choice(["a", "b", None]) for i in range(50)}
    terms = {i: sorted(set(rng.choices(range(6) if label == "a" else range(4, 12), k=i % 5))) for i, label in labels.items()}
    rows = [(i, t, 0.1 + rng.random()) for i, ts in terms.items() for t in ts]
    vectors = spark.createDataFrame(
        [(i, labels[i], [t for k, t, _ in rows if k == i], [w for k, _, w in rows if k == i]) for i in labels],
        "key long, label string, terms array<int>, weights array<double>").repartition(3)
    model = bayes.fit(vectors, vectors, 12, "key", "label")
    predicted = bayes.predict(vectors, None, model, "key")
    plan = predicted._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    got = {r.key: r.prediction for r in predicted.collect()}
    assert got == by_definition(rows, labels, 12, list(labels)) and len(set(got.values())) == 2
    none = bayes.fit(vectors.limit(0), vectors.limit(0), 12, "key", "label")
    assert {r.prediction for r in bayes.predict(vectors, None, none, "key").collect()} == {None}
