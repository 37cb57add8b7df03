"""Leaves of like documents, bounds and Arrow vectors of the sparse search."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vacancia.operators import nearest, tfidf
from vacancia.plans import matching as plan

TEXTS = ["data engineer spark sql", "data analyst sql sql excel", "the chef", "", None, "spark spark data",
         "data engineer spark sql", "a b c", "zebra data"]


def rows(rng, n, name, wide=40, copies=0):
    # A few topics, as texts have: documents of one share most of their terms.
    topics = [np.random.default_rng(i).choice(wide, 8, replace=False) for i in range(12)]
    terms = [np.unique(np.append(rng.choice(topics[i % 12], rng.integers(0, 7)), rng.integers(0, wide, i % 2))).astype(np.int32)
             for i in rng.integers(0, 1000, n)]
    weights = [rng.choice([0.2, 0.5, 0.7, 1.0], len(t)) for t in terms]
    for i in range(copies):
        terms[i], weights[i] = terms[n - 1], weights[n - 1]
    return pd.DataFrame({name: rng.permutation(n), "terms": terms, "weights": weights})


def by_definition(q, d, k):
    out = []
    for a in q.itertuples():
        scores = []
        for b in d.itertuples():
            of = dict(zip(b.terms.tolist(), b.weights.tolist()))
            if set(of) & set(a.terms.tolist()):
                scores.append((-round(sum(w * of.get(t, 0.0) for t, w in zip(a.terms.tolist(), a.weights.tolist())), 6), b.d_id))
        out += [(a.q_id, i, -s) for s, i in sorted(scores)[:k]]
    return sorted(out)


@pytest.mark.parametrize("leaf, chunk", [(4, 4_000_000), (16, 300), (64, 4_000_000)])
def test_leaves_find_what_scoring_all_finds(monkeypatch, leaf, chunk):
    rng = np.random.default_rng(11)
    q, d = rows(rng, 50, "q_id"), rows(rng, 700, "d_id", copies=150)
    monkeypatch.setattr(nearest, "_LEAF", leaf)
    monkeypatch.setattr(nearest, "_CHUNK", chunk)
    got = nearest._kernel(6, True)(q, d)
    found = sorted((r.q_id, r.d_id, round(r.score, 6)) for r in got.itertuples())
    assert found == by_definition(q, d, 6) and len(found) > 200


def test_few_leaves_are_scored(monkeypatch):
    """Documents that cannot enter a list are not scored: scoring all was 200 x 20,000 products."""
    rng = np.random.default_rng(2)
    q, d = rows(rng, 200, "q_id", 300), rows(rng, 20_000, "d_id", 300)
    scored = []
    add = nearest._Best.add_some
    monkeypatch.setattr(nearest._Best, "add_some", lambda self, r, c, s: scored.append(s.size) or add(self, r, c, s))
    nearest._kernel(5, True)(q, d)
    assert 0 < sum(scored) < 0.25 * 200 * 20_000


def test_negative_weights_are_scored_in_full():
    q = pd.DataFrame({"q_id": [1], "terms": [np.array([0, 1])], "weights": [np.array([1.0, 1.0])]})
    d = pd.DataFrame({"d_id": np.arange(200), "terms": [np.array([0, 1])] * 200,
                      "weights": [np.array([0.5, -0.4 if i != 150 else 0.3]) for i in range(200)]})
    got = nearest._kernel(1, True)(q, d)
    assert got["d_id"].tolist() == [150]


def jobs(spark):
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "job_id string, job_title string")
    for c in ("skills", "description", "location", "experience"):
        frame = frame.withColumn(c, F.lit(None).cast("string"))
    return frame.withColumn("role_category", F.lit("x"))


def test_vectors_are_the_weights_of_the_rows(spark):
    rec = plan.Recommender(jobs(spark), ["the"], min_df=1)
    want = {(r.job_id, r.term): r.weight for r in rec.weights().collect()}
    vectors = rec.vectors().collect()
    got = {(r.job_id, rec.terms.terms[t]): w for r in vectors for t, w in zip(r.terms, r.weights, strict=True)}
    assert got == pytest.approx(want) and len(got) > 20
    listed = tfidf.listed(rec.vectors(), "job_id").collect()
    assert {(r.job_id, rec.terms.terms[r.term]): r.weight for r in listed} == pytest.approx(want)
    counted = tfidf.vocabulary_of(rec.counts, 9, 7000, 1)
    assert {tuple(r) for r in rec.vocabulary.collect()} == {tuple(r) for r in counted.collect()}
    some = rec.vectors(["job_id"], [rec.terms.terms.index("data")]).collect()
    assert all(w == [pytest.approx(want[j, "data"])] for j, _, w in some) and len(some) == 5


def test_vectors_move_nothing(spark):
    """Neither texts nor their terms are shuffled or sorted."""
    rec = plan.Recommender(jobs(spark), ["the"], min_df=1)
    one = rec.query_vectors(spark.createDataFrame([(1, "data spark")], "profile_id int, t string"), "t")
    scores = tfidf.score_one(rec.vectors(), tfidf.listed(one), "job_id")
    rows = {(r.job_id, round(r.score, 9)) for r in scores.collect()}
    asked = rec.query_weights(spark.createDataFrame([(1, "data spark")], "profile_id int, t string"), "t")
    assert rows == {(r.job_id, round(r.score, 9)) for r in tfidf.score_one(rec.weights(), asked, "job_id").collect()}
    for frame in (rec.vectors(), scores):
        plan_text = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan_text and "Sort" not in plan_text


def test_scores_of_one_profile_take_a_row_a_posting(spark):
    """join_term_sim: the plan from the stored gold on neither explodes, shuffles nor sorts postings."""
    scores = entry.queries()["join_term_sim"](spark, "/root/testdata/sf0.001")
    text = scores._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert "MapInArrow" in text and "Exchange" not in text and "Generate" not in text
    assert scores.count() > 0


def test_a_role_restricts_the_search(spark):
    rec = plan.Recommender(jobs(spark).withColumn("role_category", F.when(F.col("job_id") == "0", "x").otherwise("y")), ["the"], min_df=1)
    asked = spark.createDataFrame([(1, "data spark", "x"), (2, "data spark", None), (3, "data sql", "y")], "profile_id int, t string, role string")
    got = {(r.profile_id, r.job_id) for r in rec.scores(asked, "t", 9, "role").collect()}
    assert got == {(1, "0"), (3, "1"), (3, "5"), (3, "6"), (3, "8")}


def test_postings_are_not_stored_again(spark, monkeypatch):
    """adv_batch: gold is worked out once, for the role model too, and vectors of postings are not stored."""
    from vacancia.catalog import fixtures, models

    made, stored = [], []
    gold, keep = fixtures.gold, plan.materialize
    monkeypatch.setattr(fixtures, "gold", lambda *a: made.append(a) or gold(*a))
    for module in (plan, models):
        monkeypatch.setattr(module, "materialize", lambda df, name: stored.append(df.columns) or keep(df, name))
    rows = entry.queries()["adv_batch"](spark, "/root/testdata/sf0.001").collect()
    assert rows and len(made) == 1
    assert not any("job_id" in columns and "terms" in columns for columns in stored)


def test_documents_stay_where_they_are_for_few_queries(spark, monkeypatch):
    """ctx_retrieval, ctx_answer: the vectors of all documents were shuffled for a few hundred questions."""
    rng = np.random.default_rng(9)
    q, d = (rows(rng, n, "id", copies=3) for n in (40, 500))

    def table(frame):
        listed = [(int(r.id), r.terms.tolist(), r.weights.tolist(), "ab"[r.id % 2]) for r in frame.itertuples()]
        return spark.createDataFrame(listed, "id long, terms array<int>, weights array<double>, side string").repartition(5)

    asked, docs = table(q), table(d)
    for cell in (None, "side"):
        blocks = nearest.top_documents(asked, docs, "id", "id", 4, cell, rows_per_block=20)
        monkeypatch.setattr(nearest, "_HELD", 150)
        scanned = nearest.top_documents(asked, docs, "id", "id", 4, cell)
        text = scanned._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroups" not in text and text.split("MapInPandas")[1].count("Exchange") == 1  # the table's own
        assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, blocks.collect()))
    assert nearest.top_documents(asked.limit(0), docs, "id", "id", 4).collect() == []
