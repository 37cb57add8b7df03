import datetime

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vacancia import schema as S
from __spark_entry__ import queries
from vacancia.operators import classify as K, context, demand as M
from vacancia.plans import gold as G, matching as plan

RAW = "job_title string, company string, location string, experience string, salary string, skills string, description string, job_url string, posted_date string, source string"
ROWS = [
    (" Data Engineer ", "Acme", "Pune", "2-4 Yrs", "5 LPA", "SQL, Spark", "etl with python", "u", "d", "shine"),
    ("data engineer", "ACME", "pune", "2-4 Yrs", "5 LPA", "SQL, Spark", "etl with python", "u", "d", "shine"),
    ("Power BI Analyst", "Beta", None, None, "Not disclosed", "Excel", None, None, None, "foundit"),
    (None, "Beta", None, None, None, None, None, None, None, "foundit"),
    ("Chef", "Gamma", "Goa", "0", "10,000", None, "cook", None, None, "foundit"),
]


@pytest.fixture
def gold(spark):
    return G.enrich(G.silver(spark.createDataFrame(ROWS, RAW)))


def test_silver_to_gold(gold):
    rows = {r.job_title: r for r in gold.collect()}
    assert set(rows) == {"data engineer", "power bi analyst", "chef"}
    engineer = rows["data engineer"]
    assert engineer.extracted_skills == ["etl", "python", "spark", "sql"] and engineer.skill_count == 4
    assert (engineer.role_category, engineer.salary_avg) == ("Data Engineer", 500000.0)
    assert rows["power bi analyst"].location is None and rows["chef"].experience_bucket == "Fresher"


def test_fact_columns_and_stamp(spark, gold):
    stamp = F.lit(datetime.datetime(2026, 1, 1))
    fact = G.fact(G.stamped(gold, stamp))
    assert fact.columns == S.FACT_V3
    v2 = G.enrich_v2(G.silver(spark.createDataFrame(ROWS, RAW)))
    assert G.fact(G.stamped(v2, stamp), S.FACT_V2).columns == S.FACT_V2


def test_all_marts_build(spark, gold):
    for tables in (G.marts_v3(gold), G.bi_tables(gold)):
        for name, mart in tables.items():
            assert mart.columns and mart.count() >= 0, name
    quality = {r.metric: r.value for r in G.marts_v3(gold)["gold_quality_report"].collect()}
    assert quality["total_gold_jobs"] == 3 and quality["jobs_with_valid_salary"] == 1
    assert quality["jobs_with_raw_salary"] == 2 and quality["avg_skills_per_job"] == 2.0
    v1 = G.marts_v1(G.silver(spark.createDataFrame(ROWS, RAW)))
    assert {r.skill for r in v1["skill_demand"].collect()} == {"sql", "spark", "excel"}


def test_documents_print_null_as_empty(gold):
    text = G.documents_v3(gold).filter("document_text LIKE '%power bi%'").first().document_text
    assert "Location: \nExperience: \n" in text and "nan" not in text


def test_split_is_exact_per_label_and_repeatable(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('c', id % 7)) AS label")
    split = K.stratified_split(df, "label", "id")
    for r in split.groupBy("label").agg(F.count("id").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r.t == round(r.n * 0.2)
    assert split.count() == 1000
    again = K.stratified_split(df.repartition(7), "label", "id")
    assert split.exceptAll(again).count() == 0


def test_class_report_by_hand(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    df = spark.createDataFrame(pairs, "label string, prediction string")
    got = {r["class"]: r for r in K.class_report(df).collect()}
    assert got["a"].precision == pytest.approx(0.75) and got["a"].recall == pytest.approx(0.75)
    assert got["b"].f1 == pytest.approx(0.8) and (got["c"].precision, got["c"].f1) == (0.0, 0.0)
    best = K.compare(df.withColumn("model", F.lit("m"))).first()
    assert best.accuracy == pytest.approx(5 / 7) and best.macro_f1 == pytest.approx((0.75 + 0.8) / 3)
    assert K.report_with_averages(df).count() == 5


def test_balanced_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "label string")
    assert {r.label: r.class_weight for r in K.class_weights(df, "label").collect()} == {
        "a": pytest.approx(4 / 6), "b": 2.0}


@pytest.fixture(scope="module")
def corpus(spark):
    words = {"Data": "sql etl spark", "Web": "html css react", "Ops": "linux docker bash"}
    rows = [(f"{r}-{i}", f"{w} number{i % 9}", r) for r, w in words.items() for i in range(60)]
    return spark.createDataFrame(rows, "job_id string, combined_text string, role_category string")


def test_every_family_learns_and_predicts_text(spark, corpus):
    encode, indexer, families, train, test = plan.train(
        corpus, "combined_text", "role_category", "job_id", trees=10, rounds=3, epochs=40, iterations=50)
    encoded = encode.transform(train).select("features", "label", "class_weight").persist()
    assert test.count() == 36
    for name, family in families.items():
        model = plan.fit_family(encode, indexer, family, encoded)
        asked = spark.createDataFrame([(1, "linux docker bash"), (2, "HTML css react")], "profile_id int, profile_text string")
        got = {r.profile_id: r.predicted_role for r in plan.predict(model, asked, "profile_text", "combined_text").collect()}
        assert got == {1: "Ops", 2: "Web"}, name


def test_forest_keeps_nodes_and_grows_the_same_trees(spark):
    """The nodes of rows are kept from level to level; the trees are those of walking them anew."""
    rows = spark.range(300).select(
        array_to_vector(F.array(*(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(9)).cast("double") for i in range(5)))).alias("features"),
        F.pmod(F.xxhash64("id"), F.lit(3)).cast("double").alias("label"), F.lit(1.0).alias("class_weight")).localCheckpoint()
    forest = K.estimators(5, 3, 300, trees=4)["Random Forest"]
    assert forest.getCacheNodeIds()
    walked = forest.copy().setCacheNodeIds(False).fit(rows)
    assert forest.fit(rows).toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_forest_grows_in_parts(spark, tmp_path, monkeypatch):
    """No fit holds a row's draws and nodes of more trees than a part has; all trees are in the model."""
    rows = spark.range(300).select(
        array_to_vector(F.array(*(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(9)).cast("double") for i in range(5)))).alias("features"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)).cast("double").alias("label"), F.lit(1.0).alias("class_weight")).localCheckpoint()
    forest = K.estimators(5, 3, 300, trees=7)["Random Forest"]
    fit, sizes = K.Forest._fit_java, []
    monkeypatch.setattr(K, "_TREES_AT_ONCE", 3)
    monkeypatch.setattr(K.Forest, "_fit_java", lambda self, df: sizes.append((self.getNumTrees(), self.getSeed())) or fit(self, df))
    model = forest.fit(rows)
    assert sizes == [(3, 42), (3, 45), (1, 48)] and forest.getNumTrees() == 7
    assert model.getNumTrees == 7 and len(model.trees) == 7 and model.numClasses == 3
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) == 7
    model.write().save(f"file://{tmp_path}/forest")
    read = type(model).load(f"file://{tmp_path}/forest")
    found = [[r.prediction for r in m.transform(rows).collect()] for m in (model, read)]
    assert found[0] == found[1] and sum(p == r.label for p, r in zip(found[0], rows.collect())) > 200


def test_features_have_unit_length_and_shifted_idf(spark, corpus):
    features = K.fit_features(corpus, "combined_text", max_features=5, stop_words=[])
    row = features.transform(corpus).first()
    assert row.features.size == 5 and row.features.norm(2) == pytest.approx(1.0)


def test_recommender_and_advisor(spark, gold):
    recommender = plan.Recommender(gold, min_df=1)
    profiles = spark.createDataFrame(
        [(1, "Python SQL", "Data Engineer"), (2, "cook", "Chef Role")], "profile_id int, profile_text string, role string")
    listed = recommender.recommend(profiles, "profile_text", 2).collect()
    assert {r.job_title for r in listed if r.profile_id == 2} == {"chef"}
    out = {r.profile_id: r for r in plan.advise(profiles, gold, recommender, "role").collect()}
    assert out[1].match_score == 50.0 and out[1].missing == "etl, spark"
    assert out[1].recommended.startswith("- data engineer at acme, match score ")
    assert out[2].role_market_jobs == 3 and out[2].recommended is None


def test_market_context_skips_empty_lines(spark, gold):
    profiles = spark.createDataFrame(
        [(1, "Data Engineer", 1, 50.0, "sql", "", None)],
        "profile_id int, role string, role_market_jobs int, match_score double, available string, missing string, recommended string")
    text = context.market_context(gold, profiles).first().context
    assert text.startswith("Total cleaned job records: 3\nRole demand:\n- ")
    assert "Profile match: 50.0%\nAvailable skills: sql" in text and "Missing" not in text


def test_market_prompt_is_screened_as_a_whole(spark):
    from vacancia.operators import screening

    df = spark.createDataFrame(
        [("jobs: 3", "which skills?"), ("jailbreak expert wanted", "ok?")], "context string, question string")
    rows = screening.verdict(context.market_prompt(df, "question"), "prompt").collect()
    assert rows[0].prompt == "\nJob Market Context:\njobs: 3\n\nUser Question:\nwhich skills?\n"
    assert [r.is_safe for r in rows] == [True, False]


def test_retrieval_context_orders_by_rank(spark):
    ranked = spark.createDataFrame(
        [(1, "q?", 2, "B", None, "", "", "two"), (1, "q?", 1, "A", "c", "l", "s", "one")],
        "qid int, question string, rank int, title string, company string, location string, skills string, document_text string")
    row = context.retrieval_context(ranked, "qid", "question").first()
    assert row.context == ("\nJob 1\nTitle: A\nCompany: c\nLocation: l\nSkills: s\nDescription:\none\n"
                           "\nJob 2\nTitle: B\nCompany: \nLocation: \nSkills: \nDescription:\ntwo\n")
    assert row.prompt.endswith("\n\nUSER QUESTION:\nq?\n")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_salary_is_cut_once_in_each_place_that_reads_it(gold):
    """The filter's two bounds and the projection: it was cut 6 times with 48 patterns."""
    plan = _plan(M.salary_insights(gold))
    assert plan.count("regexp_extract_all") <= 3 and plan.count("btrim") + plan.count("trim(") <= 9


def test_report_left_works_gold_out_once(spark):
    df = queries()["join_report_left"](spark, "/root/testdata/sf0.001")
    assert "Window" not in _plan(df)  # both sides read the stored columns


def test_split_rows_are_stored_for_the_fits(spark):
    df = spark.range(60).selectExpr("id AS k", "concat('l', id % 2) AS y", "concat('word', id % 2, ' other') AS text")
    *_, known, held_out = plan.train(df, "text", "y", "k")
    # Every fit and encoding split the rows anew.
    assert (known.count(), held_out.count()) == (48, 12) and "Window" not in _plan(held_out)
