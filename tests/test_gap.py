import pytest
from pyspark.sql import functions as F

from vacancia.functions import enrich as E
from vacancia.operators import demand, gap

JOBS = [("DE", ["sql", "spark"]), ("DE", ["sql"]), ("DE", ["sql", "etl"]), ("DE", []), ("BI", ["excel", "sql"])]


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame(JOBS, "role_category string, extracted_skills array<string>")


def profiles(spark, *rows):
    df = spark.createDataFrame(list(rows), "profile_id int, profile_text string, target_role string")
    return df.withColumn("owned_skills", E.raw_tokens("profile_text"))


def test_ranking_ties_by_skill_and_share_of_all_role_jobs(jobs):
    rows = gap.ranked_role_skills(jobs, 2).filter("role_category = 'DE'").orderBy("skill_rank").collect()
    assert [(r.skill, r.job_count, r.demand_percent) for r in rows] == [("sql", 3, 75.0), ("etl", 1, 25.0)]


def test_weighted_percent(spark, jobs):
    matched = gap.match_role(profiles(spark, (1, "SQL mysql", "de")), jobs, "ignore_case")
    rows = gap.gap_rows(matched, gap.ranked_role_skills(jobs, 15), "exact")
    got = gap.gap_scores(rows, "demand_percent").first()
    assert (got.match_score, got.available_skills, got.missing_skills) == (60.0, 1, 2)
    assert gap.learning_path(rows).first().learning_path == "etl, spark"
    assert gap.largest_gap(rows).first().largest_gap == "etl"


def test_exact_role_is_case_sensitive(spark, jobs):
    assert gap.match_role(profiles(spark, (1, "x", "de")), jobs, "exact").count() == 0


def test_fallback_uses_the_whole_market(spark, jobs):
    matched = gap.match_role(profiles(spark, (1, "excel", "Chef"), (2, "", "BI")), jobs, "fallback")
    got = {r.profile_id: r for r in matched.collect()}
    assert (got[1].market_role, got[1].role_market_jobs) == ("*", 5)
    assert (got[2].market_role, got[2].role_market_jobs) == ("BI", 1)
    rows = gap.gap_rows(matched, gap.ranked_role_skills(jobs, 20, whole_market=True), "either")
    scores = {r.profile_id: r.match_score for r in gap.gap_scores(rows, "job_count").collect()}
    assert scores == {1: 14.29, 2: 0.0}


def test_role_without_skills_and_phrases(spark, jobs):
    jobs = jobs.unionByName(spark.createDataFrame([("HR", []), ("BI", ["power bi"])], jobs.schema))
    asked = profiles(spark, (1, "excel", "HR"), (2, "Power  BI", "BI")).withColumn(
        "owned_skills", gap.profile_skills("profile_text", E.phrase_hits("profile_text", ["power bi", "excel"])))
    rows = gap.gap_rows(gap.match_role(asked, jobs), gap.ranked_role_skills(jobs, 15), "either")
    got = {r.profile_id: (r.match_score, r.available_skills, r.missing_skills)
           for r in gap.gap_scores(rows, "job_count").collect()}
    assert got == {1: (0.0, 0, 0), 2: (33.33, 1, 2)}
    assert {r.profile_id: r.learning_path for r in gap.learning_path(rows).collect()}[1] == ""


def test_nothing_missing_leaves_no_gap(spark, jobs):
    matched = gap.match_role(profiles(spark, (1, "excel sql", "BI")), jobs, "exact")
    rows = gap.gap_rows(matched, gap.ranked_role_skills(jobs, 15), "substring")
    assert gap.gap_scores(rows, "unit").first().match_score == 100.0
    assert gap.largest_gap(rows).first().largest_gap is None
    assert gap.learning_path(rows).first().learning_path == ""


def test_profile_phrases_need_the_market(spark, jobs):
    asked = profiles(spark, (1, "power  bi, Excel", "BI"))
    got = gap.phrases_in_market(asked, demand.skill_demand(jobs), ["power bi", "excel"])
    assert sorted(r.skill for r in got.collect()) == ["bi", "excel", "power"]


def test_shares_and_empty_input(spark, jobs):
    shares = demand.share(demand.skill_demand(jobs), jobs)
    assert {r.skill: r.demand_percent for r in shares.collect()}["sql"] == 80.0
    empty = jobs.filter(F.lit(False))
    assert demand.share(demand.skill_demand(empty), empty).count() == 0
    assert demand.skill_demand(empty).columns == ["skill", "job_count"]


def test_matrix_order(jobs):
    rows = demand.sorted_role_skill(demand.role_skill(jobs)).collect()
    assert [(r.role_category, r.skill, r.job_count) for r in rows] == [
        ("BI", "excel", 1), ("BI", "sql", 1), ("DE", "sql", 3), ("DE", "etl", 1), ("DE", "spark", 1)]


def test_counts_add_up(jobs):
    assert demand.demand(jobs, "role_category").agg(F.sum("job_count")).first()[0] == len(JOBS)
    each = demand.demand_by_each(jobs, ["role_category"])
    assert {(r.item, r.job_count) for r in each.collect()} == {("DE", 4), ("BI", 1)}
