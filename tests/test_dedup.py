from vacancia.operators import dedup, joins, reports, standardise as N
from vacancia.plans import gold as G


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


COLUMNS = "title string, company string, location string, source string, scraped_at string"


def test_best_row_and_its_sources(spark):
    rows = [("Dev", "Acme Ltd", "Pune", "b", "2"), ("dev ", "ACME", "Pune", "a", "3"), ("Dev", "Acme", "Pune", "a", None),
            ("Dev", "Acme", None, "c", "9"), ("!!", "Acme", "Pune", "c", "9"), ("Dev", "Ltd", "Pune", "c", "9")]
    out = {r.dedup_key: r for r in G.master(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert set(out) == {"dev|acme|pune", "dev|acme|"}
    best = out["dev|acme|pune"]
    assert (best.scraped_at, best.source_count, best.sources_available) == ("3", 2, "a,b")


def test_hot_key_keeps_one_row_and_limits_before_the_shuffle(spark):
    df = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    out = dedup.keep_first(df, ["k"], [df.v.desc()])
    assert out.filter("k = 0").first().v == 29997 and out.count() == 20001
    limits = [line for line in plan_of(out).splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    # Read bottom up: partial limit, shuffle, final limit.
    assert ["Partial" in limits[-1], "Exchange" in limits[-2], "Final" in limits[-3]] == [True] * 3


def test_last_by_fields_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([("a", None, "x", "1"), ("a", None, "x", "2"), ("a", "", "x", "1")],
                               "title string, company string, location string, batch_ts string")
    got = {(r.company, r.batch_ts) for r in dedup.last_by_fields(df).collect()}
    assert got == {(None, "2"), ("", "1")}


def test_first_lowered_normalises_in_place(spark):
    df = spark.createDataFrame([(" Dev", "A", "X", 1), ("dev ", "a", "x", 2)],
                               "title string, company string, location string, n int")
    rows = dedup.first_lowered(df).collect()
    assert [(r.title, r.n) for r in rows] == [("dev", 1)]


def test_upsert_takes_newer_and_adds(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, v string, ver int")
    new = spark.createDataFrame([(2, "B", 1), (3, "C", 1)], "id int, v string, ver int")
    assert sorted((r.id, r.v) for r in dedup.upsert(old, new, "id", "ver").collect()) == [
        (1, "a"), (2, "B"), (3, "C")]


def test_silver_metrics_add_up(spark):
    cols = "job_title string, company string, location string, source string"
    df = spark.createDataFrame([("A ", "b", None, "s"), ("a", "B", None, "s"), (None, "b", "x", "s"), ("c", "d", "x", "s")], cols)
    m = reports.silver_metrics(df).first().asDict()
    assert m == {"total_raw_rows": 4, "rows_after_null_removal": 3, "null_rows_removed": 1,
                 "duplicates_removed": 1, "final_silver_rows": 2}
    full = df.selectExpr("*", *[f"cast(null as string) AS {c}" for c in
                                ("experience", "salary", "skills", "description", "job_url", "posted_date")])
    assert G.silver(full).count() == m["final_silver_rows"]


def test_reports_on_empty_input(spark):
    cols = "title string, company string, location string, source string"
    got = {r.metric: r.value for r in reports.dedup_summary(reports.rows_by_key(spark.createDataFrame([], cols))).collect()}
    assert set(got.values()) == {0}


def test_profile_counts_copies_after_the_first(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", None), (None, "b")], "x string, y string")
    got = {r.metric: r.value for r in reports.profile(df).collect()}
    assert got == {"rows": 4, "columns": 2, "duplicate_rows": 2, "nulls:x": 1, "nulls:y": 3}


def test_match_roles_one_row_per_match(spark):
    df = spark.createDataFrame([(1, "Senior DATA Engineer", "azure data engineer wanted")],
                               "job_id int, title string, description string")
    out = joins.match_roles(df, fields=["title", "description"]).orderBy("role_position").collect()
    assert [(r.category, r.searched_role) for r in out] == [
        ("engineering", "data engineer"), ("engineering", "azure data engineer")]
    assert dedup.first_role_match(joins.match_roles(df, fields=["title", "description"])).count() == 1


def test_standardise_prefers_the_column_with_the_target_name(spark):
    df = spark.createDataFrame([("x", None, "keep")], "jd string, description string, company string")
    row = N.standardise_master(df, "s").first()
    assert (row.description, row.company, row.source, row.title) == ("x", "keep", "s", None)
