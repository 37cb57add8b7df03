"""Folder-to-folder run of all jobs on a small raw tree."""

from vacancia.plans import jobs

TITLES = {"Data Engineer": "sql spark etl", "Data Analyst": "excel power bi", "Python Developer": "python docker git"}


def raw_tree(root):
    for source in ("shine", "foundit"):
        for batch in ("20260101", "20260102"):
            folder = root / source / "batches"
            folder.mkdir(parents=True, exist_ok=True)
            lines = ["job_id,title,company,location,experience,salary,skills,description,scraped_at"]
            for i in range(30):
                title = list(TITLES)[i % 3]
                lines.append(f'{i},{title} {i},Firm {i % 7},Pune,{i % 9}-9 Yrs,{i % 20 + 1} LPA,"{TITLES[title]}",needs {TITLES[title]},{batch}')
            text = "\n".join(lines) + "\n"
            (folder / f"{source}_{batch}.csv").write_text(text)
            (root / source / "all.csv").write_text(text)


def test_all_jobs_end_to_end(spark, tmp_path):
    raw_tree(tmp_path / "raw")
    root = f"file://{tmp_path}"
    raw, gold = f"{root}/raw", f"{root}/gold/gold_v3"
    jobs.build_silver(spark, raw, f"{root}/silver", "2026-01-01 00:00:00")
    silver = spark.read.parquet(f"{root}/silver/silver_jobs")
    assert silver.count() == 60 and silver.select("source").distinct().count() == 2
    audit = spark.read.parquet(f"{root}/silver/silver_audit_report")
    assert {(r.raw_count, r.total_raw_rows, r.final_silver_rows) for r in audit.collect()} == {(30, 60, 60)}

    jobs.build_master(spark, raw, ["shine", "foundit", "absent"], f"{root}/master")
    clean = spark.read.parquet(f"{root}/master/jobs_clean")
    assert clean.count() == 30 and {r.sources_available for r in clean.collect()} == {"foundit,shine"}
    summary = {r.metric: r.value for r in spark.read.parquet(f"{root}/master/dedup_report").collect()}
    assert summary["total_raw_rows_loaded"] == 180
    assert summary["duplicates_removed_cross_source"] + summary["final_clean_unique_rows"] == 180

    jobs.build_portal_master(spark, raw, "shine", f"{root}/portal")
    latest = spark.read.parquet(f"{root}/portal/shine_master_dedup")
    assert latest.count() == 30 and {r.scraped_at for r in latest.collect()} == {"20260102"}

    jobs.build_gold(spark, f"{root}/silver/silver_jobs", f"{root}/gold", "2026-01-01 00:00:00")
    roles = {r.role_category: r.job_count for r in spark.read.parquet(f"{gold}/role_demand").collect()}
    assert roles == {"Data Engineer": 20, "Data Analyst / BI": 20, "Software / Backend": 20}
    jobs.export_bi(spark, gold, f"{root}/bi")
    kpi = spark.read.option("header", True).csv(f"{root}/bi/kpi_summary")
    assert {r.metric: r.value for r in kpi.collect()}["Total Jobs"] == "60"

    best = jobs.train_roles(spark, gold, f"{root}/models", trees=5, rounds=2, epochs=20, iterations=20)
    comparison = spark.read.parquet(f"{root}/models/role_model_comparison")
    assert comparison.count() == 6 and comparison.filter(comparison.model == best).first().weighted_f1 > 0.9
    jobs.train_recommender(spark, gold, f"{root}/models")
    profiles = spark.createDataFrame([(1, "sql spark etl"), (2, "excel power bi")], "profile_id int, profile_text string")
    jobs.advise(spark, gold, f"{root}/models", profiles, f"{root}/advice")
    advice = {r.profile_id: r for r in spark.read.parquet(f"{root}/advice").collect()}
    assert len(advice) == 2 and advice[1].recommended.count("\n") == 9
