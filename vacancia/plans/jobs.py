"""Batch jobs from folder to folder; ``python -m vacancia`` runs them.

Every stage reads the stored table of the stage before, so a retry repeats one stage.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from vacancia import schema as S
from vacancia.operators import classify as K, dedup, joins, reports, standardise as N
from vacancia.plans import gold as G, matching as plan
from vacancia.session import materialize
from vacancia.sources import csv_files, sinks


def build_silver(spark: SparkSession, raw: str, out: str, stamp: str, multi_line: bool = True) -> None:
    """``<raw>/<source>/*.csv`` to ``silver_jobs``, the audit and the bad rows.

    ``multi_line=False`` reads every line as a record, so that large files are split.
    """
    rows, bad, headers = csv_files.read_tree(spark, raw, N.standardise_silver, multi_line)
    frame = rows.drop("file_path")
    silver = G.silver(frame, F.lit(stamp).cast("timestamp"))
    sinks.write_table(silver, f"{out}/silver_jobs", ["source"])
    audit = csv_files.file_audit(headers, rows, bad)
    sinks.write_table(
        joins.attach_metrics(audit, reports.silver_metrics(frame)), f"{out}/silver_audit_report")
    sinks.write_table(bad, f"{out}/bad_rows")


def build_master(spark: SparkSession, raw: str, sources: list[str], out: str, multi_line: bool = True) -> None:
    """Cross-source master with best-row dedup, its two reports, bad rows and file audit."""
    read = [csv_files.read_source(spark, raw, s, N.standardise_master, multi_line) for s in sources]
    loaded = materialize(N.union_all([rows for rows, _, _ in read]).drop("file_path"), "master-raw")
    sinks.write_table(N.union_all([bad for _, bad, _ in read]), f"{out}/bad_rows")
    sinks.write_table(
        N.union_all([csv_files.file_audit(headers, rows, bad) for rows, bad, headers in read]), f"{out}/file_audit")
    sinks.write_table(loaded, f"{out}/jobs_master_raw", ["source"])
    sinks.write_table(G.master(loaded), f"{out}/jobs_clean")
    counts = materialize(reports.rows_by_key(loaded), "by-key")
    sinks.write_table(reports.loaded_per_source(counts), f"{out}/source_report")
    sinks.write_table(reports.dedup_summary(counts), f"{out}/dedup_report")


def build_portal_master(spark: SparkSession, raw: str, source: str, out: str, multi_line: bool = True) -> None:
    """One portal's batches to its raw master and its newest row per posting.

    Postings without any id (a portal that has none) go by title, company, location.
    The batch of a row is the name of its file, which carries the time stamp.
    """
    rows, bad, headers = csv_files.read_globs(
        spark, [f"{raw}/{source}/batches/*.csv"], N.standardise_master, source, multi_line)
    sinks.write_table(bad, f"{out}/{source}_bad_rows")
    sinks.write_table(csv_files.file_audit(headers, rows, bad), f"{out}/{source}_file_audit")
    sinks.write_table(rows.drop("file_path"), f"{out}/{source}_master_raw")
    named = rows.withColumn("batch_ts", F.regexp_extract("file_path", r"([^/]+)$", 1)).drop("file_path")
    with_id, without = named.filter("job_id IS NOT NULL"), named.filter("job_id IS NULL")
    latest = dedup.last_by_id(with_id).unionByName(dedup.last_by_fields(without))
    sinks.write_table(latest.drop("batch_ts"), f"{out}/{source}_master_dedup")


def build_gold(spark: SparkSession, silver_path: str, out: str, stamp: str) -> None:
    """The three gold generations from the silver table."""
    silver = spark.read.schema(S.SILVER_SCHEMA).parquet(silver_path)
    at = F.lit(stamp).cast("timestamp")
    sinks.write_table(G.stamped(silver, at), f"{out}/gold_v1/gold_jobs", ["source"])
    for name, mart in G.marts_v1(silver).items():
        sinks.write_table(mart, f"{out}/gold_v1/{name}")
    for version, enrich, marts in (("v2", G.enrich_v2, G.marts_v2), ("v3", G.enrich, G.marts_v3)):
        enriched = G.stamped(enrich(silver), at)
        path = f"{out}/gold_{version}/enriched"
        sinks.write_table(enriched, path, ["source"])
        stored = spark.read.schema(enriched.schema).parquet(path)
        tables = dict(marts(stored))
        if version == "v3":
            tables["jobs_gold"] = G.fact(stored)
        for name, mart in tables.items():
            sinks.write_table(mart, f"{out}/gold_{version}/{name}")


def export_bi(spark: SparkSession, gold_path: str, out: str) -> None:
    """The BI tables as CSV; the job overview stays in many files."""
    for name, mart in G.bi_tables(spark.read.parquet(f"{gold_path}/enriched")).items():
        sinks.write_bi_csv(mart, f"{out}/{name}", one_file=name != "job_overview")


def train_roles(
    spark: SparkSession, gold_path: str, out: str, with_title: bool = True, **settings
) -> str:
    """Fit the six families, store the comparison, the report and the best pipeline.

    The label is a rule over the title, so with the title in the text the scores show
    how well a model recovers that rule; ``with_title=False`` leaves it out.
    """
    from vacancia.functions import text as X

    gold = spark.read.parquet(f"{gold_path}/enriched")
    if not with_title:
        gold = gold.withColumn(
            "combined_text", F.concat_ws(" ", X.clean_basic("skills"), X.clean_basic("description")))
    data = materialize(N.known_role(gold).select("job_id", "combined_text", "role_category"), "roles")
    encode, indexer, families, train, test = plan.train(
        data, "combined_text", "role_category", "job_id", **settings)
    encoded = materialize(encode.transform(train).select("features", "label", "class_weight"), "train")
    held_out = materialize(encode.transform(test).select("features", "label"), "test")
    models, scored = {}, []
    for name, family in families.items():
        models[name] = plan.fit_family(encode, indexer, family, encoded)
        predicted = models[name].stages[1].transform(held_out)
        for column, text in (("label", "true_role"), ("prediction", "predicted_role")):
            predicted = K.label_text(indexer, column, text).transform(predicted)
        scored.append(predicted.select(
            F.lit(name).alias("model"), F.col("true_role").alias("label"),
            F.col("predicted_role").alias("prediction")))
    predictions = materialize(N.union_all(scored), "predictions")
    comparison = K.compare(predictions)
    sinks.write_table(comparison, f"{out}/role_model_comparison")
    best = comparison.first()["model"]
    sinks.write_table(
        K.report_with_averages(predictions.filter(F.col("model") == best)), f"{out}/best_model_report")
    models[best].write().overwrite().save(f"{out}/best_role_model")
    return best


def train_recommender(spark: SparkSession, gold_path: str, out: str, stop_words=()) -> None:
    """Store the recommender's vocabulary and its posting vectors."""
    rec = plan.Recommender(spark.read.parquet(f"{gold_path}/enriched"), stop_words)
    sinks.write_table(rec.vocabulary, f"{out}/vocabulary")
    sinks.write_table(rec.weights(), f"{out}/job_vectors")


def advise(spark: SparkSession, gold_path: str, models: str, profiles: DataFrame, out: str,
           stop_words=()) -> None:
    """(profile_id, profile_text) rows to one advice row each, with the stored models."""
    jobs = spark.read.parquet(f"{gold_path}/enriched")
    rec = plan.Recommender(
        jobs, stop_words, vocabulary=spark.read.parquet(f"{models}/vocabulary"))
    role_model = PipelineModel.load(f"{models}/best_role_model")
    # Several branches read the predictions; the model runs once.
    asked = materialize(plan.predict(role_model, profiles, "profile_text", "combined_text"), "predicted")
    sinks.write_table(plan.advise(asked, jobs, rec, "predicted_role"), out)
