"""Tall (metric, value) reports and table profiles, each from one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.functions import text as X
from vacancia.operators.reshape import explode_items


def tall(one_row: DataFrame, kind: str = "bigint") -> DataFrame:
    """A one-row frame as (metric, value) rows."""
    cast = one_row.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c in one_row.columns])
    return cast.unpivot([], cast.columns, "metric", "value")


def kpi(df: DataFrame) -> DataFrame:
    """Eight headline numbers; the training-set size is counted, not a constant."""
    skills = explode_items(df, [], "extracted_skills", "skill")
    distinct_skills = skills.agg(F.countDistinct("skill")).scalar()
    one = df.agg(
        F.count(F.lit(1)).alias("Total Jobs"),
        F.countDistinct("company").alias("Unique Companies"),
        F.countDistinct("location").alias("Unique Locations"),
        F.countDistinct("source").alias("Sources"),
        F.countDistinct("role_category").alias("Role Categories"),
        F.count_if(F.col("role_category") != "Other").alias("ML Role Dataset Records"),
    )
    one = one.withColumns(
        {"Skills Extracted": distinct_skills, "Records for RAG": F.col("`Total Jobs`")}
    )
    return tall(one)


def gold_quality_v2(df: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return tall(
        df.agg(
            rows.alias("silver_input_rows"),
            rows.alias("gold_fact_rows"),
            F.countDistinct("company").alias("unique_companies"),
            F.countDistinct("location").alias("unique_locations"),
            F.countDistinct("role_category").alias("unique_roles"),
            F.coalesce(F.sum(F.size("extracted_skills")), F.lit(0)).alias("skill_records"),
            rows.alias("rag_documents"),
            rows.alias("ml_dataset_rows"),
        )
    )


def gold_quality_v3(df: DataFrame, low: float, high: float) -> DataFrame:
    rows = F.count(F.lit(1))
    valid = F.count_if(F.col("salary_avg").between(low, high))
    return tall(
        df.agg(
            rows.alias("total_gold_jobs"),
            F.countDistinct("company").alias("unique_companies"),
            F.countDistinct("location").alias("unique_locations"),
            F.countDistinct("source").alias("unique_sources"),
            F.count("salary_avg").alias("jobs_with_raw_salary"),
            valid.alias("jobs_with_valid_salary"),
            (rows - valid).alias("jobs_without_valid_salary"),
            F.count_if(F.col("skill_count") > 0).alias("jobs_with_extracted_skills"),
            X.rounded(F.avg("skill_count")).alias("avg_skills_per_job"),
            F.count_if(F.col("role_category") != "Other").alias("ml_role_dataset_rows"),
            valid.alias("ml_salary_dataset_rows"),
            rows.alias("rag_documents"),
        ),
        "double",
    )


def rows_by_key(df: DataFrame) -> DataFrame:
    """(source, k, n): rows of a master by source and dedup key, counted map-side.

    Rows with no text in title or company share the NULL key.
    """
    kept = X.strict_left("title") & X.company_left("company")
    key = F.when(kept, X.dedup_key("title", "company", "location"))
    return df.groupBy("source", key.alias("k")).agg(F.count(F.lit(1)).alias("n"))


def dedup_summary(counts: DataFrame) -> DataFrame:
    """Loaded, kept by the filter, unique and removed rows, from :func:`rows_by_key`."""
    per_key = counts.groupBy("k").agg(F.sum("n").alias("n"))
    loaded = F.coalesce(F.sum("n"), F.lit(0))
    after = F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n"))), F.lit(0))
    return tall(
        per_key.agg(
            loaded.alias("total_raw_rows_loaded"),
            after.alias("rows_after_title_company_filter"),
            F.count("k").alias("final_clean_unique_rows"),
            (after - F.count("k")).alias("duplicates_removed_cross_source"),
        )
    )


def loaded_per_source(counts: DataFrame) -> DataFrame:
    """Rows of each source, from :func:`rows_by_key`."""
    return counts.groupBy("source").agg(F.sum("n").alias("rows_loaded"))


def rows_per_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("rows_loaded"))


def silver_metrics(df: DataFrame) -> DataFrame:
    """One row: raw, kept, null-removed, duplicate and final counts of the silver build."""
    complete = F.col("job_title").isNotNull() & F.col("company").isNotNull()
    key = X.job_id(
        *[X.clean_basic(c) for c in ("job_title", "company", "location")], F.col("source")
    )
    # The id's 16 bytes: as text it is twice as long, and its letters do not compress.
    per_key = df.groupBy(F.when(complete, F.unhex(key)).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    kept = F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n"))), F.lit(0))
    return per_key.agg(
        total.alias("total_raw_rows"),
        kept.alias("rows_after_null_removal"),
        (total - kept).alias("null_rows_removed"),
        (kept - F.count("k")).alias("duplicates_removed"),
        F.count("k").alias("final_silver_rows"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Rows, columns, duplicate rows and NULLs per column as (metric, value).

    Duplicates are the copies after the first of each full row. The per-row
    digest makes the distinct count shuffle 16 bytes instead of whole rows.
    """
    digest = F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    cols = {c: F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in df.columns}
    base = df.select(*df.columns, digest.alias("_row"))
    one = base.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        (F.count(F.lit(1)) - F.countDistinct("_row")).alias("duplicate_rows"),
        *cols.values(),
    )
    return tall(one)


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """The first n rows in the order of all columns."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)


def melt(df: DataFrame, key: str, columns) -> DataFrame:
    """Numeric report columns as (key, metric, value)."""
    cast = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot([key], list(columns), "metric", "value")


