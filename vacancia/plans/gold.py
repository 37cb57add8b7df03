"""Silver build, gold enrichment and the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia import dictionaries as D, schema as S
from vacancia.functions import enrich as E, text as X
from vacancia.operators import demand as M, dedup, reports, standardise as T


def clean(df: DataFrame) -> DataFrame:
    """Rows with title and company, text lower-cased, plus the md5 id. NULLs stay NULL."""
    out = T.required(df).withColumns({
        **{c: X.strip(F.lower(F.col(c))) for c in ("job_title", "company", "location")},
        **{c: F.lower(F.col(c)) for c in ("skills", "description")},
    })
    return out.withColumn("job_id", X.job_id())


def silver(df: DataFrame, processed_at=None) -> DataFrame:
    """Clean rows, one per id; ``processed_at`` is a timestamp literal or nothing."""
    out = dedup.first_by_id(clean(df))
    return out if processed_at is None else out.withColumn("processed_at", processed_at)


def master(df: DataFrame) -> DataFrame:
    """Cross-source master: best row per dedup key with its source sets."""
    return dedup.best_row(dedup.with_dedup_key(T.non_blank(df)))


def enrich(
    df: DataFrame, skills=D.SKILLS_WORD, roles=D.ROLES_V3, default_role=D.ROLE_DEFAULT_V3,
    experience=D.EXPERIENCE_V3, strip_thousands: bool = False,
) -> DataFrame:
    """Third-generation enrichment of a silver frame."""
    df = T.backfill(df).withColumn("combined_text", X.combined_text())
    return df.withColumns({
        "role_category": E.role_v3("job_title", roles, default_role),
        "experience_bucket": E.exp_bucket("experience", experience),
        "extracted_skills": E.skills_word("combined_text", skills),
        "_salary": E.salary("salary", strip_thousands),
    }).withColumn("skill_count", F.size("extracted_skills")).select("*", "_salary.*").drop("_salary")


def enrich_v2(
    df: DataFrame, skills=D.SKILLS_SUBSTRING, roles=D.ROLES_V2, default_role=D.ROLE_DEFAULT_V2,
) -> DataFrame:
    """Second-generation enrichment: substring skills, five roles, coarser experience."""
    df = T.backfill(df).withColumn("combined_text", X.combined_text(clean=False))
    return df.withColumns({
        "role_category": E.role_v2("job_title", roles, default_role),
        "experience_group": E.exp_bucket("experience", D.EXPERIENCE_V2),
        "extracted_skills": E.skills_substring("combined_text", skills),
    })


def stamped(df: DataFrame, stamp) -> DataFrame:
    return df.withColumn("gold_processed_at", stamp)


def fact(df: DataFrame, columns=S.FACT_V3) -> DataFrame:
    """Fact columns with the skill list as ", "-joined text."""
    return df.withColumn("extracted_skills", F.array_join("extracted_skills", ", ")).select(*columns)


def documents_v1(df: DataFrame) -> DataFrame:
    parts = [("Job Title", "job_title"), ("Company", "company"), ("Skills Required", "skills"),
             ("Experience", "experience"), ("Description", "description")]
    return df.select(X.document_text(parts).alias("document"))


def documents_v2(df: DataFrame) -> DataFrame:
    skills = F.array_join("extracted_skills", ", ")
    parts = [("Job Title", "job_title"), ("Company", "company"), ("Location", "location"),
             ("Experience", "experience"), ("Salary", "salary"), ("Skills", skills),
             ("Description", "description")]
    return df.select("job_id", X.document_text(parts).alias("document_text"))


def document_v3():
    skills = F.array_join("extracted_skills", ", ")
    return X.document_text([
        ("Job Title", "job_title"), ("Company", "company"), ("Location", "location"),
        ("Experience", "experience"), ("Role Category", "role_category"), ("Skills", "skills"),
        ("Extracted Skills", skills), ("Description", "description")])


def documents_v3(df: DataFrame) -> DataFrame:
    return df.select("job_id", "role_category", "source", document_v3().alias("document_text"))


def ml_v1(df: DataFrame) -> DataFrame:
    return df.select("job_title", "skills", "description", "experience")


def ml_v2(df: DataFrame) -> DataFrame:
    return df.select(
        "job_title", "company", "location", "experience_group", "role_category",
        F.array_join("extracted_skills", ", ").alias("extracted_skills"), "source",
    )


def ml_role(df: DataFrame) -> DataFrame:
    return T.known_role(df).select(
        "combined_text", "role_category", "experience_bucket", "skill_count", "source"
    )


def ml_salary(df: DataFrame) -> DataFrame:
    return T.salary_band(df).select(
        "job_title", "company", "location", "role_category", "experience_bucket",
        "skill_count", "source", "salary_avg",
    )


def marts_v1(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "skill_demand": M.raw_skill_demand(df),
        "company_demand": M.demand(df, "company"),
        "location_demand": M.demand(df, "location"),
        "role_demand": M.demand(df, "job_title"),
        "experience_analysis": M.demand(df, "experience", name="count"),
        "ml_dataset": ml_v1(df),
        "rag_documents": documents_v1(df),
    }


def marts_v2(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "fact_jobs": fact(df, S.FACT_V2),
        "skill_demand": M.skill_rows(df),
        "top_skills": M.skill_demand(df),
        "role_demand": M.demand(df, "role_category"),
        "company_demand": M.demand(df, "company"),
        "location_demand": M.demand(df, "location"),
        "experience_demand": M.demand(df, "experience_group"),
        "source_summary": M.demand(df, "source"),
        "ml_dataset": ml_v2(df),
        "rag_documents": documents_v2(df),
        "gold_quality_summary": reports.gold_quality_v2(df),
    }


def marts_v3(df: DataFrame, band=D.SALARY_BAND) -> dict[str, DataFrame]:
    return {
        "skill_demand": M.skill_demand(df),
        "role_demand": M.demand(df, "role_category"),
        "company_demand": M.demand(df, "company"),
        "location_demand": M.demand(df, "location"),
        "experience_demand": M.demand(df, "experience_bucket"),
        "salary_insights": M.salary_insights(df),
        "source_quality": M.source_quality(df, *band),
        "ml_job_role_dataset": ml_role(df),
        "ml_salary_dataset": ml_salary(df),
        "rag_documents": documents_v3(df),
        "gold_quality_report": reports.gold_quality_v3(df, *band),
    }


def bi_tables(df: DataFrame, band=D.SALARY_BAND) -> dict[str, DataFrame]:
    """The eleven tables of the BI export."""
    count_desc = F.col("job_count").desc()
    return {
        "kpi_summary": reports.kpi(df),
        "job_overview": T.available(df, S.OVERVIEW_COLUMNS, ("salary_avg", "skill_count"), ("skill_count",)),
        "skill_demand": M.share(M.skill_demand(df), df).orderBy(count_desc, "skill"),
        "role_demand": M.share(M.demand(df, "role_category"), df).orderBy(count_desc, "role_category"),
        "top_companies": M.top(M.demand(df, "company"), 100, "company"),
        "top_locations": M.top(M.demand(df, "location"), 100, "location"),
        "source_role_matrix": M.source_role(df).orderBy(count_desc, "source", "role_category"),
        "role_skill_matrix": M.sorted_role_skill(M.role_skill(df)),
        "salary_insights": M.salary_insights(df),
        "source_quality": M.source_quality(df, *band),
        "experience_demand": M.share(M.demand(df, "experience_bucket"), df),
    }
