"""Demand marts, salary and source summaries.

Every aggregate combines map-side, so hot companies or skills ship one partial
row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.functions import enrich as E, text as X
from vacancia.operators.reshape import explode_items
from vacancia.operators.standardise import salary_band


def demand(df: DataFrame, *keys: str, name: str = "job_count") -> DataFrame:
    """Rows per key; NULL keys are left out."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def demand_by_each(df: DataFrame, keys, name: str = "job_count") -> DataFrame:
    """Several one-key marts as (mart, item, count) from one pass and one shuffle."""
    pairs = F.array(*[F.struct(F.lit(k).alias("mart"), F.col(k).alias("item")) for k in keys])
    rows = df.select(F.explode(pairs).alias("p")).select("p.*")
    return rows.filter(F.col("item").isNotNull()).groupBy("mart", "item").agg(
        F.count(F.lit(1)).alias(name)
    )


def row_total(df: DataFrame):
    """Row count as a scalar subquery."""
    return df.select(F.count(F.lit(1))).scalar()


def share(mart: DataFrame, jobs: DataFrame, count="job_count") -> DataFrame:
    """Percent of all jobs; skill shares may add up to more than 100."""
    return mart.withColumn("demand_percent", X.percent(count, row_total(jobs)))


def source_share(df: DataFrame) -> DataFrame:
    """Jobs per source with the percent of all rows that have a source."""
    known = df.na.drop(subset=["source"])
    counts = demand(known, "source")
    return counts.withColumn("job_percent", X.percent("job_count", row_total(known)))


def skill_rows(df: DataFrame, keep=("job_id", "role_category", "source")) -> DataFrame:
    return explode_items(df, keep, "extracted_skills", "skill")


def raw_skill_demand(df: DataFrame) -> DataFrame:
    """Demand of raw split skills."""
    return demand(explode_items(df, [], E.skills_split("skills"), "skill"), "skill", name="demand_count")


def skill_demand(df: DataFrame) -> DataFrame:
    return demand(skill_rows(df, ()), "skill")


def role_skill(df: DataFrame) -> DataFrame:
    return demand(skill_rows(df, ("role_category",)), "role_category", "skill")


def sorted_role_skill(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("role_category").asc(), F.col("job_count").desc(), "skill")


def source_role(df: DataFrame) -> DataFrame:
    return share(demand(df, "source", "role_category"), df)


def salary_insights(df: DataFrame) -> DataFrame:
    """Salary summary per role over the valid band."""
    return (
        salary_band(df).na.drop(subset=["role_category"]).groupBy("role_category").agg(
            F.count("job_title").alias("job_count"),
            F.avg("salary_avg").alias("avg_salary"),
            F.min("salary_min").alias("min_salary"),
            F.max("salary_max").alias("max_salary"),
        )
    )


def source_quality(df: DataFrame, low: float, high: float) -> DataFrame:
    """Seven quality measures per source in one pass."""
    valid = F.count_if(F.col("salary_avg").between(low, high))
    return (
        df.na.drop(subset=["source"]).groupBy("source").agg(
            F.count("job_title").alias("total_jobs"),
            F.countDistinct("company").alias("unique_companies"),
            F.countDistinct("location").alias("unique_locations"),
            F.count("salary_avg").alias("salary_available_raw"),
            X.rounded(F.avg("skill_count")).alias("avg_skill_count"),
            valid.alias("valid_salary_records"),
        )
        .withColumn(
            "valid_salary_availability_pct", X.percent("valid_salary_records", "total_jobs")
        )
    )


def top(mart: DataFrame, n: int, key: str, count="job_count") -> DataFrame:
    """The n largest rows; ties go by key."""
    return mart.orderBy(F.col(count).desc(), F.col(key).asc()).limit(n)


def salary_ranges(df: DataFrame, category="role_category") -> DataFrame:
    """Range rows with a midpoint: the average if there is one, else the mean of the ends."""
    mid = F.col("avg_salary") if "avg_salary" in df.columns else (
        (F.col("min_salary") + F.col("max_salary")) / 2
    )
    wanted = [category, "min_salary", "max_salary"]
    wanted += ["avg_salary"] if "avg_salary" in df.columns else []
    return df.select(*wanted).na.drop().withColumn("mid_salary", mid).orderBy("mid_salary", category)
