"""Column lists, header synonyms and typed schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Header synonyms and required columns of the cross-source master.
MASTER_SYNONYMS = {
    "companyName": "company",
    "company_name": "company",
    "job_title": "title",
    "jobRole": "title",
    "job_location": "location",
    "locations": "location",
    "job_description": "description",
    "jd": "description",
    "scrape_time": "scraped_at",
}
MASTER_COLUMNS = [
    "job_id", "title", "company", "location", "experience", "salary",
    "skills", "description", "posted_date", "searched_role", "source", "scraped_at",
]

# Header synonyms and required columns of the silver table.
# apply_url is added to the known synonyms so that portal's link is kept.
SILVER_SYNONYMS = {
    "title": "job_title",
    "jobtitle": "job_title",
    "job_title": "job_title",
    "companyname": "company",
    "company": "company",
    "locations": "location",
    "location": "location",
    "skills": "skills",
    "description": "description",
    "jobdescription": "description",
    "jd": "description",
    "exp": "experience",
    "experience": "experience",
    "salary": "salary",
    "createdat": "posted_date",
    "posted_date": "posted_date",
    "jdurl": "job_url",
    "redirecturl": "job_url",
    "url": "job_url",
    "apply_url": "job_url",
}
SILVER_COLUMNS = [
    "job_title", "company", "location", "experience", "salary",
    "skills", "description", "job_url", "posted_date",
]

# Columns of the gold fact tables.
GOLD_REQUIRED = [
    "job_title", "company", "location", "experience", "salary", "skills",
    "description", "source", "job_url", "posted_date", "job_id",
]
FACT_V2 = [
    "job_id", "job_title", "company", "location", "experience", "salary", "source",
    "posted_date", "job_url", "role_category", "experience_group",
    "extracted_skills", "gold_processed_at",
]
FACT_V3 = [
    "job_title", "company", "location", "experience", "salary", "skills",
    "description", "job_url", "posted_date", "source", "job_id", "role_category",
    "experience_bucket", "extracted_skills", "skill_count",
    "salary_min", "salary_max", "salary_avg", "gold_processed_at",
]
OVERVIEW_COLUMNS = [
    "job_id", "job_title", "company", "location", "experience", "salary", "source",
    "role_category", "experience_bucket", "skill_count",
    "salary_min", "salary_max", "salary_avg", "posted_date",
]


def strings(names) -> T.StructType:
    """All-text schema: what a raw file is read with before any typing."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


SILVER_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in [*SILVER_COLUMNS, "source", "job_id"]]
    + [T.StructField("processed_at", T.TimestampType())]
)
