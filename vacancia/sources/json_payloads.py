"""Portal payloads (JSON text column) to flat posting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions import text as X


# Fields are read as text: a list or object in a text field keeps its JSON fragment.
_YEARS, _AMOUNT = "struct<years:string>", "struct<absoluteValue:string>"
FOUNDIT_ITEM = (
    "jobId string, title string, companyName string, locations string, "
    f"minimumExperience {_YEARS}, maximumExperience {_YEARS}, salary string, "
    f"minimumSalary {_AMOUNT}, maximumSalary {_AMOUNT}, skills string, description string, "
    "postedDate string, updatedAt string, employmentTypes string, industries string, "
    "redirectUrl string"
)
SHINE_ITEM = (
    "id string, jJT string, jCName string, jLoc string, jExp string, jSal string, jKwd string, "
    "jJD string, jPDate string, jInd string"
)
REMOTEOK_ITEM = (
    "id string, position string, company string, location string, salary_min string, "
    "salary_max string, tags array<string>, description string, date string"
)


def _text(path: str) -> Column:
    return X.coerce_text(f"item.{path}")


def _items(payloads: DataFrame, payload: str, schema: str, path: list[str], item: str):
    """One row per list element that is an object, parsed once into ``item``.

    Parsed inside the list, so that a filter on the item does not parse it again.
    """
    elements = F.from_json(payload, schema)
    for part in path:
        elements = elements.getField(part)
    objects = F.transform(elements, lambda x: F.when(x.startswith("{"), F.from_json(x, item)))
    others = [c for c in payloads.columns if c != payload]
    rows = payloads.select(*others, F.posexplode_outer(objects).alias("_pos", "item"))
    return others, rows.filter(F.col("item").isNotNull())


def valid_items(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Elements of ``jobSearchResponse.data`` that are objects with a non-empty title."""
    others, items = _items(
        payloads, payload, "jobSearchResponse struct<data:array<string>>",
        ["jobSearchResponse", "data"], FOUNDIT_ITEM,
    )
    return items.select(*others, "item").filter(F.coalesce("item.title", F.lit("")) != "")


def foundit_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """``jobSearchResponse.data[]`` with nested experience and salary."""
    others = [c for c in payloads.columns if c != payload]
    low, high = F.col("item.minimumExperience.years"), F.col("item.maximumExperience.years")
    return valid_items(payloads, payload).select(
        *others,
        F.col("item.jobId").alias("job_id"),
        _text("title").alias("title"),
        _text("companyName").alias("company"),
        _text("locations").alias("location"),
        # An absent bound prints as the word None, as the portal files have it.
        F.concat(F.coalesce(low, F.lit("None")), F.lit(" - "), F.coalesce(high, F.lit("None")))
        .alias("experience"),
        low.try_cast("double").alias("min_exp"),
        high.try_cast("double").alias("max_exp"),
        _text("salary").alias("salary"),
        F.col("item.minimumSalary.absoluteValue").try_cast("double").alias("min_salary"),
        F.col("item.maximumSalary.absoluteValue").try_cast("double").alias("max_salary"),
        _text("skills").alias("skills"),
        _text("description").alias("description"),
        _text("postedDate").alias("posted_date"),
        _text("updatedAt").alias("updated_at"),
        _text("employmentTypes").alias("employment_type"),
        _text("industries").alias("industry"),
        _text("redirectUrl").alias("apply_url"),
        F.lit("foundit").alias("source"),
    )


def shine_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """``results[]`` with short field names and an HTML description."""
    others, items = _items(payloads, payload, "results array<string>", ["results"], SHINE_ITEM)
    return items.select(
        *others,
        F.col("item.id").alias("job_id"),
        _text("jJT").alias("title"),
        _text("jCName").alias("company"),
        _text("jLoc").alias("location"),
        _text("jExp").alias("experience"),
        _text("jSal").alias("salary"),
        _text("jKwd").alias("skills"),
        X.html_text(F.nullif(F.col("item.jJD"), F.lit(""))).alias("description"),
        _text("jPDate").alias("posted_date"),
        _text("jInd").alias("industry"),
        F.lit("shine").alias("source"),
    )


def remoteok_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """A bare array whose first element is metadata; tags join with commas."""
    others, items = _items(payloads, payload, "array<string>", [], REMOTEOK_ITEM)
    return items.filter("_pos > 0").select(
        *others,
        F.col("item.id").alias("job_id"),
        F.col("item.position").alias("title"),
        F.col("item.company").alias("company"),
        F.col("item.location").alias("location"),
        F.col("item.salary_min").try_cast("double").alias("salary_min"),
        F.col("item.salary_max").try_cast("double").alias("salary_max"),
        F.coalesce(F.array_join("item.tags", ","), F.lit("")).alias("skills"),
        F.col("item.description").alias("description"),
        F.col("item.date").alias("posted_date"),
        F.lit("remoteok").alias("source"),
    )
