"""Text contexts handed to an answer model, one row per question or profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions import text as X
from vacancia.operators.demand import demand, row_total, skill_demand, top

METADATA = ["title", "company", "location", "skills", "source"]


def metadata(df: DataFrame, title="job_title") -> DataFrame:
    """Document id, text and metadata with missing values as empty text."""
    columns = {c: (F.col(title) if c == "title" and title in df.columns else
                   F.col(c) if c in df.columns else F.lit("")) for c in METADATA}
    return df.select(
        "job_id", *[X.blank(v).alias(c) for c, v in columns.items()], "document_text"
    )


# The labels of the prompt.
def question_prompt(found: Column, question: Column) -> Column:
    return F.concat(F.lit("\nJOB MARKET CONTEXT:\n"), found, F.lit("\n\nUSER QUESTION:\n"), X.blank(question), F.lit("\n"))


def retrieval_context(ranked: DataFrame, question_id: str, question: str) -> DataFrame:
    """Prompt text per question from its ranked documents.

    ``ranked`` has one row per (question, rank) with the metadata and
    ``document_text``; k bounds the list collected per question.
    """
    block = F.concat(
        F.lit("\nJob "), F.col("rank").cast("string"),
        F.lit("\nTitle: "), X.blank("title"), F.lit("\nCompany: "), X.blank("company"),
        F.lit("\nLocation: "), X.blank("location"), F.lit("\nSkills: "), X.blank("skills"),
        F.lit("\nDescription:\n"), X.blank("document_text"), F.lit("\n"),
    )
    blocks = F.sort_array(F.collect_list(F.struct("rank", block.alias("block"))))
    return ranked.groupBy(question_id, question).agg(
        F.array_join(F.transform(blocks, lambda b: b["block"]), "").alias("context")
    ).withColumn("prompt", question_prompt(F.col("context"), F.col(question)))


def _numbered(mart: DataFrame, key: str, heading: str, n: int) -> Column:
    """Heading and the n largest rows of a mart as text lines (scalar subquery)."""
    lines = F.sort_array(F.collect_list(F.struct((-F.col("job_count")).alias("r"), F.col(key))))
    body = F.transform(
        lines, lambda x: F.concat(F.lit("- "), x[key], F.lit(": "), (-x["r"]).cast("string"),
                                  F.lit(" jobs"))
    )
    listed = top(mart, n, key).agg(body.alias("lines")).select(
        F.when(F.size("lines") > 0, F.array_join(F.concat(F.array(F.lit(heading)), "lines"), "\n"))
    )
    return listed.scalar()


def market_context(jobs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Market summary text per profile.

    ``profiles`` has profile_id, role, role_market_jobs, match_score, the available
    and missing skill texts and the recommended-jobs text. The market part is the
    same for all and computed once, by scalar subqueries over top-n marts.
    """
    total = F.concat(F.lit("Total cleaned job records: "), row_total(jobs).cast("string"))
    market = [
        total,
        _numbered(demand(jobs, "role_category"), "role_category", "Role demand:", 7),
        _numbered(skill_demand(jobs), "skill", "Top market skills:", 10),
        _numbered(demand(jobs, "company"), "company", "Top hiring companies:", 10),
    ]

    def line(label, c, suffix=""):
        value = F.nullif(F.col(c).cast("string"), F.lit(""))
        return F.concat(F.lit(label), value, F.lit(suffix))

    personal = [
        line("Predicted best role for user: ", "role"),
        line("Market jobs analyzed for predicted role: ", "role_market_jobs"),
        line("Profile match: ", "match_score", "%"),
        line("Available skills: ", "available"),
        line("Missing skills: ", "missing"),
        line("Recommended jobs:\n", "recommended"),
    ]
    return profiles.select("profile_id", F.concat_ws("\n", *market, *personal).alias("context"))


def market_prompt(contexts: DataFrame, question: str) -> DataFrame:
    """Adds the assembled prompt; screening may run over it instead of the bare question."""
    return contexts.withColumn("prompt", F.concat(
        F.lit("\nJob Market Context:\n"), F.col("context"),
        F.lit("\n\nUser Question:\n"), X.blank(question), F.lit("\n")))


def history(turns: DataFrame) -> DataFrame:
    """Chat turns in order. A range sort, so a very long conversation still splits."""
    return turns.select("conv_id", "turn", "role", F.col("text").alias("content")).orderBy(
        "conv_id", "turn", "role", "content"
    )
