"""Prompt screening: blank, injection regex and similarity, in that order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacancia import dictionaries as D
from vacancia.functions import text as X
from vacancia.operators.nearest import top_vectors


def reason_blank(prompt) -> Column:
    return F.when(X.strip(X.blank(prompt)) == "", D.REASON_BLANK)


def reason_regex(prompt, regex: str = D.INJECTION_REGEX) -> Column:
    return F.when(X.col(prompt).rlike(f"(?i){regex}"), D.REASON_REGEX)


def reason_similarity(score, threshold: float = D.SIMILARITY_THRESHOLD) -> Column:
    before, after = D.REASON_SIMILAR.split("{score}")
    text = F.concat(F.lit(before), F.format_string("%.2f", X.col(score)), F.lit(after))
    return F.when(X.col(score) >= threshold, text)


def nearest_pattern(
    prompts: DataFrame, patterns: DataFrame, prompt_id: str, vector: str
) -> DataFrame:
    """(prompt_id, max_similarity) against a table of unit pattern vectors of any size."""
    best = top_vectors(prompts, patterns, prompt_id, "pattern_id", vector, k=1)
    return best.select(F.col("q_id").alias(prompt_id), F.col("score").alias("max_similarity"))


def verdict(
    prompts: DataFrame, prompt: str, similarity: str | None = None,
    regex: str = D.INJECTION_REGEX, threshold: float = D.SIMILARITY_THRESHOLD,
) -> DataFrame:
    """Adds is_safe and reason; the first test that hits gives the reason.

    ``prompt`` may be the bare question or a whole assembled prompt. Rows without a
    similarity score skip that test.
    """
    reasons = [reason_blank(prompt), reason_regex(prompt, regex)]
    if similarity:
        reasons.append(reason_similarity(similarity, threshold))
    reason = F.coalesce(*reasons)
    return prompts.withColumns(
        {"is_safe": reason.isNull(), "reason": F.coalesce(reason, F.lit(""))}
    )
