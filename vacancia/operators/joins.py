"""Joins that are not already part of another operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.dictionaries import SEARCHED_ROLES
from vacancia.functions import enrich as E, text as X
from vacancia.operators.reshape import explode_items
from vacancia.session import materialize


def match_roles(df: DataFrame, dictionary=SEARCHED_ROLES, fields=None) -> DataFrame:
    """One row per (posting, searched role) whose phrase occurs in the posting.

    ``dictionary`` is category -> phrases; it is configuration, so the contains
    join runs as a projection and an explode, without a join or a shuffle.
    """
    fields = fields or ["title", "company", "location", "skills", "description"]
    hits = explode_items(df, df.columns, E.matched_terms(X.joined(*fields), dictionary), "_at")
    return hits.withColumn("_term", E.term_at("_at", dictionary)).select(*df.columns, "_term.*")


def match_phrases(df: DataFrame, phrases: DataFrame, phrase: str, fields: list[str], size: int = 5) -> DataFrame:
    """One row per (row of ``df``, row of ``phrases``) whose phrase occurs in the lowered fields.

    For dictionaries too large for a projection. Every phrase is looked up by one piece of
    itself, ``size`` characters long (or all of a shorter one): the piece that the fewest rows
    have. Pieces of rows meet these in an equi-join, and the phrase itself confirms. Phrases
    are compared as they are; null and empty ones match nothing.
    """
    rows = materialize(df.select(F.lower(X.joined(*fields)).alias("_text"), F.struct(*df.columns).alias("_left")).withColumn(
        "_row", F.monotonically_increasing_id()), "phrase-rows")
    terms = materialize(phrases.filter(F.length(phrase) > 0).select(
        F.col(phrase).alias("_phrase"), F.struct(*phrases.columns).alias("_right")).withColumn(
        "_term", F.monotonically_increasing_id()), "phrase-terms")
    width = F.least(F.length("_phrase"), F.lit(size))
    sizes = [r[0] for r in terms.select(width).distinct().collect()]  # at most ``size`` numbers

    def pieces(text, length: int):
        starts = F.sequence(F.lit(1), F.length(text) - (length - 1))
        cut = F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(length))))
        return F.when(F.length(text) >= length, cut).otherwise(F.array().cast("array<string>"))

    def cut_up(frame, key, lengths):
        return frame.select(key, F.explode(F.concat(*[lengths(n) for n in sizes])).alias("_piece"))

    if not sizes:
        return rows.withColumn("_term", F.col("_row")).join(terms, "_term").filter(F.lit(False)).select("_left.*", "_right.*")
    of_rows = materialize(cut_up(rows, "_row", lambda n: pieces(F.col("_text"), n)), "phrase-pieces")
    of_terms = cut_up(terms, "_term", lambda n: F.when(width == n, pieces(F.col("_phrase"), n)).otherwise(
        F.array().cast("array<string>")))
    known = of_rows.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    # A phrase with a piece that no row has is in none: it has no anchor.
    anchors = of_terms.join(known, "_piece", "left").groupBy("_term").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_piece")).alias("a")).filter("a.n > 0").select(
        "_term", F.col("a._piece").alias("_piece"))
    found = of_rows.join(anchors, "_piece").select("_row", "_term")
    return found.join(rows, "_row").join(terms, "_term").filter(F.contains(F.col("_text"), F.col("_phrase"))).select(
        "_left.*", "_right.*")


def attach_metrics(rows: DataFrame, metrics: DataFrame) -> DataFrame:
    """The columns of a one-row frame on every row, by scalar subquery."""
    one = metrics.select(F.struct(*metrics.columns).alias("m")).scalar()
    return rows.select("*", *[one.getField(c).alias(c) for c in metrics.columns])


def report_left(report: DataFrame, counts: DataFrame, key: str, column: str) -> DataFrame:
    """Report rows with a count column; keys without a count get zero."""
    return report.join(counts, key, "left").withColumn(
        column, F.coalesce(F.col(column), F.lit(0)).cast("bigint")
    )
