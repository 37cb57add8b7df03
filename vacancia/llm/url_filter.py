"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes.

A rule is a host and a path prefix. Every URL is expanded into the expressions that some
rule could equal: host suffixes and path prefixes of the shapes the rules have. They are
equi-joined on four digest bytes, the full digest confirms, the longest rule wins.

Null urls and urls without ``://`` have an empty host and path and fit no rule with a
host. Among equal rules "block" wins. Rows are judged by (host, path), so repeated rows and
ids, null ids and further columns do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import UPPER

PREFIX_HEX = 8  # four bytes


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hashed(df: DataFrame, expression: str) -> DataFrame:
    digest = F.sha2(F.col(expression), 256)
    return df.withColumn("digest", digest).withColumn("short", F.substring(digest, 1, PREFIX_HEX))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` columns ``host, path, rule, verdict`` beside the ones kept by the caller.

    ``rules``: host, path, verdict. The rules' shapes (labels of the host, characters of
    the path) go to the driver; there are at most as many as label counts times path
    lengths. The rule side of the join is broadcast only if the planner knows it is small;
    a larger one is shuffled, where adaptive skew handling splits hot rules.
    """
    rules = rules.select(
        F.translate("host", UPPER, UPPER.lower()).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path"),
        F.col("verdict").alias("r_verdict")).filter("r_host <> '' AND r_verdict IS NOT NULL")
    shapes = rules.select(
        F.size(F.split("r_host", r"\.")).alias("labels"), F.length("r_path").alias("chars")).distinct().collect()
    parts = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    if not shapes:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    shape_list = F.array(*(
        F.struct(F.lit(s.labels).alias("labels"), F.lit(s.chars).alias("chars")) for s in sorted(shapes)))
    # One row per distinct host and path, combined before the shuffle: a hot page moves once.
    expanded = (
        parts.select("host", "path").filter("host <> ''").distinct()
        .withColumn("shape", F.explode(shape_list))
        .filter("length(path) >= shape.chars")
        .withColumn("expression", F.expr(
            "concat(substring_index(host, '.', -shape.labels), left(path, shape.chars))"))
        .select("host", "path", "expression"))
    signed = _hashed(rules.select(F.concat("r_host", "r_path").alias("rule"), "r_verdict"), "rule")
    confirmed = (
        _hashed(expanded, "expression")
        .join(signed.withColumnRenamed("digest", "r_digest"), "short")
        .filter("digest = r_digest"))
    best = (
        confirmed.groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "r_verdict", "rule")).alias("best"))
        .select(F.col("host").alias("j_host"), F.col("path").alias("j_path"), "best"))
    return (
        parts.join(best, (F.col("host") == F.col("j_host")) & (F.col("path") == F.col("j_path")), "left")
        .withColumn("rule", F.col("best.rule"))
        .withColumn("verdict", F.coalesce("best.r_verdict", F.lit(default)))
        .drop("best", "j_host", "j_path"))
