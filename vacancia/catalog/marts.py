"""Joins, aggregations, reports and top-k queries over the gold frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancia import dictionaries as D
from vacancia.catalog import cleaning as C, fixtures as X
from vacancia.catalog.registry import query
from vacancia.functions import text as T
from vacancia.operators import dedup, demand as M, gap, joins, reports, standardise as N
from vacancia.session import materialize
from vacancia.plans import gold as G

TOTAL = "(SELECT count(*) FROM gold)"


def counts(key: str, name: str = "job_count", frame: str = "gold") -> str:
    return (f"SELECT {key}, cast(count(*) AS bigint) AS {name} FROM {frame} "
            f"WHERE {key} IS NOT NULL GROUP BY {key}")


SKILL_COUNTS = counts("skill", frame="(SELECT unnest(extracted_skills) AS skill FROM gold)")

# --- joins ---------------------------------------------------------------------


@query("join_enrich_left", f"""WITH {C._KEYED}
SELECT keyed.*, source_count, sources_available FROM keyed LEFT JOIN sets USING (dedup_key)""")
def join_enrich_left(spark, sf):
    return dedup.with_source_sets(materialize(C.keyed(spark, sf), "keyed"))  # both sides of the join


@query("join_report_left", f"""WITH {X.GOLD}
SELECT g.company, cast(count(*) AS bigint) AS job_count, cast(coalesce(max(v.n), 0) AS bigint) AS valid_salary_records
FROM gold g LEFT JOIN (SELECT company, count(*) AS n FROM gold WHERE salary_avg BETWEEN 1000000 AND 10000000
  GROUP BY company) v USING (company) GROUP BY g.company""")
def join_report_left(spark, sf):
    gold = materialize(X.gold(spark, sf).select("company", "salary_avg"), "companies")  # both sides of the join
    valid = M.demand(N.salary_band(gold, 1e6, 1e7), "company", name="valid_salary_records")
    return joins.report_left(M.demand(gold, "company"), valid, "company", "valid_salary_records")


_SILVER_METRICS = f"""{X.SILVER}, metrics AS (
  SELECT (SELECT count(*) FROM postings) AS total_raw_rows, (SELECT count(*) FROM clean) AS rows_after_null_removal,
         (SELECT count(*) FROM postings) - (SELECT count(*) FROM clean) AS null_rows_removed,
         (SELECT count(*) FROM clean) - (SELECT count(*) FROM silver) AS duplicates_removed,
         (SELECT count(*) FROM silver) AS final_silver_rows)"""


@query("join_attach_metrics", f"""WITH {_SILVER_METRICS}, per_source AS (
  SELECT source, cast(count(*) AS bigint) AS rows_loaded FROM postings GROUP BY source)
SELECT per_source.*, metrics.* FROM per_source CROSS JOIN metrics""")
def join_attach_metrics(spark, sf):
    raw = X.raw_silver(spark, sf)
    return joins.attach_metrics(reports.rows_per_source(raw), reports.silver_metrics(raw))


@query("join_gap_status", f"""WITH {X.GOLD}, {X.PROFILES}, {X.ranked_skills(15)}, owned AS (
  SELECT *, list_filter(regexp_split_to_array(lower(profile_text), '(?:,|\\||{X.SPACE})+'), lambda t: t <> '') AS owned_skills
  FROM profiles)
SELECT profile_id, role_category AS market_role, skill, job_count, demand_percent,
       CASE WHEN list_contains(owned_skills, skill) THEN 'Available' ELSE 'Missing' END AS status
FROM owned JOIN ranked ON lower(role_category) = lower(target_role)""")
def join_gap_status(spark, sf):
    return gap_rows(spark, sf, 15, "ignore_case", "exact").filter("skill IS NOT NULL").select(
        "profile_id", "market_role", "skill", "job_count", "demand_percent", "status")


def gap_rows(spark, sf, n, role_mode, skill_mode, gold=None):
    from vacancia.functions import enrich as E

    gold = X.gold(spark, sf) if gold is None else gold
    # The dashboard also owns skills named by a phrase with any blanks between its words.
    hits = E.phrase_hits("profile_text", X.SKILLS) if skill_mode == "either" else None
    asked = X.profiles(spark, sf).withColumn("owned_skills", gap.profile_skills("profile_text", hits))
    ranked = gap.ranked_role_skills(gold, n, whole_market=role_mode == "fallback")
    return gap.gap_rows(gap.match_role(asked, gold, role_mode), ranked, skill_mode)


# --- demand marts -----------------------------------------------------------------


def _tall(*selects):
    return " UNION ALL ".join(selects)


@query("agg_demand_v1", f"WITH {X.SILVER} " + _tall(*[
    f"SELECT '{k}' AS mart, {k} AS item, cast(count(*) AS bigint) AS job_count FROM silver WHERE {k} IS NOT NULL GROUP BY {k}"
    for k in ("company", "location", "job_title", "experience")]))
def agg_demand_v1(spark, sf):
    return M.demand_by_each(X.silver(spark, sf), ("company", "location", "job_title", "experience"))


_KEYS = ("role_category", "company", "location", "experience_bucket", "source")


@query("agg_demand", f"WITH {X.GOLD} " + _tall(*[
    f"SELECT '{k}' AS mart, {k} AS item, cast(count(*) AS bigint) AS job_count FROM gold WHERE {k} IS NOT NULL GROUP BY {k}"
    for k in _KEYS]))
def agg_demand(spark, sf):
    return M.demand_by_each(X.gold(spark, sf), _KEYS)


@query("agg_demand_v2", f"WITH {X.GOLD_V2} {counts('experience_group')}")
def agg_demand_v2(spark, sf):
    return M.demand(X.gold_v2(spark, sf), "experience_group")


@query("agg_skill_raw", f"""WITH {X.SILVER}
SELECT skill, cast(count(*) AS bigint) AS demand_count FROM (SELECT unnest({C._SPLIT}) AS skill FROM silver) GROUP BY skill""")
def agg_skill_raw(spark, sf):
    return M.raw_skill_demand(X.silver(spark, sf))


@query("agg_skill_rows", f"WITH {X.GOLD} SELECT job_id, role_category, source, unnest(extracted_skills) AS skill FROM gold")
def agg_skill_rows(spark, sf):
    return M.skill_rows(X.gold(spark, sf))


@query("agg_skill_rows_v2", f"WITH {X.GOLD_V2} SELECT job_id, role_category, source, unnest(extracted_skills) AS skill FROM gold")
def agg_skill_rows_v2(spark, sf):
    return M.skill_rows(X.gold_v2(spark, sf))


@query("agg_skill_demand", f"WITH {X.GOLD} {SKILL_COUNTS}")
def agg_skill_demand(spark, sf):
    return M.skill_demand(X.gold(spark, sf))


@query("agg_source_sets", f"WITH {C._KEYED} SELECT * FROM sets")
def agg_source_sets(spark, sf):
    return dedup.source_sets(C.keyed(spark, sf))


_INSIGHTS_SELECT = f"role_category, job_count, {X.s_round('avg_salary', 4)} AS avg_salary, min_salary, max_salary"


@query("agg_salary_insights", f"WITH {X.GOLD}, {C.SALARY_INSIGHTS} SELECT {_INSIGHTS_SELECT} FROM insights")
def agg_salary_insights(spark, sf):
    return M.salary_insights(X.gold(spark, sf)).withColumn("avg_salary", T.rounded("avg_salary", 4))


@query("agg_source_quality", f"WITH {X.GOLD}, {C.SOURCE_QUALITY} SELECT * FROM quality")
def agg_source_quality(spark, sf):
    return M.source_quality(X.gold(spark, sf), *D.SALARY_BAND)


@query("agg_share", f"WITH {X.GOLD} " + _tall(*[
    f"SELECT '{k}' AS mart, {k} AS item, job_count, {X.s_round(f'job_count / {TOTAL} * 100')} AS demand_percent FROM ({sql})"
    for k, sql in (("skill", SKILL_COUNTS), ("role_category", counts("role_category")),
                   ("experience_bucket", counts("experience_bucket")))]))
def agg_share(spark, sf):
    gold = X.gold(spark, sf)
    marts = {"skill": M.skill_demand(gold), "role_category": M.demand(gold, "role_category"),
             "experience_bucket": M.demand(gold, "experience_bucket")}
    return N.union_all([
        M.share(mart, gold).select(F.lit(k).alias("mart"), F.col(k).alias("item"), "job_count", "demand_percent")
        for k, mart in marts.items()])


@query("agg_source_share", f"""WITH {X.POSTINGS}
SELECT source, cast(count(*) AS bigint) AS job_count, {X.s_round('count(*) / (SELECT count(source) FROM postings) * 100')} AS job_percent
FROM postings WHERE source IS NOT NULL GROUP BY source""")
def agg_source_share(spark, sf):
    return M.source_share(X.postings(spark, sf))


@query("agg_source_role", f"""WITH {X.GOLD}
SELECT source, role_category, cast(count(*) AS bigint) AS job_count, {X.s_round(f'count(*) / {TOTAL} * 100')} AS demand_percent
FROM gold GROUP BY source, role_category""")
def agg_source_role(spark, sf):
    return M.source_role(X.gold(spark, sf))


_ROLE_SKILL = """SELECT role_category, skill, cast(count(*) AS bigint) AS job_count
FROM (SELECT role_category, unnest(extracted_skills) AS skill FROM gold) GROUP BY ALL"""


@query("agg_role_skill", f"WITH {X.GOLD} {_ROLE_SKILL}")
def agg_role_skill(spark, sf):
    return M.role_skill(X.gold(spark, sf))


# --- reports ------------------------------------------------------------------------


def _metrics(frame: str, items, kind="bigint") -> str:
    return _tall(*[f"SELECT '{n}' AS metric, cast({e} AS {kind}) AS value FROM {frame}" for n, e in items])


@query("rep_kpi", f"WITH {X.GOLD} " + _metrics("gold", [
    ("Total Jobs", "count(*)"), ("Unique Companies", "count(DISTINCT company)"),
    ("Unique Locations", "count(DISTINCT location)"), ("Sources", "count(DISTINCT source)"),
    ("Role Categories", "count(DISTINCT role_category)"), ("Records for RAG", "count(*)"),
    ("ML Role Dataset Records", "count(*) FILTER (role_category <> 'Other')")])
    + " UNION ALL SELECT 'Skills Extracted', cast(count(DISTINCT skill) AS bigint) "
    "FROM (SELECT unnest(extracted_skills) AS skill FROM gold)")
def rep_kpi(spark, sf):
    return reports.kpi(X.gold(spark, sf))


@query("rep_gold_quality", f"WITH {X.GOLD} " + _metrics("gold", [
    ("total_gold_jobs", "count(*)"), ("unique_companies", "count(DISTINCT company)"),
    ("unique_locations", "count(DISTINCT location)"), ("unique_sources", "count(DISTINCT source)"),
    ("jobs_with_raw_salary", "count(salary_avg)"),
    ("jobs_with_valid_salary", "count(*) FILTER (salary_avg BETWEEN 50000 AND 10000000)"),
    ("jobs_without_valid_salary", "count(*) - count(*) FILTER (salary_avg BETWEEN 50000 AND 10000000)"),
    ("jobs_with_extracted_skills", "count(*) FILTER (skill_count > 0)"),
    ("avg_skills_per_job", X.s_round('avg(skill_count)')),
    ("ml_role_dataset_rows", "count(*) FILTER (role_category <> 'Other')"),
    ("ml_salary_dataset_rows", "count(*) FILTER (salary_avg BETWEEN 50000 AND 10000000)"),
    ("rag_documents", "count(*)")], "double"))
def rep_gold_quality(spark, sf):
    return reports.gold_quality_v3(X.gold(spark, sf), *D.SALARY_BAND)


@query("rep_gold_quality_v2", f"WITH {X.GOLD_V2} " + _metrics("gold", [
    ("silver_input_rows", "count(*)"), ("gold_fact_rows", "count(*)"),
    ("unique_companies", "count(DISTINCT company)"), ("unique_locations", "count(DISTINCT location)"),
    ("unique_roles", "count(DISTINCT role_category)"), ("skill_records", "sum(len(extracted_skills))"),
    ("rag_documents", "count(*)"), ("ml_dataset_rows", "count(*)")]))
def rep_gold_quality_v2(spark, sf):
    return reports.gold_quality_v2(X.gold_v2(spark, sf))


@query("rep_dedup", f"""WITH {C._KEYED}
SELECT 'total_raw_rows_loaded' AS metric, count(*) AS value FROM master
UNION ALL SELECT 'rows_after_title_company_filter', count(*) FROM keyed
UNION ALL SELECT 'final_clean_unique_rows', count(DISTINCT dedup_key) FROM keyed
UNION ALL SELECT 'duplicates_removed_cross_source', count(*) - count(DISTINCT dedup_key) FROM keyed
UNION ALL SELECT concat('rows_loaded:', source), count(*) FROM master GROUP BY source""")
def rep_dedup(spark, sf):
    counts = materialize(reports.rows_by_key(C.master(spark, sf)), "by-key")  # serves both reports
    per_source = reports.loaded_per_source(counts).select(
        F.concat(F.lit("rows_loaded:"), "source").alias("metric"), F.col("rows_loaded").alias("value"))
    return reports.dedup_summary(counts).unionByName(per_source)


@query("rep_profile", f"""WITH {X.POSTINGS}, cut AS (
  SELECT job_title, company, location, source, experience, salary FROM postings), base AS (
  SELECT count(*) AS n, 6 AS cols, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cut)) AS dup,
         {', '.join(f'count(*) FILTER ({c} IS NULL) AS n_{c}' for c in ('job_title', 'company', 'location', 'source', 'experience', 'salary'))}
  FROM cut)
""" + _tall("SELECT 'rows' AS metric, cast(n AS bigint) AS value FROM base",
            "SELECT 'columns', cols FROM base", "SELECT 'duplicate_rows', dup FROM base",
            *[f"SELECT 'nulls:{c}', n_{c} FROM base"
              for c in ("job_title", "company", "location", "source", "experience", "salary")]))
def rep_profile(spark, sf):
    return reports.profile(X.postings(spark, sf).select(
        "job_title", "company", "location", "source", "experience", "salary"))


@query("rep_profile_sample", f"""WITH {X.POSTINGS}
SELECT * FROM (SELECT job_title, company, location, source, experience, salary FROM postings)
ORDER BY job_title NULLS FIRST, company NULLS FIRST, location NULLS FIRST, source NULLS FIRST,
         experience NULLS FIRST, salary NULLS FIRST LIMIT 3""")
def rep_profile_sample(spark, sf):
    return reports.sample_rows(X.postings(spark, sf).select(
        "job_title", "company", "location", "source", "experience", "salary"))


@query("rep_class_dist", f"WITH {X.GOLD} SELECT role_category AS label, cast(count(*) AS bigint) AS n "
       "FROM gold WHERE role_category <> 'Other' GROUP BY role_category")
def rep_class_dist(spark, sf):
    return M.demand(G.ml_role(X.gold(spark, sf)), "role_category", name="n").withColumnRenamed(
        "role_category", "label")


# --- sorts and top-k -----------------------------------------------------------------


@query("top_demand", f"WITH {X.GOLD} "
       f"SELECT * FROM (SELECT 'company' AS mart, company AS item, job_count FROM ({counts('company')}) ORDER BY job_count DESC, company LIMIT 100) "
       f"UNION ALL SELECT * FROM (SELECT 'location', location, job_count FROM ({counts('location')}) ORDER BY job_count DESC, location LIMIT 15) "
       f"UNION ALL SELECT * FROM (SELECT 'skill', skill, job_count FROM ({SKILL_COUNTS}) ORDER BY job_count DESC, skill LIMIT 10)")
def top_demand(spark, sf):
    gold = X.gold(spark, sf)
    marts = [("company", M.demand(gold, "company"), 100), ("location", M.demand(gold, "location"), 15),
             ("skill", M.skill_demand(gold), 10)]
    return N.union_all([
        M.top(mart, n, k).select(F.lit(k).alias("mart"), F.col(k).alias("item"), "job_count")
        for k, mart, n in marts])


@query("top_skills_per_role", f"""WITH {X.GOLD}, {X.ranked_skills(15)}
SELECT role_category, cast(skill_rank AS integer) AS skill_rank, skill, job_count, demand_percent
FROM ranked WHERE role_category <> '*'""")
def top_skills_per_role(spark, sf):
    return gap.ranked_role_skills(X.gold(spark, sf), 15)


@query("srt_multi", f"WITH {X.GOLD}, m AS ({_ROLE_SKILL}) SELECT * FROM m ORDER BY role_category, job_count DESC, skill")
def srt_multi(spark, sf):
    return M.sorted_role_skill(M.role_skill(X.gold(spark, sf)))


@query("top_learning_path", f"""WITH {X.GOLD}, {X.PROFILES}, {X.ranked_skills(15)}, owned AS (
  SELECT *, list_filter(regexp_split_to_array(lower(profile_text), '(?:,|\\||{X.SPACE})+'), lambda t: t <> '') AS owned_skills
  FROM profiles), statuses AS (
  SELECT profile_id, role_category AS market_role, skill, skill_rank, list_contains(owned_skills, skill) AS have
  FROM owned JOIN ranked ON lower(role_category) = lower(target_role)), missing AS (
  SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY skill_rank) AS rn FROM statuses WHERE NOT have)
SELECT s.profile_id, s.market_role, coalesce(string_agg(m.skill, ', ' ORDER BY m.rn), '') AS learning_path
FROM (SELECT DISTINCT profile_id, market_role FROM statuses) s
LEFT JOIN missing m ON m.profile_id = s.profile_id AND m.rn <= 5 GROUP BY ALL""")
def top_learning_path(spark, sf):
    return gap.learning_path(gap_rows(spark, sf, 15, "ignore_case", "exact"), 5)


def _phrases() -> str:
    """SQL: is ``skill`` a whole phrase of the profile, whatever blanks are inside it?"""
    tests = ", ".join(
        f"CASE WHEN regexp_matches(lower(profile_text), '(^|[^a-z0-9_])' || replace('{k}', ' ', '\\s+') || '($|[^a-z0-9_])')"
        f" THEN '{k}' END" for k in X.SKILLS)
    return f"coalesce(list_contains([{tests}], skill), false)"


@query("top_gap_one", f"""WITH {X.GOLD}, {X.PROFILES}, {X.ranked_skills(20)}, statuses AS (
  SELECT profile_id, r.role_category AS market_role, skill, job_count,
         list_contains(list_filter(regexp_split_to_array(lower(profile_text), '(?:,|\\||{X.SPACE})+'), lambda t: t <> ''), skill)
           OR contains(lower(profile_text), skill) OR {_phrases()} AS have
  FROM profiles JOIN ranked r ON r.role_category = CASE WHEN target_role IN (SELECT role_category FROM role_market)
       THEN target_role ELSE '*' END)
SELECT profile_id, market_role, arg_min(skill, (-job_count, skill)) FILTER (NOT have) AS largest_gap
FROM statuses GROUP BY ALL""")
def top_gap_one(spark, sf):
    return gap.largest_gap(gap_rows(spark, sf, 20, "fallback", "either"))


# --- gap scores -----------------------------------------------------------------------

_OWNED = (f"list_filter(regexp_split_to_array(lower(profile_text), '(?:,|\\||{X.SPACE})+'), lambda t: t <> '')")


def _gap_sql(n, weight, role_join, have):
    w = "1" if weight == "unit" else weight
    return f"""WITH {X.GOLD}, {X.PROFILES}, {X.ranked_skills(n)}, statuses AS (
  SELECT profile_id, r.role_category AS market_role, skill, job_count, demand_percent, {have} AS have
  FROM profiles JOIN ranked r ON {role_join})
SELECT profile_id, market_role,
       {X.s_round(f'coalesce(sum({w}) FILTER (have), 0) / sum({w}) * 100')} AS match_score,
       cast(count(*) FILTER (have) AS bigint) AS available_skills,
       cast(count(*) FILTER (NOT have) AS bigint) AS missing_skills
FROM statuses GROUP BY ALL"""


_EXACT = "r.role_category = target_role"
_NOCASE = "lower(r.role_category) = lower(target_role)"
_FALLBACK = ("r.role_category = CASE WHEN target_role IN (SELECT role_category FROM role_market) "
             "THEN target_role ELSE '*' END")
_IN_LIST = f"list_contains({_OWNED}, skill)"
_IN_TEXT = "contains(lower(profile_text), skill)"


@query("gap_weighted_pct", _gap_sql(15, "demand_percent", _NOCASE, _IN_LIST))
def gap_weighted_pct(spark, sf):
    return gap.gap_scores(gap_rows(spark, sf, 15, "ignore_case", "exact"), "demand_percent")


@query("gap_count", _gap_sql(15, "unit", _EXACT, _IN_TEXT))
def gap_count(spark, sf):
    return gap.gap_scores(gap_rows(spark, sf, 15, "exact", "substring"), "unit")


@query("gap_weighted_count", _gap_sql(20, "job_count", _FALLBACK, f"({_IN_LIST} OR {_IN_TEXT} OR {_phrases()})"))
def gap_weighted_count(spark, sf):
    return gap.gap_scores(gap_rows(spark, sf, 20, "fallback", "either"), "job_count")
