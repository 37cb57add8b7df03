"""Projections, filters, scalar functions, dedup and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancia import dictionaries as D, schema as S
from vacancia.catalog import fixtures as X
from vacancia.catalog.registry import query
from vacancia.functions import enrich as E, text as T
from vacancia.operators import dedup, demand, gap, joins, reports, standardise as N
from vacancia.plans import gold as G

Q = X.quoted

# --- standardise and filter ----------------------------------------------------


def _portal_raw(spark, sf):
    """Postings under a portal's own headers: synonyms, blanks and mixed case."""
    p = X.postings(spark, sf)
    return p.select(
        F.col("posting_ref").alias("job_id"), F.col("job_title"), F.col("company").alias("companyName"),
        F.col("location").alias("job_location"), "experience", "salary", "skills",
        F.col("description").alias("jd"), "posted_date", F.col("scraped_at").alias("scrape_time"),
        F.lit("own").alias("source"),
    )


@query("std_master", f"""WITH {X.POSTINGS}
SELECT posting_ref AS job_id, job_title AS title, company, location, experience, salary, skills,
       description, posted_date, cast(NULL AS varchar) AS searched_role, 'portal' AS source, scraped_at
FROM postings""")
def std_master(spark, sf):
    return N.standardise_master(_portal_raw(spark, sf), "portal")


@query("std_silver", f"""WITH {X.POSTINGS}
SELECT job_title, coalesce(company, location) AS company, location, experience, salary, skills, description,
       posting_ref AS job_url, posted_date, 'portal' AS source FROM postings""")
def std_silver(spark, sf):
    p = X.postings(spark, sf).select(
        F.col("job_title").alias(" Title "), F.col("company").alias("CompanyName"),
        F.coalesce("company", "location").alias("company"), F.col("location").alias("Locations"),
        F.col("experience").alias("EXP"), F.col("salary").alias("Salary"), "skills",
        F.col("description").alias("jobDescription"), F.col("posting_ref").alias("apply_url"),
        F.col("posted_date").alias("createdAt"),
    )
    return N.standardise_silver(p, "portal")


@query("std_backfill", f"""WITH {X.POSTINGS}
SELECT job_title, coalesce(company, '') AS company, coalesce(location, '') AS location, source,
       '' AS experience, '' AS salary, '' AS skills, '' AS description, '' AS job_url,
       '' AS posted_date, '' AS job_id FROM postings""")
def std_backfill(spark, sf):
    p = X.postings(spark, sf).select("job_title", "company", "location", "source")
    return N.backfill(p, fill_null=True)


@query("flt_required", f"""WITH {X.POSTINGS}
SELECT * FROM postings WHERE job_title IS NOT NULL AND company IS NOT NULL""")
def flt_required(spark, sf):
    return N.required(X.postings(spark, sf))


@query("flt_nonblank", f"""WITH {X.POSTINGS}
SELECT posting_ref, job_title AS title, company FROM postings
WHERE {X.s_strict('job_title')} <> '' AND {X.s_company('company')} <> ''""")
def flt_nonblank(spark, sf):
    p = X.postings(spark, sf).select("posting_ref", F.col("job_title").alias("title"), "company")
    return N.non_blank(p)


@query("flt_salary_band", f"""WITH {X.GOLD}
SELECT job_id, salary, salary_min, salary_max, salary_avg FROM gold
WHERE salary_avg >= 50000 AND salary_avg <= 10000000""")
def flt_salary_band(spark, sf):
    return N.salary_band(X.gold(spark, sf)).select(
        "job_id", "salary", "salary_min", "salary_max", "salary_avg")


@query("flt_not_other", f"""WITH {X.GOLD}
SELECT job_id, job_title, role_category FROM gold WHERE role_category <> 'Other'""")
def flt_not_other(spark, sf):
    return N.known_role(X.gold(spark, sf)).select("job_id", "job_title", "role_category")


_FLT_ROLE_MODES = {
    "exact": "JOIN role_market m ON m.role_category = target_role WHERE m.role_category <> '*'",
    "ignore_case": "JOIN role_market m ON lower(m.role_category) = lower(target_role) WHERE m.role_category <> '*'",
    "fallback": "JOIN role_market m ON m.role_category = CASE WHEN target_role IN "
                "(SELECT role_category FROM role_market) THEN target_role ELSE '*' END",
}


@query("flt_role", f"WITH {X.GOLD}, {X.PROFILES}, {X.ROLE_MARKET}, asked AS (SELECT profile_id, CASE WHEN "
       "profile_id % 2 = 0 THEN upper(target_role) ELSE target_role END AS target_role FROM profiles)"
       + " UNION ALL ".join(
           f" SELECT '{mode}' AS mode, profile_id, target_role, m.role_category AS market_role, "
           f"role_market_jobs FROM asked {clause}" for mode, clause in _FLT_ROLE_MODES.items()))
def flt_role(spark, sf):
    gold = X.gold(spark, sf)
    loud = F.when(F.col("profile_id") % 2 == 0, F.upper("target_role")).otherwise(F.col("target_role"))
    asked = X.profiles(spark, sf).select("profile_id", loud.alias("target_role"))
    return N.union_all([
        gap.match_role(asked, gold, mode).select(
            F.lit(mode).alias("mode"), "profile_id", "target_role", "market_role", "role_market_jobs")
        for mode in _FLT_ROLE_MODES
    ])


@query("flt_train_null", f"""WITH {X.POSTINGS}
SELECT posting_ref, description AS combined_text, location AS role_category FROM postings
WHERE description IS NOT NULL AND location IS NOT NULL""")
def flt_train_null(spark, sf):
    p = X.postings(spark, sf).select(
        "posting_ref", F.col("description").alias("combined_text"),
        F.col("location").alias("role_category"))
    return N.trainable(p)


_STAMP = "2026-01-01 00:00:00"


@query("prj_fact", f"""WITH {X.GOLD}
SELECT job_title, company, location, experience, salary, skills, description, job_url, posted_date, source,
       job_id, role_category, experience_bucket, array_to_string(extracted_skills, ', ') AS extracted_skills,
       skill_count, salary_min, salary_max, salary_avg, '{_STAMP}' AS gold_processed_at FROM gold""")
def prj_fact(spark, sf):
    return G.fact(G.stamped(X.gold(spark, sf), F.lit(_STAMP)), S.FACT_V3)


@query("prj_fact_v2", f"""WITH {X.GOLD_V2}
SELECT job_id, job_title, company, location, experience, salary, source, posted_date, job_url,
       role_category, experience_group, array_to_string(extracted_skills, ', ') AS extracted_skills,
       '{_STAMP}' AS gold_processed_at FROM gold""")
def prj_fact_v2(spark, sf):
    return G.fact(G.stamped(X.gold_v2(spark, sf), F.lit(_STAMP)), S.FACT_V2)


@query("prj_fact_v1", f"WITH {X.SILVER} SELECT *, '{_STAMP}' AS gold_processed_at FROM silver")
def prj_fact_v1(spark, sf):
    return G.stamped(X.silver(spark, sf), F.lit(_STAMP))


@query("prj_ml", f"""WITH {X.GOLD}
SELECT combined_text, role_category, experience_bucket, skill_count, source FROM gold
WHERE role_category <> 'Other'""")
def prj_ml(spark, sf):
    return G.ml_role(X.gold(spark, sf))


@query("prj_ml_salary", f"""WITH {X.GOLD}
SELECT job_title, company, location, role_category, experience_bucket, skill_count, source, salary_avg
FROM gold WHERE salary_avg BETWEEN 50000 AND 10000000""")
def prj_ml_salary(spark, sf):
    return G.ml_salary(X.gold(spark, sf))


@query("prj_ml_v2", f"""WITH {X.GOLD_V2}
SELECT job_title, company, location, experience_group, role_category,
       array_to_string(extracted_skills, ', ') AS extracted_skills, source FROM gold""")
def prj_ml_v2(spark, sf):
    return G.ml_v2(X.gold_v2(spark, sf))


@query("prj_ml_v1", f"WITH {X.SILVER} SELECT job_title, skills, description, experience FROM silver")
def prj_ml_v1(spark, sf):
    return G.ml_v1(X.silver(spark, sf))


@query("prj_available", f"""WITH {X.GOLD}
SELECT job_id, job_title, company, location, experience, salary, source, role_category, experience_bucket,
       cast(skill_count AS double) AS skill_count, salary_min, salary_max, salary_avg, posted_date FROM gold""")
def prj_available(spark, sf):
    return N.available(X.gold(spark, sf), [*S.OVERVIEW_COLUMNS, "not_there"],
                       ("salary_avg", "skill_count"), ("skill_count",))


@query("prj_preview", f"""WITH {X.SILVER}
SELECT * EXCLUDE (experience, salary) FROM silver ORDER BY job_id LIMIT 20""")
def prj_preview(spark, sf):
    return N.preview(X.silver(spark, sf), ["experience", "salary"], ["job_id"])


# --- scalar and array functions --------------------------------------------------


def _mapped(spark, sf, *cols):
    return X.postings(spark, sf).select("posting_ref", *cols)


def _fn(name, sql, *cols):
    """Register a per-posting projection: oracle select list and Spark columns."""
    query(name, f"WITH {X.POSTINGS} SELECT posting_ref, {sql} FROM postings")(
        lambda spark, sf: _mapped(spark, sf, *[c() for c in cols]))


_fn("fn_clean_basic", f"{X.s_clean('job_title')} AS title, {X.s_clean('company')} AS company",
    lambda: T.clean_basic("job_title").alias("title"), lambda: T.clean_basic("company").alias("company"))
_fn("fn_clean_strict", f"{X.s_strict('skills')} AS skills, {X.s_strict('job_title')} AS title",
    lambda: T.clean_strict("skills").alias("skills"), lambda: T.clean_strict("job_title").alias("title"))
_fn("fn_company_norm", f"{X.s_company('company')} AS company",
    lambda: T.company_norm("company").alias("company"))

_REC = ("regexp_replace(regexp_replace(lower(concat(coalesce(job_title, ''), ' ', {role}, ' ', "
        "coalesce(skills, ''), ' ', coalesce(description, ''), ' ', coalesce(location, ''), ' ', "
        r"coalesce(experience, ''))), '[^a-zA-Z0-9+#.\s]', ' ', 'g'), '\s+', ' ', 'g')")
_fn("fn_rec_text", f"{_REC.format(role='source')} AS recommendation_text",
    lambda: T.recommendation_text(
        ("job_title", "source", "skills", "description", "location", "experience")
    ).alias("recommendation_text"))
_fn("fn_combined_text",
    f"concat({X.s_clean('job_title')}, ' ', {X.s_clean('skills')}, ' ', {X.s_clean('description')}) AS v3, "
    "concat(coalesce(job_title, ''), ' ', coalesce(skills, ''), ' ', coalesce(description, '')) AS v2",
    lambda: T.combined_text().alias("v3"), lambda: T.combined_text(clean=False).alias("v2"))

_TEXT = f"concat({X.s_clean('job_title')}, ' ', {X.s_clean('skills')}, ' ', {X.s_clean('description')})"


def _text():
    return T.combined_text()


_fn("fn_skills_substr", f"array_to_string({X.s_skills_substring(_TEXT, X.SKILLS)}, ', ') AS skills",
    lambda: F.array_join(E.skills_substring(_text(), X.SKILLS), ", ").alias("skills"))
_fn("fn_skills_word", f"array_to_string({X.s_skills_word(_TEXT, X.SKILLS)}, ', ') AS skills",
    lambda: F.array_join(E.skills_word(_text(), X.SKILLS), ", ").alias("skills"))
_fn("fn_skill_count", f"cast(len({X.s_skills_word(_TEXT, X.SKILLS)}) AS integer) AS skill_count",
    lambda: F.size(E.skills_word(_text(), X.SKILLS)).alias("skill_count"))

_SPLIT = (f"list_filter(list_transform(regexp_split_to_array(lower(skills), '[,/|;]'), lambda s: "
          f"{X.s_strip('s')}), lambda s: len(s) > 1)")
_fn("fn_skills_split", f"array_to_string({_SPLIT}, '~') AS skills",
    lambda: F.array_join(E.skills_split("skills"), "~").alias("skills"))

# A list literal, comma text or a single value, by the shape of the posting.
_RAW = ("CASE WHEN salary IS NULL THEN concat('[''', replace(trim(job_title), ' ', ''', '''), ''']') "
        "WHEN experience IS NULL THEN concat(' ', replace(coalesce(description, ''), ' ', ', '), ' ') "
        "ELSE job_title END")
_PARTS = (r"""CASE WHEN starts_with(v, '[') AND ends_with(v, ']') THEN list_transform(regexp_extract_all("""
          r"""regexp_replace(v, '^\[|\]$', '', 'g'), '(''[^'']*''|"[^"]*"|[^,''"]+)', 1), """
          r"""lambda x: trim(regexp_replace(trim(x), '^[''"]|[''"]$', '', 'g'))) """
          r"""WHEN contains(v, ',') THEN list_transform(string_split(v, ','), lambda x: trim(x)) ELSE [v] END""")


@query("fn_skills_parse", f"""WITH {X.POSTINGS}, shaped AS (
  SELECT posting_ref, {_RAW} AS raw FROM postings), stripped AS (
  SELECT posting_ref, {X.s_strip('raw')} AS v FROM shaped)
SELECT posting_ref, array_to_string(list_transform(list_filter({_PARTS}, lambda x: x <> ''),
       lambda x: lower(x)), '~') AS skills FROM stripped""")
def fn_skills_parse(spark, sf):
    raw = X.postings(spark, sf).select("posting_ref", F.expr(_spark_raw()).alias("raw"))
    return raw.select("posting_ref", F.array_join(E.skills_parse("raw"), "~").alias("skills"))


def _spark_raw() -> str:
    """The shaped value for the SQL parser here, which escapes quotes by backslash."""
    return (
        "CASE WHEN salary IS NULL THEN concat(\"['\", replace(trim(job_title), ' ', \"', '\"), \"']\") "
        "WHEN experience IS NULL THEN concat(' ', replace(coalesce(description, ''), ' ', ', '), ' ') "
        "ELSE job_title END"
    )


_LOOSE = (f"list_filter(list_transform(regexp_split_to_array(translate(lower(coalesce(skills, '')), '[]''\"', ''), "
          f"'[,|;]'), lambda s: {X.s_strip('s')}), lambda s: s <> '')")
_LOOSE_COMMA = _LOOSE.replace("[,|;]", "[,]")
_fn("fn_skills_parse_ui", f"array_to_string({_LOOSE}, '~') AS skills, array_to_string({_LOOSE_COMMA}, '~') AS comma_only",
    lambda: F.array_join(E.skills_parse_loose("skills"), "~").alias("skills"),
    lambda: F.array_join(E.skills_parse_loose("skills", ","), "~").alias("comma_only"))

_HITS = ", ".join(
    f"CASE WHEN regexp_matches(lower(profile_text), '(^|[^\\p{{L}}\\p{{N}}_]){(X.SPACE + '+').join(k.split(' '))}"
    f"($|[^\\p{{L}}\\p{{N}}_])') THEN {Q(k)} END" for k in sorted(X.SKILLS))


@query("fn_profile_tokens", f"""WITH {X.GOLD}, {X.PROFILES}, market AS (
  SELECT DISTINCT unnest(extracted_skills) AS skill FROM gold), hits AS (
  SELECT profile_id, unnest([{_HITS}]) AS skill FROM profiles), tokens AS (
  SELECT profile_id, unnest(regexp_split_to_array(lower(profile_text), '(?:,|\\||{X.SPACE})+')) AS skill FROM profiles)
SELECT profile_id, skill FROM hits WHERE skill IN (SELECT skill FROM market)
UNION SELECT profile_id, skill FROM tokens WHERE skill <> ''""")
def fn_profile_tokens(spark, sf):
    market = demand.skill_demand(X.gold(spark, sf))
    return gap.phrases_in_market(X.profiles(spark, sf), market, X.SKILLS)


@query("fn_has_skill", f"""WITH {X.GOLD}, {X.PROFILES}, {X.ranked_skills(20)}, owned AS (
  SELECT *, list_filter(regexp_split_to_array(lower(profile_text), '(?:,|\\||{X.SPACE})+'), lambda t: t <> '') AS owned_skills
  FROM profiles)
SELECT profile_id, skill, list_contains(owned_skills, skill) AS has_exact,
       contains(lower(profile_text), skill) AS has_substring,
       list_contains(owned_skills, skill) OR contains(lower(profile_text), skill) AS has_either
FROM owned JOIN ranked ON role_category = target_role""")
def fn_has_skill(spark, sf):
    skills = gap.ranked_role_skills(X.gold(spark, sf), 20)
    owned = X.profiles(spark, sf).withColumn("owned_skills", E.raw_tokens("profile_text"))
    rows = owned.join(skills, F.col("role_category") == F.col("target_role"))
    return rows.select("profile_id", "skill", *[
        E.has_skill("skill", "owned_skills", "profile_text", m).alias(f"has_{m}")
        for m in ("exact", "substring", "either")])


_fn("fn_role_v2",
    f"{X.s_role('job_title', X.ROLES, 'other')} AS role, {X.s_role('description', D.ROLES_V2, 'other')} AS default_role",
    lambda: E.role_v2("job_title", X.ROLES, "other").alias("role"),
    lambda: E.role_v2("description").alias("default_role"))
_fn("fn_role_v3",
    f"{X.s_role('job_title', X.ROLES, 'Other')} AS role, {X.s_role('skills', D.ROLES_V3, 'Other')} AS default_role",
    lambda: E.role_v3("job_title", X.ROLES, "Other").alias("role"),
    lambda: E.role_v3("skills").alias("default_role"))
_fn("fn_exp_min", f"try_cast({X.s_exp_first('experience')} AS bigint) AS exp_min, "
    f"try_cast({X.s_exp_first('salary')} AS bigint) AS salary_first",
    lambda: E.exp_min("experience").alias("exp_min"), lambda: E.exp_min("salary").alias("salary_first"))
_fn("fn_exp_bucket_v2", f"{X.s_exp_bucket('experience', D.EXPERIENCE_V2)} AS bucket",
    lambda: E.exp_bucket("experience", D.EXPERIENCE_V2).alias("bucket"))
_fn("fn_exp_bucket_v3", f"{X.s_exp_bucket('experience', D.EXPERIENCE_V3)} AS bucket",
    lambda: E.exp_bucket("experience").alias("bucket"))
_LOW, _HIGH = X.s_salary("salary")
_fn("fn_salary", f"salary, {_LOW} AS salary_min, {_HIGH} AS salary_max, ({_LOW} + {_HIGH}) / 2 AS salary_avg",
    lambda: F.col("salary"), lambda: E.salary("salary")["salary_min"].alias("salary_min"),
    lambda: E.salary("salary")["salary_max"].alias("salary_max"),
    lambda: E.salary("salary")["salary_avg"].alias("salary_avg"))
_fn("fn_job_id", "md5(lower(concat(coalesce(job_title, ''), coalesce(company, ''), coalesce(location, ''), "
    "coalesce(source, '')))) AS job_id", lambda: T.job_id().alias("job_id"))
_fn("fn_dedup_key", f"{X.s_dedup_key('job_title')} AS dedup_key",
    lambda: T.dedup_key("job_title", "company", "location").alias("dedup_key"))


def _doc(*parts):
    return "concat(" + ", chr(10), ".join(
        f"'{label}: ', coalesce({c}, '')" for label, c in parts) + ")"


DOCUMENT_V3 = _doc(("Job Title", "job_title"), ("Company", "company"), ("Location", "location"),
                   ("Experience", "experience"), ("Role Category", "role_category"), ("Skills", "skills"),
                   ("Extracted Skills", "array_to_string(extracted_skills, ', ')"),
                   ("Description", "description"))
DOCUMENT_V2 = _doc(("Job Title", "job_title"), ("Company", "company"), ("Location", "location"),
                   ("Experience", "experience"), ("Salary", "salary"),
                   ("Skills", "array_to_string(extracted_skills, ', ')"), ("Description", "description"))
DOCUMENT_V1 = _doc(("Job Title", "job_title"), ("Company", "company"), ("Skills Required", "skills"),
                   ("Experience", "experience"), ("Description", "description"))


@query("fn_document", f"WITH {X.GOLD} SELECT job_id, role_category, source, {DOCUMENT_V3} AS document_text FROM gold")
def fn_document(spark, sf):
    return G.documents_v3(X.gold(spark, sf))


@query("fn_document_v2", f"WITH {X.GOLD_V2} SELECT job_id, {DOCUMENT_V2} AS document_text FROM gold")
def fn_document_v2(spark, sf):
    return G.documents_v2(X.gold_v2(spark, sf))


@query("fn_document_v1", f"WITH {X.SILVER} SELECT {DOCUMENT_V1} AS document FROM silver")
def fn_document_v1(spark, sf):
    return G.documents_v1(X.silver(spark, sf))


@query("fn_percent", f"""SELECT l_orderkey, l_linenumber, l_quantity,
       {X.s_round('l_linenumber / nullif(l_quantity, 0) * 100')} AS pct FROM lineitem""")
def fn_percent(spark, sf):
    return X.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", T.percent("l_linenumber", "l_quantity").alias("pct"))


_fn("fn_to_number", "salary, try_cast(salary AS double) AS amount", lambda: F.col("salary"),
    lambda: T.to_number("salary").alias("amount"))


@query("fn_band", """SELECT event_id, value, CASE WHEN value < 40 THEN '0-40' WHEN value < 70 THEN '40-70'
       WHEN value IS NOT NULL THEN '70-100' END AS band FROM events""")
def fn_band(spark, sf):
    return X.table(spark, sf, "events").select("event_id", "value", T.score_band("value").alias("band"))


# --- dedup, upsert, set operations, reshape ---------------------------------------

_MASTER = f"""{X.POSTINGS}, master AS (
  SELECT posting_ref AS job_id, job_title AS title, company, location, experience, salary, skills, description,
         posted_date, cast(NULL AS varchar) AS searched_role, source, scraped_at FROM postings)"""
_MASTER_ORDER = ", ".join(f"{c} NULLS FIRST" for c in S.MASTER_COLUMNS)
_KEYED = f"""{_MASTER}, keyed AS (
  SELECT *, {X.s_dedup_key()} AS dedup_key FROM master
  WHERE {X.s_strict('title')} <> '' AND {X.s_company('company')} <> ''), sets AS (
  SELECT dedup_key, cast(count(DISTINCT source) AS bigint) AS source_count,
         string_agg(DISTINCT source, ',' ORDER BY source) AS sources_available FROM keyed GROUP BY dedup_key)"""


def master(spark, sf):
    p = X.postings(spark, sf).withColumnRenamed("posting_ref", "job_id")
    return N.standardise_master(p, F.col("source"))


def keyed(spark, sf):
    return dedup.with_dedup_key(N.non_blank(master(spark, sf)))


@query("ddp_id_first", f"WITH {X.SILVER} SELECT * FROM silver")
def ddp_id_first(spark, sf):
    return dedup.first_by_id(G.clean(X.raw_silver(spark, sf)))


@query("ddp_best", f"""WITH {_KEYED}, best AS (
  SELECT * FROM keyed QUALIFY row_number() OVER (
    PARTITION BY dedup_key ORDER BY scraped_at DESC NULLS LAST, {_MASTER_ORDER}) = 1)
SELECT best.*, source_count, sources_available FROM best JOIN sets USING (dedup_key)""")
def ddp_best(spark, sf):
    return G.master(master(spark, sf))


# The batch of a posting is its scrape stamp.
LAST_ID = f"""WITH {_MASTER} SELECT * FROM master QUALIFY row_number() OVER (
  PARTITION BY job_id ORDER BY scraped_at DESC NULLS LAST, {_MASTER_ORDER}) = 1"""


@query("ddp_last_id", LAST_ID)
def ddp_last_id(spark, sf):
    return dedup.last_by_id(master(spark, sf), "scraped_at")


@query("ddp_last_natural", f"""WITH {_MASTER} SELECT * FROM master QUALIFY row_number() OVER (
  PARTITION BY title, company, location ORDER BY scraped_at DESC NULLS LAST, {_MASTER_ORDER}) = 1""")
def ddp_last_natural(spark, sf):
    return dedup.last_by_fields(master(spark, sf), "scraped_at")


@query("ddp_first_lowered", f"""WITH {_MASTER}, lowered AS (
  SELECT * REPLACE ({X.s_strip('lower(title)')} AS title, {X.s_strip('lower(company)')} AS company,
                    {X.s_strip('lower(location)')} AS location) FROM master)
SELECT * FROM lowered QUALIFY row_number() OVER (PARTITION BY title, company, location ORDER BY {_MASTER_ORDER}) = 1""")
def ddp_first_lowered(spark, sf):
    return dedup.first_lowered(master(spark, sf))


_TERMS = [(c, w, i) for i, (c, w) in enumerate((c, w) for c, ws in X.ROLE_TERMS.items() for w in ws)]
_MATCHES = f"""{_MASTER}, terms(category, searched, role_position) AS (
  VALUES {', '.join(f"({Q(c)}, {Q(w)}, {i})" for c, w, i in _TERMS)}), matches AS (
  SELECT m.* EXCLUDE (searched_role), category, searched AS searched_role, cast(role_position AS integer) AS role_position
  FROM master m JOIN terms ON contains(lower(concat(coalesce(title, ''), ' ', coalesce(company, ''), ' ',
       coalesce(location, ''), ' ', coalesce(skills, ''), ' ', coalesce(description, ''))), searched))"""


def matches(spark, sf):
    return joins.match_roles(master(spark, sf).drop("searched_role"), X.ROLE_TERMS)


@query("join_role_terms", f"WITH {_MATCHES} SELECT * FROM matches")
def join_role_terms(spark, sf):
    return matches(spark, sf)


_MATCH_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in
    [c for c in S.MASTER_COLUMNS if c != "searched_role"] + ["category", "searched_role", "role_position"])


@query("ddp_role_matches", f"""WITH {_MATCHES} SELECT * FROM matches QUALIFY row_number() OVER (
  PARTITION BY job_id ORDER BY role_position, {_MATCH_ORDER}) = 1""")
def ddp_role_matches(spark, sf):
    return dedup.first_role_match(matches(spark, sf))


# Three stored thirds; later thirds also rewrite the labels of the ids before them.
@query("ups_by_id", """WITH v AS (SELECT vec_id, label, embedding[1]::double AS first_value FROM embeddings),
  changes AS (SELECT vec_id, label, first_value, 0 AS version FROM v WHERE vec_id % 3 < 2
    UNION ALL SELECT vec_id, label + 100, -first_value, 1 FROM v WHERE vec_id % 3 > 0)
SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY version DESC) = 1""")
def ups_by_id(spark, sf):
    v = X.table(spark, sf, "embeddings").select(
        "vec_id", "label", F.col("embedding")[0].cast("double").alias("first_value"))
    third = F.col("vec_id") % 3
    stored = v.filter(third < 2).withColumn("version", F.lit(0))
    changed = v.filter(third > 0).select(
        "vec_id", (F.col("label") + 100).alias("label"), (-F.col("first_value")).alias("first_value"),
        F.lit(1).alias("version"))
    return dedup.upsert(stored, changed, "vec_id", "version")


@query("set_union_files", f"""WITH {X.POSTINGS}
SELECT posting_ref, job_title, cast(NULL AS varchar) AS company, salary FROM postings WHERE source = 'portal_0'
UNION ALL SELECT posting_ref, job_title, company, cast(NULL AS varchar) FROM postings WHERE source <> 'portal_0'""")
def set_union_files(spark, sf):
    p = X.postings(spark, sf)
    return N.union_all([
        p.filter("source = 'portal_0'").select("posting_ref", "job_title", "salary"),
        p.filter("source <> 'portal_0'").select("company", "job_title", "posting_ref"),
    ])


@query("set_distinct_roles", f"""WITH {_MATCHES}
SELECT searched_role, min(role_position) AS first_seen FROM matches GROUP BY searched_role
ORDER BY first_seen, searched_role""")
def set_distinct_roles(spark, sf):
    return dedup.distinct_in_order(matches(spark, sf), "searched_role", "role_position")


@query("rsh_explode", f"WITH {X.GOLD} SELECT role_category, source, unnest(extracted_skills) AS skill FROM gold")
def rsh_explode(spark, sf):
    return demand.skill_rows(X.gold(spark, sf), ("role_category", "source"))


_QUALITY_COLS = ["total_jobs", "unique_companies", "unique_locations", "salary_available_raw",
                 "avg_skill_count", "valid_salary_records", "valid_salary_availability_pct"]
SOURCE_QUALITY = f"""quality AS (
  SELECT source, count(job_title) AS total_jobs, count(DISTINCT company) AS unique_companies,
         count(DISTINCT location) AS unique_locations, count(salary_avg) AS salary_available_raw,
         {X.s_round('avg(skill_count)')} AS avg_skill_count,
         count(*) FILTER (salary_avg BETWEEN 50000 AND 10000000) AS valid_salary_records,
         {X.s_round('count(*) FILTER (salary_avg BETWEEN 50000 AND 10000000) / count(job_title) * 100')}
           AS valid_salary_availability_pct
  FROM gold WHERE source IS NOT NULL GROUP BY source)"""


@query("rsh_melt", f"WITH {X.GOLD}, {SOURCE_QUALITY} " + " UNION ALL ".join(
    f"SELECT source, '{c}' AS metric, cast({c} AS double) AS value FROM quality" for c in _QUALITY_COLS))
def rsh_melt(spark, sf):
    quality = demand.source_quality(X.gold(spark, sf), *D.SALARY_BAND)
    return reports.melt(quality, "source", _QUALITY_COLS)


SALARY_INSIGHTS = """insights AS (
  SELECT role_category, count(job_title) AS job_count, avg(salary_avg) AS avg_salary,
         min(salary_min) AS min_salary, max(salary_max) AS max_salary
  FROM gold WHERE salary_avg BETWEEN 50000 AND 10000000 AND role_category IS NOT NULL GROUP BY role_category)"""


@query("rsh_range", f"""WITH {X.GOLD}, {SALARY_INSIGHTS}
SELECT role_category, min_salary, max_salary, {X.s_round('avg_salary', 4)} AS avg_salary, {X.s_round('avg_salary', 4)} AS mid_salary
FROM insights ORDER BY mid_salary, role_category""")
def rsh_range(spark, sf):
    insights = demand.salary_insights(X.gold(spark, sf))
    return demand.salary_ranges(insights).withColumns(
        {c: T.rounded(c, 4) for c in ("avg_salary", "mid_salary")})
