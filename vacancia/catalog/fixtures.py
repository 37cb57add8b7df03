"""Job-shaped frames derived from the given tables, and the same as SQL text.

``postings`` gives every shape the portals have: NULLs, "not disclosed", ranges,
lakh units, plain amounts, mixed delimiters, several sources per key and exact
copies. Dictionaries here are test parameters for the words these tables hold.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from vacancia.functions.text import EDGE_SPACE, SPACE, whole_word
from vacancia.operators.gap import EVERY_ROLE
from vacancia.plans import gold as G
from vacancia.session import materialize

SKILLS = [
    "red", "blue", "hot", "cold", "ring", "bolt", "gear", "widget", "rod", "plate", "gizmo",
    "anvil", "urgent", "promo", "small ring", "large bolt",
]
# "gizmo" and "plate" titles fall through to Other.
ROLES = {"Fasteners": ["bolt", "ring", "rod"], "Machines": ["gear", "widget"], "Metal": ["anvil"]}
ROLE_TERMS = {
    "fasteners": ["red ring", "blue bolt"], "machines": ["hot gear", "new widget"],
    "metal": ["cold plate"],
}
STOPS = ["needs", "for", "at", "the", "and", "of", "de", "la"]
PROFILE_TEXT = "red ring bolt hot gear urgent"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Orders grow with the line items, so that join is never left to a broadcast; it comes
# first, so that everything after it runs on its many partitions.
POSTINGS_BODY = """
SELECT /*+ MERGE(orders) */
       concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS posting_ref,
       concat(' ', upper(substr(p_name, 1, 1)), substr(p_name, 2), '  ', p_type, ' ') AS job_title,
       CASE WHEN l_suppkey % 13 = 0 THEN concat(s_name, ' Pvt Ltd')
            WHEN l_suppkey % 17 = 0 THEN NULL ELSE s_name END AS company,
       CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE n_name END AS location,
       concat('portal_', cast(l_linenumber % 5 AS string)) AS source,
       CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 11 = 0 THEN 'not stated'
            ELSE concat(cast(p_size % 15 AS string), '-', cast(p_size % 15 + 3 AS string), ' Yrs') END AS experience,
       CASE WHEN p_size % 5 = 0 THEN 'Not disclosed'
            WHEN p_size % 5 = 1 THEN concat(cast(p_size % 30 + 1 AS string), '-', cast(p_size % 30 + 4 AS string), '.5 Lacs PA')
            WHEN p_size % 5 = 2 THEN cast(cast(floor(l_extendedprice) AS bigint) AS string)
            WHEN p_size % 5 = 3 THEN NULL
            ELSE concat(cast(p_size AS string), ' LPA') END AS salary,
       concat(replace(p_name, ' ', ', '), ' / ', p_type, ' | ', o_orderpriority, ';x') AS skills,
       CASE WHEN p_size % 10 = 0 THEN NULL
            ELSE concat('Needs ', p_name, ' for ', p_type, ' at ', o_orderpriority) END AS description,
       cast(o_orderdate AS string) AS posted_date,
       cast(l_shipdate AS string) AS scraped_at
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
     JOIN part ON p_partkey = l_partkey
     JOIN supplier ON s_suppkey = l_suppkey
     JOIN nation ON n_nationkey = s_nationkey
"""

# Two parts per supplier make its skill profile, some with two blanks inside a phrase; promo
# parts ask for a role no posting has.
PROFILES_BODY = f"""
SELECT s_suppkey AS profile_id,
       concat(CASE WHEN s_suppkey % 3 = 0 THEN replace(a.p_name, ' ', '  ') ELSE a.p_name END,
              ' ', b.p_name, ' ', lower(a.p_type)) AS profile_text,
       CASE WHEN a.p_type = 'PROMO' THEN 'Promotions'
            WHEN {' OR '.join(f"contains(a.p_name, '{w}')" for w in ROLES['Fasteners'])} THEN 'Fasteners'
            WHEN {' OR '.join(f"contains(a.p_name, '{w}')" for w in ROLES['Machines'])} THEN 'Machines'
            WHEN contains(a.p_name, 'anvil') THEN 'Metal'
            ELSE 'Other' END AS target_role
FROM supplier JOIN part a ON a.p_partkey = s_suppkey
     JOIN part b ON b.p_partkey = s_suppkey + s_nationkey
"""


def from_tables(spark, sf, body, names):
    for n in names:
        table(spark, sf, n).createOrReplaceTempView(n)
    return spark.sql(body)


def postings(spark: SparkSession, sf: str) -> DataFrame:
    return from_tables(spark, sf, POSTINGS_BODY, ["lineitem", "part", "supplier", "nation", "orders"])


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    return from_tables(spark, sf, PROFILES_BODY, ["supplier", "part"])


def raw_silver(spark, sf) -> DataFrame:
    """Silver columns before cleaning; the fixture has no link column."""
    df = postings(spark, sf)
    return df.select(
        "job_title", "company", "location", "experience", "salary", "skills", "description",
        F.lit(None).cast("string").alias("job_url"), "posted_date", "source",
    )


def silver(spark, sf) -> DataFrame:
    return G.silver(raw_silver(spark, sf))


def gold(spark, sf) -> DataFrame:
    return G.enrich(silver(spark, sf), SKILLS, ROLES, "Other")


def gold_v2(spark, sf) -> DataFrame:
    return G.enrich_v2(silver(spark, sf), SKILLS, ROLES, "other")


def gold_table(spark, sf) -> DataFrame:
    """Gold written once and read back: what jobs with several passes start from."""
    return materialize(gold(spark, sf), "gold")


# --- the same frames as SQL ---------------------------------------------------


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(quoted(i) for i in items) + "]"


def s_round(c: str, places: int = 2) -> str:
    return f"(round_even(({c}) * {10**places}.0::double, 0) / {10**places}.0::double)"


def s_strip(c: str) -> str:
    return f"regexp_replace({c}, '{EDGE_SPACE}', '', 'g')"


def s_clean(c: str) -> str:
    return s_strip(f"lower(coalesce({c}, ''))")


def s_squeeze(c: str) -> str:
    return f"regexp_replace({c}, '{SPACE}+', ' ', 'g')"


def s_strict(c: str) -> str:
    return f"regexp_replace({s_squeeze(s_clean(c))}, '[^a-z0-9,+.# ]', '', 'g')"


def s_company(c: str) -> str:
    words = r"\bprivate limited\b|\bpvt ltd\b|\bltd\b|\blimited\b|\binc\b|\bllp\b"
    return s_strip(s_squeeze(f"regexp_replace({s_strict(c)}, '{words}', '', 'g')"))


def s_dedup_key(title="title", company="company", location="location") -> str:
    return f"concat({s_strict(title)}, '|', {s_company(company)}, '|', {s_strict(location)})"


def s_role(c: str, rules, default: str) -> str:
    whens = " ".join(
        f"WHEN {' OR '.join(f'contains({s_clean(c)}, {quoted(w)})' for w in words)} THEN {quoted(name)}"
        for name, words in rules.items()
    )
    return f"CASE {whens} ELSE {quoted(default)} END"


def s_skills_word(c: str, dictionary) -> str:
    items = ", ".join(
        f"CASE WHEN regexp_matches({c}, '{whole_word(k)}') THEN {quoted(k)} END"
        for k in sorted(set(dictionary))
    )
    return f"list_filter([{items}], lambda k: k IS NOT NULL)"


def s_skills_substring(c: str, dictionary) -> str:
    items = ", ".join(
        f"CASE WHEN contains({c}, {quoted(k)}) THEN {quoted(k)} END"
        for k in sorted(set(dictionary))
    )
    return f"list_filter([{items}], lambda k: k IS NOT NULL)"


def s_exp_first(c: str) -> str:
    return f"nullif(regexp_extract({s_clean(c)}, '([0-9]+)', 1), '')"


def s_exp_bucket(c: str, labels) -> str:
    years = f"try_cast({s_exp_first(c)} AS double)"
    steps = " ".join(f"WHEN {years} <= {b} THEN '{label}'" for b, label in labels["bounds"])
    return (f"CASE WHEN {years} IS NULL THEN '{labels['missing']}' "
            f"WHEN {years} = 0 THEN '{labels['zero']}' {steps} ELSE '{labels['above']}' END")


def s_salary(c: str) -> tuple[str, str]:
    """(minimum, maximum) expressions."""
    text = s_clean(c)
    numbers = f"regexp_extract_all({text}, '([0-9]+(?:\\.[0-9]+)?)', 1)"
    hidden = (f"({text} IN ('', 'not disclosed', 'not mentioned', 'na', 'none', 'nan') OR "
              f"contains({text}, 'not disclosed') OR contains({text}, 'undisclosed') "
              f"OR contains({text}, 'not mentioned'))")
    unit = (f"CASE WHEN contains({text}, 'lakh') OR contains({text}, 'lac') "
            f"OR contains({text}, 'lpa') THEN 100000.0::double ELSE 1.0::double END")
    low = f"CASE WHEN NOT {hidden} THEN cast({numbers}[1] AS double) * {unit} END"
    high = (f"CASE WHEN NOT {hidden} THEN coalesce(cast({numbers}[2] AS double), "
            f"cast({numbers}[1] AS double)) * {unit} END")
    return low, high


SILVER_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in
    ["job_title", "company", "location", "experience", "salary", "skills", "description",
     "job_url", "posted_date", "source"]
)

POSTINGS = f"postings AS ({POSTINGS_BODY})"
PROFILES = f"profiles AS ({PROFILES_BODY})"
CLEAN = f"""{POSTINGS}, clean AS (
  SELECT *, md5(lower(concat(coalesce(job_title, ''), coalesce(company, ''), coalesce(location, ''), coalesce(source, '')))) AS job_id
  FROM (SELECT {s_strip('lower(job_title)')} AS job_title, {s_strip('lower(company)')} AS company,
               {s_strip('lower(location)')} AS location, experience, salary, lower(skills) AS skills,
               lower(description) AS description, cast(NULL AS varchar) AS job_url, posted_date, source
        FROM postings WHERE job_title IS NOT NULL AND company IS NOT NULL))"""
SILVER = f"""{CLEAN}, silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY {SILVER_ORDER}) AS rn FROM clean)
  WHERE rn = 1)"""


@lru_cache
def _gold() -> str:
    from vacancia.dictionaries import EXPERIENCE_V3

    low, high = s_salary("salary")
    text = f"concat({s_clean('job_title')}, ' ', {s_clean('skills')}, ' ', {s_clean('description')})"
    return f"""{SILVER}, enriched AS (
  SELECT *, {text} AS combined_text, {s_role('job_title', ROLES, 'Other')} AS role_category,
         {s_exp_bucket('experience', EXPERIENCE_V3)} AS experience_bucket,
         {low} AS salary_min, {high} AS salary_max
  FROM silver), skilled AS (
  SELECT *, (salary_min + salary_max) / 2 AS salary_avg,
         {s_skills_word('combined_text', SKILLS)} AS extracted_skills FROM enriched), gold AS MATERIALIZED (
  SELECT *, cast(len(extracted_skills) AS integer) AS skill_count FROM skilled)"""


GOLD = _gold()


@lru_cache
def _gold_v2() -> str:
    from vacancia.dictionaries import EXPERIENCE_V2

    text = "concat(coalesce(job_title, ''), ' ', coalesce(skills, ''), ' ', coalesce(description, ''))"
    return f"""{SILVER}, enriched AS (
  SELECT *, {text} AS combined_text, {s_role('job_title', ROLES, 'other')} AS role_category,
         {s_exp_bucket('experience', EXPERIENCE_V2)} AS experience_group FROM silver), gold AS (
  SELECT *, {s_skills_substring(s_clean('combined_text'), SKILLS)} AS extracted_skills FROM enriched)"""


GOLD_V2 = _gold_v2()

ROLE_MARKET = f"""role_market AS (
  SELECT role_category, cast(count(*) AS bigint) AS role_market_jobs FROM gold
  WHERE role_category IS NOT NULL GROUP BY role_category
  UNION ALL SELECT '{EVERY_ROLE}', cast(count(*) AS bigint) FROM gold)"""


def ranked_skills(n: int) -> str:
    """CTEs role_market and ranked: top n skills of each role and of the whole market."""
    return f"""{ROLE_MARKET}, pairs AS (
  SELECT role_category, unnest(extracted_skills) AS skill FROM gold), pair_counts AS (
  SELECT role_category, skill, cast(count(*) AS bigint) AS job_count FROM pairs GROUP BY ALL
  UNION ALL SELECT '{EVERY_ROLE}', skill, cast(count(*) AS bigint) FROM pairs GROUP BY skill), ranked AS (
  SELECT c.role_category, skill, job_count, {s_round('job_count / role_market_jobs * 100')} AS demand_percent,
         row_number() OVER (PARTITION BY c.role_category ORDER BY job_count DESC, skill) AS skill_rank
  FROM pair_counts c JOIN role_market m ON m.role_category = c.role_category QUALIFY skill_rank <= {n})"""
