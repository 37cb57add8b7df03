"""Sources, sinks, audits and streams. Files are first written from the postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancia import dictionaries as D, schema as S
from vacancia.catalog import cleaning as C, fixtures as X, marts as M
from vacancia.catalog.registry import query
from vacancia.functions import text as T
from vacancia.operators import joins, reports, standardise as N
from vacancia.plans import gold as G
from vacancia.session import materialize, scratch_path
from vacancia.sources import csv_files, json_payloads, sinks, web_pages
from vacancia.streaming import landing as stream

PORTALS = [f"portal_{i}" for i in range(5)]
_FIELDS = ["posting_ref", "job_title", "company", "location", "experience", "salary", "skills",
           "description", "posted_date", "scraped_at"]
# Every portal has its own headers and column order.
_HEADERS = {
    "portal_0": {},
    "portal_1": {"job_title": "Title", "company": "companyName", "location": "locations"},
    "portal_2": {"description": "jobDescription", "experience": "exp"},
    "portal_3": {"job_title": "title", "posted_date": "createdAt", "description": "jd"},
    "portal_4": {"job_title": "jobTitle ", "skills": " SKILLS"},
}


def raw_tree(spark, sf) -> str:
    """``<root>/<portal>/*.csv`` folders with the postings of each portal."""
    root = scratch_path(spark, "raw")
    postings = materialize(X.postings(spark, sf), "postings")
    for i, portal in enumerate(PORTALS):
        fields = _FIELDS[i:] + _FIELDS[:i]
        rows = postings.filter(F.col("source") == portal).select(
            [F.col(c).alias(_HEADERS[portal].get(c, c)) for c in fields])
        sinks.csv_writer(rows).csv(f"{root}/{portal}")
    return root


_TREE_COLUMNS = ("job_title, company, location, experience, salary, skills, description, "
                 "cast(NULL AS varchar) AS job_url, posted_date, source")


@query("src_csv_tree", f"WITH {X.POSTINGS} SELECT {_TREE_COLUMNS} FROM postings")
def src_csv_tree(spark, sf):
    rows, _, _ = csv_files.read_tree(spark, raw_tree(spark, sf), N.standardise_silver)
    return rows.drop("file_path")


@query("src_batches_glob", f"""WITH {X.POSTINGS}
SELECT posting_ref AS job_id, job_title AS title, company, location, experience, salary, skills, description,
       posted_date, cast(NULL AS varchar) AS searched_role, 'shop' AS source, scraped_at
FROM postings WHERE source <> 'portal_3'""")
def src_batches_glob(spark, sf):
    root = scratch_path(spark, "batches")
    p = materialize(X.postings(spark, sf), "postings").withColumnRenamed("posting_ref", "job_id")

    def put(rows, path):
        sinks.csv_writer(rows.drop("source")).csv(path)

    # Folders named *.csv: the glob takes them for files and reads the parts inside.
    put(p.filter("source IN ('portal_0', 'portal_1')"), f"{root}/shop/batches/shop_1.csv")
    put(p.filter("source = 'portal_2'"), f"{root}/shop/batches/shop_2.csv")
    put(p.filter("source = 'portal_3'"), f"{root}/shop/shop_Sample.csv")
    put(p.filter("source = 'portal_4'"), f"{root}/shop/shop_master.csv")
    rows, _, _ = csv_files.read_source(spark, root, "shop", N.standardise_master)
    return rows.drop("file_path")


# Files with one trap each: (folder, content, status, rows, bad rows, rows with a title).
_TRAPS = (
    ("portal_bom", "\ufefftitle,company\na,b\n", "success", 1, 0, 1),
    ("portal_twice", "Title,title,company\na,b,c\nd,,e\n", "success", 2, 0, 2),
    ("portal_short", "title,company,location\na,b\nc\nd,e,f\n", "success", 3, 0, 3),
    ("portal_long", "title,company\na,b,c,d\n\"x,\"\"y\"\"\nz\",b\n", "success", 1, 1, 1),
    ("portal_empty", "", "failed: No columns to parse from file", 0, 0, 0),
)


@query("src_tolerant", """WITH marked AS (
  SELECT concat('portal_', cast(l_linenumber % 5 AS varchar)) AS source, l_suppkey % 13 = 0 AS broken FROM lineitem)
SELECT source, 'success' AS status, cast(count(*) FILTER (NOT broken) AS bigint) AS raw_count,
       cast(count(*) FILTER (broken) AS bigint) AS bad_rows,
       cast(count(*) FILTER (NOT broken) AS bigint) AS titled FROM marked GROUP BY source
UNION ALL SELECT * FROM (VALUES """ + ", ".join(str((t[0], *t[2:])) for t in _TRAPS) + ")")
def src_tolerant(spark, sf):
    root = scratch_path(spark, "tolerant")
    lines = X.table(spark, sf, "lineitem").select(
        F.concat(F.lit("portal_"), (F.col("l_linenumber") % 5).cast("string")).alias("portal"),
        # Three-byte characters all over the file.
        F.concat(F.lit("\u20b9"), F.col("l_orderkey").cast("string")).alias("title"),
        # Unquoted commas give these rows one field too many.
        F.when(F.col("l_suppkey") % 13 == 0, "a,b").otherwise("a").alias("company"))
    for portal in PORTALS:
        rows = lines.filter(F.col("portal") == portal).drop("portal")
        rows.write.option("header", True).option("quote", "").csv(f"{root}/{portal}")
    for name, content, *_ in _TRAPS:
        spark.createDataFrame([(content,)], "value string").coalesce(1).write.text(f"{root}/{name}")
    rows, bad, headers = csv_files.read_globs(spark, [f"{root}/*/*.csv", f"{root}/*/*.txt"], N.standardise_silver)
    audit = csv_files.file_audit(headers, rows, bad).groupBy("source", "status").agg(
        F.sum("raw_count").alias("raw_count"), F.sum("bad_rows").alias("bad_rows"))
    titled = rows.groupBy("source").agg(F.count("job_title").alias("titled"))
    return audit.join(titled, "source", "left").na.fill(0, ["titled"])


@query("src_gz_fallback", f"""WITH {X.POSTINGS}
SELECT posting_ref, job_title, salary, description FROM postings
UNION ALL SELECT posting_ref, 'plain', NULL, NULL FROM postings WHERE source = 'portal_0'""")
def src_gz_fallback(spark, sf):
    root = scratch_path(spark, "gz")
    columns = ["posting_ref", "job_title", "salary", "description"]
    p = X.postings(spark, sf).select(*columns, "source")
    sinks.csv_writer(p.select(columns), "gzip").csv(f"{root}/jobs.csv.gz")
    plain = p.filter("source = 'portal_0'").select(
        "posting_ref", F.lit("plain").alias("job_title"), F.lit(None).cast("string").alias("salary"),
        F.lit(None).cast("string").alias("description"))
    sinks.csv_writer(plain).csv(f"{root}/plain.csv")
    schema = S.strings(columns)
    return N.union_all([
        csv_files.read_or_gz(spark, f"{root}/{name}.csv", schema) for name in ("jobs", "plain", "absent")])


# --- payloads ------------------------------------------------------------------------


def foundit_payloads(spark, sf):
    """A payload per posting: the posting, an item without title, and a bare string."""
    p = X.postings(spark, sf)
    years = F.split("experience", "[- ]")
    item = F.struct(
        F.col("posting_ref").alias("jobId"), F.col("job_title").alias("title"),
        F.col("company").alias("companyName"),
        F.array(F.coalesce("location", F.lit("-")), F.lit(" Remote ")).alias("locations"),
        F.struct(F.try_element_at(years, F.lit(1)).try_cast("int").alias("years")).alias("minimumExperience"),
        F.struct(F.try_element_at(years, F.lit(2)).try_cast("int").alias("years")).alias("maximumExperience"),
        F.col("salary"), F.struct(F.col("salary").try_cast("double").alias("absoluteValue")).alias("minimumSalary"),
        F.split("skills", ",").alias("skills"), F.col("description"), F.col("posted_date").alias("postedDate"),
        F.concat(F.lit("http://x/"), "posting_ref").alias("redirectUrl"))
    payload = F.concat(
        F.lit('{"jobSearchResponse":{"data":["text",{"jobId":"none","title":""},'), F.to_json(item), F.lit("]}}"))
    return p.select("source", payload.alias("payload")).withColumnRenamed("source", "portal")


@query("src_json_foundit", f"""WITH {X.POSTINGS}, y AS (SELECT *,
  try_cast(regexp_split_to_array(experience, '[- ]')[1] AS integer) AS lo,
  try_cast(regexp_split_to_array(experience, '[- ]')[2] AS integer) AS hi FROM postings)
SELECT posting_ref AS job_id, {X.s_strip('job_title')} AS title, company,
       concat(coalesce(location, '-'), ',  Remote ') AS location,
       concat(coalesce(cast(lo AS varchar), 'None'), ' - ', coalesce(cast(hi AS varchar), 'None')) AS experience,
       cast(lo AS double) AS min_exp, cast(hi AS double) AS max_exp, salary,
       try_cast(salary AS double) AS min_salary, array_to_string(string_split(skills, ','), ', ') AS skills,
       description, posted_date, concat('http://x/', posting_ref) AS apply_url, 'foundit' AS source FROM y""")
def src_json_foundit(spark, sf):
    rows = json_payloads.foundit_rows(foundit_payloads(spark, sf))
    return rows.drop("portal", "max_salary", "updated_at", "employment_type", "industry")


@query("src_json_valid", f"""WITH {X.POSTINGS}
SELECT source AS portal, cast(count(*) AS bigint) AS items FROM postings GROUP BY source""")
def src_json_valid(spark, sf):
    items = json_payloads.valid_items(foundit_payloads(spark, sf))
    return items.groupBy("portal").agg(F.count("item").alias("items"))


@query("src_json_shine", f"""WITH {X.POSTINGS}
SELECT posting_ref AS job_id, {X.s_strip('job_title')} AS title, company, location, experience, salary,
       {X.s_strip('skills')} AS skills, {X.s_strip(X.s_squeeze("concat('Needs ', description, ' & more')"))} AS description,
       posted_date, 'shine' AS source
FROM (SELECT * REPLACE (coalesce(description, '') AS description) FROM postings)""")
def src_json_shine(spark, sf):
    item = F.struct(
        F.col("posting_ref").alias("id"), F.col("job_title").alias("jJT"), F.col("company").alias("jCName"),
        F.col("location").alias("jLoc"), F.col("experience").alias("jExp"), F.col("salary").alias("jSal"),
        F.col("skills").alias("jKwd"),
        F.concat(F.lit("<p>Needs<br/><b>"), T.blank("description"), F.lit("</b> &amp; more</p>")).alias("jJD"),
        F.col("posted_date").alias("jPDate"))
    payload = F.to_json(F.struct(F.array(item).alias("results"), F.lit(None).cast("string").alias("next")))
    return json_payloads.shine_rows(X.postings(spark, sf).select(payload.alias("payload"))).drop("industry")


@query("src_json_remoteok", f"""WITH {X.POSTINGS}
SELECT posting_ref AS job_id, job_title AS title, company, location, try_cast(salary AS double) AS salary_min,
       cast(NULL AS double) AS salary_max, skills, description, posted_date, 'remoteok' AS source FROM postings""")
def src_json_remoteok(spark, sf):
    item = F.struct(
        F.col("posting_ref").alias("id"), F.col("job_title").alias("position"), "company", "location",
        F.col("salary").try_cast("double").alias("salary_min"), F.split("skills", ",").alias("tags"),
        "description", F.col("posted_date").alias("date"))
    payload = F.concat(F.lit('[{"legal":"terms"},'), F.to_json(item), F.lit("]"))
    return json_payloads.remoteok_rows(X.postings(spark, sf).select(payload.alias("payload")))


@query("src_coerce_text", f"""WITH {X.POSTINGS}
SELECT posting_ref, CASE WHEN experience IS NULL THEN array_to_string(string_split(skills, ', '), ', ')
       ELSE {X.s_strip('job_title')} END AS value FROM postings""")
def src_coerce_text(spark, sf):
    raw = F.when(F.col("experience").isNull(), F.to_json(F.split("skills", ", "))).otherwise(F.col("job_title"))
    p = X.postings(spark, sf).select("posting_ref", raw.alias("raw"))
    return p.select("posting_ref", T.coerce_text("raw").alias("value"))


# --- pages and cards -----------------------------------------------------------------


def s_html_text(c: str) -> str:
    for pattern in (r"(?s)<!--.*?-->", r"(?is)<script.*?</script>", r"(?is)<style.*?</style>",
                    r"(?is)<template.*?</template>", r"<[^>]*>"):
        c = f"regexp_replace({c}, '{pattern}', ' ', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        c = f"replace({c}, '{entity}', '{char}')"
    return X.s_strip(X.s_squeeze(c))


@query("src_html_text", f"SELECT page_id, {s_html_text('html')} AS page_text FROM pages")
def src_html_text(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", T.html_text("html").alias("page_text"))


@query("src_html_fields", f"""WITH base AS (
  SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS base,
         regexp_extract_all(html, '(?s)<title>(.*?)</title>', 1)[1] AS title,
         regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1)[1] AS heading,
         regexp_extract_all(html, '<li>\\s*(<a href="[^"]*">[^<]*</a>)', 1) AS items FROM pages), rows AS (
  SELECT page_id, base, title, heading, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS position FROM base)
SELECT page_id, {s_html_text('title')} AS title, {s_html_text('heading')} AS heading, cast(position AS integer) AS position,
       {s_html_text('item')} AS label, concat(base, regexp_extract(item, 'href="([^"]*)"', 1)) AS link FROM rows""")
def src_html_fields(spark, sf):
    pages = X.table(spark, sf, "pages").withColumn("base", F.regexp_extract("url", "^(https?://[^/]+)", 1))
    return web_pages.page_items(pages.drop("url"), "html", F.col("base")).drop("base")


PAGE_ORDERS = 200_000  # orders whose postings share a page
# A posting in the portal's markup: classes among others, nested blocks and tags.
_MARKUP = """concat('<div class="box individual_internship visible" internshipid="', posting_ref, '">',
  '<div class="individual_internship_header"><a class="big job-title-href" href="/job/', posting_ref, '"> ', trim(job_title), ' </a>',
  '<p class="company-name">', coalesce(company, 'nobody'), '</p></div><div class="individual_internship_details">',
  '<p class="row-1-item locations"><span>', coalesce(location, ''), '</span></p></div>',
  '<div class="not_job_skill">none</div><div class="job_skill"><span>', source, '</span> ', coalesce(experience, '-'), '</div>',
  '<div class="job_skill">two</div></div>')"""


@query("src_html_cards", f"""WITH {X.POSTINGS}
SELECT posting_ref AS job_id, trim(job_title) AS job_title, coalesce(company, 'nobody') AS company,
       coalesce(location, '') AS location, concat(source, ' ', coalesce(experience, '-'), ',two') AS skills,
       concat('https://internshala.com/job/', posting_ref) AS job_url
FROM (SELECT * REPLACE (regexp_replace(job_title, ' +', ' ', 'g') AS job_title) FROM postings)""")
def src_html_cards(spark, sf):
    cards = web_pages.card_fields(web_pages.page_cards(card_pages(spark, sf), "html"))
    return cards.select("job_id", "job_title", "company", "location", "skills", "job_url")


def card_pages(spark, sf):
    """(html): a page for each portal, company and run of orders, so none grows with the tables.

    A page is one value in a task: postings without company alone would fill one of all their cards.
    """
    order = F.split_part("posting_ref", F.lit("-"), F.lit(1)).cast("bigint")
    pages = X.postings(spark, sf).groupBy("source", "company", F.floor(order / PAGE_ORDERS)).agg(
        F.concat(F.lit("<html><body>"), F.array_join(F.collect_list(F.expr(_MARKUP)), ""), F.lit("</body></html>")).alias("html"))
    return pages.select("html")


def cards(spark, sf):
    """Text cards: title, company, optional experience, salary and place, skills, date."""
    p = X.postings(spark, sf)
    place = F.when(F.col("location").isNotNull(), F.concat(F.lit("Remote "), "location"))
    posted = F.concat(F.substring("posted_date", 9, 2), F.lit(" Days Ago"))
    lines = F.concat_ws("\n", "job_title", "company", "experience", "salary", place, F.lit("  "), "skills", posted)
    return p.select("posting_ref", lines.alias("card"))


def _first(words, used, low="x.low"):
    tests = " OR ".join(f"contains({low}, {X.quoted(w)})" for w in words)
    return f"({tests})" + "".join(f" AND NOT coalesce(x.i = {u}, false)" for u in used)


def _pick(words, used, at):
    return f"list_filter(numbered, lambda x: {_first(words, used)})[{at}]"


@query("src_card_lines", f"""WITH {X.POSTINGS}, texts AS (
  SELECT posting_ref, concat_ws(chr(10), job_title, company, experience, salary, 'Remote ' || location, '  ', skills,
         concat(substr(posted_date, 9, 2), ' Days Ago')) AS card FROM postings), lined AS (
  SELECT posting_ref, list_filter(list_transform(string_split(card, chr(10)), lambda t: {X.s_strip('t')}), lambda t: t <> '') AS lines
  FROM texts), n0 AS (
  SELECT *, list_transform(lines, lambda t, k: {{'i': k, 'line': t, 'low': lower(t)}}) AS numbered FROM lined), n1 AS (
  SELECT *, {_pick(D.CARD_EXPERIENCE, [], 1)} AS e FROM n0), n2 AS (
  SELECT *, e.i AS ei, {_pick(D.CARD_SALARY, ['e.i'], 1)} AS s FROM n1), n3 AS (
  SELECT *, {_pick(D.CARD_CITIES, ['e.i', 's.i'], 1)} AS l FROM n2), n4 AS (
  SELECT *, {_pick(D.CARD_POSTED, ['e.i', 's.i', 'l.i'], -1)} AS p FROM n3)
SELECT posting_ref, lines[1] AS title, lines[2] AS company, l.line AS location, e.line AS experience, s.line AS salary,
       CASE WHEN len(lines) >= 3 AND NOT contains(lower(lines[-2]), 'ago') THEN lines[-2] END AS skills,
       CASE WHEN len(lines) >= 4 THEN lines[-3] END AS description, p.line AS posted_date FROM n4""")
def src_card_lines(spark, sf):
    return web_pages.card_lines(cards(spark, sf), "card").drop("card")


# --- sinks ---------------------------------------------------------------------------


@query("sink_table", f"""WITH {X.GOLD}
SELECT job_id, job_title, company, role_category, skill_count, salary_avg, source FROM gold""")
def sink_table(spark, sf):
    path = scratch_path(spark, "gold")
    gold = X.gold(spark, sf).select(
        "job_id", "job_title", "company", "role_category", "skill_count", "salary_avg", "source")
    sinks.write_table(gold, path, ["source"])
    return spark.read.schema(gold.schema).parquet(path)


@query("sink_bi_export", f"""WITH {X.GOLD}
SELECT role_category, cast(job_count AS varchar) AS job_count,
       cast({X.s_round(f'job_count / {M.TOTAL} * 100')} AS varchar) AS demand_percent FROM ({M.counts('role_category')})""")
def sink_bi_export(spark, sf):
    root = scratch_path(spark, "bi")
    gold = X.gold_table(spark, sf)
    tables = G.bi_tables(gold)
    for name, mart in tables.items():
        sinks.write_bi_csv(mart, f"{root}/{name}", one_file=name != "job_overview")
    return csv_files.read_or_gz(spark, f"{root}/role_demand", S.strings(tables["role_demand"].columns))


@query("sink_role_partition", f"""WITH {C._MATCHES}
SELECT category, searched_role, job_id, title, company FROM matches""")
def sink_role_partition(spark, sf):
    path = scratch_path(spark, "roles")
    rows = C.matches(spark, sf).select("job_id", "title", "company", "category", "searched_role")
    sinks.write_by_role(rows, path)
    return csv_files._options(spark.read.schema(rows.schema), True).csv(path)


@query("sink_batch_append", f"""WITH {X.POSTINGS}
SELECT posting_ref, company, CASE WHEN source = 'portal_0' THEN '20260101_000000' ELSE '20260102_000000' END AS batch_ts
FROM postings""")
def sink_batch_append(spark, sf):
    path = scratch_path(spark, "appended")
    p = X.postings(spark, sf).select("posting_ref", "company", "source")
    sinks.append_batch(p.filter("source = 'portal_0'").drop("source"), path, "20260101_000000")
    sinks.append_batch(p.filter("source <> 'portal_0'").drop("source"), path, "20260102_000000")
    return csv_files._options(
        spark.read.schema("posting_ref string, company string, batch_ts string"), True).csv(path)


# --- audits --------------------------------------------------------------------------


@query("rep_silver_audit", f"""WITH {M._SILVER_METRICS}, per_source AS (
  SELECT source, 'success' AS status, cast(count(*) AS bigint) AS raw_count FROM postings GROUP BY source)
SELECT per_source.*, metrics.* FROM per_source CROSS JOIN metrics""")
def rep_silver_audit(spark, sf):
    rows, bad, headers = csv_files.read_tree(spark, raw_tree(spark, sf), N.standardise_silver)
    audit = csv_files.file_audit(headers, rows, bad)
    per_source = audit.groupBy("source", "status").agg(F.sum("raw_count").alias("raw_count"))
    return joins.attach_metrics(per_source, reports.silver_metrics(rows.drop("file_path")))


@query("rep_file_shapes", f"""WITH {X.POSTINGS}
SELECT source, cast(10 AS bigint) AS columns, cast(count(*) AS bigint) AS rows FROM postings GROUP BY source""")
def rep_file_shapes(spark, sf):
    rows, bad, headers = csv_files.read_tree(spark, raw_tree(spark, sf), N.standardise_silver)
    files = csv_files.file_audit(headers, rows, bad)
    # File names differ between runs, so the shapes are summed per portal here.
    return files.groupBy("source", "columns").agg(F.sum("raw_count").alias("rows"))


# --- streams -------------------------------------------------------------------------


# A row with a field too many, for the last portal's folder.
_BAD_BATCH = "job_id,title\n1,a,b\n"


def _batch_folder(spark, sf):
    """A growing folder: one batch per portal, each with its own column order, and a bad row."""
    root = scratch_path(spark, "arriving")
    rows = materialize(C.master(spark, sf), "master")
    for i, portal in enumerate(PORTALS):
        columns = rows.columns[2 * i:] + rows.columns[:2 * i]
        sinks.csv_writer(rows.filter(F.col("source") == portal).select(columns)).csv(f"{root}/{portal}")
    spark.createDataFrame([(_BAD_BATCH,)], "value string").coalesce(1).write.text(f"{root}/portal_bad")
    return root, rows.schema


@query("stm_landing", f"""WITH {C._MASTER}
SELECT source, cast(count(*) AS bigint) AS rows, cast(count(company) AS bigint) AS companies,
       cast(0 AS bigint) AS bad_rows FROM master GROUP BY source
UNION ALL SELECT 'portal_bad', 0, 0, 1""")
def stm_landing(spark, sf):
    root, schema = _batch_folder(spark, sf)
    table, checkpoint, rejects = (scratch_path(spark, n) for n in ("landed", "progress", "rejects"))
    stream.land(stream.read_batches(spark, root, max_files=10), table, checkpoint, rejects, N.standardise_master)
    landed = spark.read.schema(schema).parquet(table)
    counts = landed.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count("company").alias("companies"))
    files = spark.read.parquet(f"{rejects}/files")
    bad = files.groupBy("source").agg(F.sum("bad_rows").alias("bad_rows"))
    return bad.join(counts, "source", "left").na.fill(0).select("source", "rows", "companies", "bad_rows")


@query("stm_upsert_last", C.LAST_ID)
def stm_upsert_last(spark, sf):
    root, schema = _batch_folder(spark, sf)
    log, checkpoint, rejects = (scratch_path(spark, n) for n in ("log", "progress", "rejects"))
    arriving = stream.read_batches(spark, root, max_files=10)
    stream.upsert_last(arriving, log, checkpoint, rejects, N.standardise_master, ["job_id"], "scraped_at")
    return stream.current(spark, log, schema, ["job_id"], "scraped_at")
