"""Vector search, prompt screening and context queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancia import dictionaries as D
from vacancia.catalog import cleaning as C, fixtures as X, marts as M, matching
from vacancia.catalog.registry import query
from vacancia.functions import text as T, vectors as V
from vacancia.operators import context, gap, nearest, screening
from vacancia.plans import gold as G, matching as plan, questions

# Scaled copies, so that normalising has something to do.
_SCALED = "list_transform(embedding, lambda x: x::double * (label + 1))"
_NORM = f"sqrt(list_sum(list_transform({_SCALED}, lambda y: y * y)))"


@query("vec_normalize", f"""WITH n AS (SELECT vec_id, {_SCALED} AS v, {_NORM} AS length FROM embeddings)
SELECT vec_id, generate_subscripts(v, 1) - 1 AS position, {X.s_round('unnest(v) / length', 6)} AS value FROM n""")
def vec_normalize(spark, sf):
    scaled = F.transform(V.doubles("embedding"), lambda x: x * (F.col("label") + 1))
    e = X.table(spark, sf, "embeddings").select("vec_id", V.normalize(scaled).alias("v"))
    # A bigint position, as list subscripts are in the other engine.
    out = e.select("vec_id", F.posexplode("v").alias("position", "value"))
    return out.select("vec_id", F.col("position").cast("bigint").alias("position"), T.rounded("value", 6).alias("value"))


_PAIRS = f"""scores AS (
  SELECT q.vec_id AS query_id, d.vec_id AS doc_id,
         {X.s_round('list_inner_product(q.embedding::double[], d.embedding::double[])', 6)} + 0.0 AS score
  FROM embeddings q, embeddings d)"""


_TOP_FIVE = f"""WITH {_PAIRS}
SELECT query_id, doc_id, {X.s_round('score', 4)} + 0.0 AS score,
       cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS integer) AS rank
FROM scores QUALIFY rank <= 5"""


@query("vec_topk", _TOP_FIVE)
def vec_topk(spark, sf):
    e = X.table(spark, sf, "embeddings")
    best = nearest.top_vectors(e, e, "vec_id", "vec_id", "embedding", 5)
    return best.select(F.col("q_id").alias("query_id"), F.col("d_id").alias("doc_id"),
                       T.rounded("score", 4).alias("score"), "rank")


# The hundred that are scored exactly hold the exact five of every query of the given table.
@query("vec_topk_approx", _TOP_FIVE)
def vec_topk_approx(spark, sf):
    e = X.table(spark, sf, "embeddings")
    best = nearest.top_vectors_approx(e, e, "vec_id", "vec_id", "embedding", 5)
    return best.select(F.col("q_id").alias("query_id"), F.col("d_id").alias("doc_id"),
                       T.rounded("score", 4).alias("score"), "rank")


def s_hashed(name: str, counts: str, key: str) -> str:
    """CTE ``name``: term counts hashed to the encoder's cells."""
    return f"""{name} AS MATERIALIZED (
  SELECT {key}, cast(cast(concat('0x', md5(term)[1:8]) AS bigint) % {questions.DIMENSIONS} AS varchar) AS term, sum(tf) AS tf
  FROM {counts} GROUP BY ALL)"""


# The encoder fitted on all documents, and the documents' vectors.
_ENCODED = f"""{matching.s_counts('doc_counts', 'documents', 'doc_id', 'text')}, {s_hashed('doc_cells', 'doc_counts', 'doc_id')},
vocab AS MATERIALIZED (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1 AS idf FROM doc_cells GROUP BY term),
{matching.s_weights('w', 'doc_cells', 'doc_id')}"""


def encoder(spark, sf):
    return questions.Encoder.fit(X.table(spark, sf, "documents"), "doc_id", "text", X.STOPS)


@query("vec_from_text", f"WITH {_ENCODED} SELECT doc_id, term, {X.s_round('weight', 6)} AS weight FROM w")
def vec_from_text(spark, sf):
    docs = X.table(spark, sf, "documents")
    return encoder(spark, sf).weights(docs, "doc_id", "text").withColumn("weight", T.rounded("weight", 6))


# --- screening ------------------------------------------------------------------------

# A pattern that does occur in these texts, next to the real one.
REGEX = D.INJECTION_REGEX[:-1] + "|nicht|thing)"
# Blank some prompts by data: short assistant turns stand for empty input.
_PROMPTS = """prompts AS (
  SELECT conv_id, turn, CASE WHEN length(text) < 60 THEN '  ' ELSE text END AS prompt FROM conversations)"""


def prompts(spark, sf):
    c = X.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.when(F.length("text") < 60, "  ").otherwise(F.col("text")).alias("prompt"))


def _regex_reason(c):
    return f"CASE WHEN regexp_matches({c}, '(?i){REGEX}') THEN {X.quoted(D.REASON_REGEX)} END"


def _blank_reason(c):
    return f"CASE WHEN {X.s_strip(f'''coalesce({c}, '')''')} = '' THEN {X.quoted(D.REASON_BLANK)} END"


@query("scr_regex", f"""WITH {_PROMPTS}
SELECT conv_id, turn, {_blank_reason('prompt')} IS NULL AND {_regex_reason('prompt')} IS NULL AS is_safe,
       coalesce({_blank_reason('prompt')}, {_regex_reason('prompt')}, '') AS reason FROM prompts""")
def scr_regex(spark, sf):
    return screening.verdict(prompts(spark, sf), "prompt", regex=REGEX).drop("prompt")


# Pattern vectors: the mean direction of every label.
_PATTERNS = f"""cells AS (
  SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::double AS x FROM embeddings), means AS (
  SELECT label, i, avg(x) AS x FROM cells GROUP BY ALL), patterns AS (
  SELECT label AS pattern_id, list(x ORDER BY i) AS v FROM means GROUP BY label), likeness AS (
  SELECT e.vec_id, max({X.s_round('list_inner_product(e.embedding::double[], p.v) / sqrt(list_inner_product(p.v, p.v))', 6)}) AS max_similarity
  FROM embeddings e, patterns p GROUP BY e.vec_id)"""
THRESHOLD = 0.3


def similarities(spark, sf):
    """(vec_id, max_similarity) of every embedding to the label patterns."""
    e = X.table(spark, sf, "embeddings")
    cells = e.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # One value per dimension: the list is as long as the vectors are.
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    patterns = means.groupBy(F.col("label").alias("pattern_id")).agg(
        V.normalize(F.transform(ordered, lambda c: c["x"])).alias("embedding"))
    return screening.nearest_pattern(e, patterns, "vec_id", "embedding")


@query("scr_similarity", f"""WITH {_PATTERNS}
SELECT vec_id, {X.s_round('max_similarity', 4)} AS max_similarity, max_similarity < {THRESHOLD} AS is_safe FROM likeness""")
def scr_similarity(spark, sf):
    s = similarities(spark, sf)
    return s.select("vec_id", T.rounded("max_similarity", 4).alias("max_similarity"),
                    screening.reason_similarity("max_similarity", THRESHOLD).isNull().alias("is_safe"))


_SIM_BEFORE, _SIM_AFTER = D.REASON_SIMILAR.split("{score}")
_SIM_REASON = (f"CASE WHEN max_similarity >= {THRESHOLD} THEN concat({X.quoted(_SIM_BEFORE)}, "
               f"printf('%.2f', max_similarity), {X.quoted(_SIM_AFTER)}) END")
_REASON = f"coalesce({_blank_reason('prompt')}, {_regex_reason('prompt')}, {_SIM_REASON})"


# Prompts are encoded like the documents; words of their own language stand for the unsafe patterns.
UNSAFE = ["nd the of in and to", "de la que en ciónes", "der die und ein zu"]
LIKE = 0.2
_UNSAFE = f"unsafe AS (SELECT * FROM (VALUES {', '.join(f'({i}, {X.quoted(t)})' for i, t in enumerate(UNSAFE))}) t(pattern_id, pattern))"


def s_likeness(frame: str, key: str, text: str) -> str:
    """CTEs up to ``likeness``: (key, max_similarity) of a frame's texts to the patterns."""
    return f"""{matching.s_counts('a_counts', frame, key, text)}, {s_hashed('a_cells', 'a_counts', key)}, {matching.s_weights('asked', 'a_cells', key)},
{_UNSAFE}, {matching.s_counts('u_counts', 'unsafe', 'pattern_id', 'pattern')}, {s_hashed('u_cells', 'u_counts', 'pattern_id')},
{matching.s_weights('u', 'u_cells', 'pattern_id')}, likeness AS (
  SELECT {key}, max(score) AS max_similarity FROM (
    SELECT {key}, pattern_id, {X.s_round('sum(asked.weight * u.weight)', 6)} AS score FROM asked JOIN u USING (term) GROUP BY ALL) GROUP BY {key})"""


def _reason(text: str) -> str:
    similar = (f"CASE WHEN coalesce(max_similarity, 0) >= {LIKE} THEN concat({X.quoted(_SIM_BEFORE)}, "
               f"printf('%.2f', max_similarity), {X.quoted(_SIM_AFTER)}) END")
    return f"coalesce({_blank_reason(text)}, {_regex_reason(text)}, {similar})"


_SIM_BEFORE, _SIM_AFTER = D.REASON_SIMILAR.split("{score}")
_SCREEN = {"patterns": UNSAFE, "regex": REGEX, "threshold": LIKE}


@query("scr_verdict", f"""WITH {_PROMPTS}, named AS (SELECT concat(conv_id, '/', turn) AS prompt_id, * FROM prompts), {_ENCODED},
{s_likeness('named', 'prompt_id', 'prompt')}, judged AS (
  SELECT conv_id, turn, {_reason('prompt')} AS reason FROM named LEFT JOIN likeness USING (prompt_id))
SELECT conv_id, turn, reason IS NULL AS is_safe, coalesce(reason, '') AS reason FROM judged""")
def scr_verdict(spark, sf):
    named = prompts(spark, sf).withColumn("prompt_id", F.concat(
        F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")))
    coder = encoder(spark, sf)
    asked = coder.vectors(named, "prompt_id", "prompt")
    out = questions.screened(coder, named, asked, "prompt_id", "prompt", **_SCREEN)
    return out.select("conv_id", "turn", "is_safe", "reason")


# --- contexts --------------------------------------------------------------------------


@query("ctx_meta", f"""WITH {X.GOLD}
SELECT job_id, coalesce(job_title, '') AS title, coalesce(company, '') AS company, coalesce(location, '') AS location,
       coalesce(skills, '') AS skills, coalesce(source, '') AS source, {C.DOCUMENT_V3} AS document_text FROM gold""")
def ctx_meta(spark, sf):
    gold = X.gold(spark, sf)
    return context.metadata(gold.withColumn("document_text", G.document_v3()))


# All documents are the collection, benchmark items the questions.
_BLOCKS = """blocks AS (
  SELECT item_id, rank, concat(chr(10), 'Job ', cast(rank AS varchar), chr(10), 'Title: ', coalesce(lang, ''), chr(10), 'Company: ',
         coalesce(source, ''), chr(10), 'Location: ', chr(10), 'Skills: ', chr(10), 'Description:', chr(10), coalesce(text, ''), chr(10)) AS block
  FROM ranked_docs JOIN documents USING (doc_id)), contexts AS (
  SELECT item_id, string_agg(block, '' ORDER BY rank) AS context FROM blocks GROUP BY item_id)"""
_PROMPT = """concat(chr(10), 'JOB MARKET CONTEXT:', chr(10), context, chr(10), chr(10), 'USER QUESTION:', chr(10), question, chr(10))"""
_ASKED = "items AS (SELECT item_id, text AS question FROM benchmark)"


def _index(spark, sf, coder):
    docs = X.table(spark, sf, "documents").select(
        "doc_id", F.col("lang").alias("title"), F.col("source").alias("company"), F.lit("").alias("location"),
        F.lit("").alias("skills"), F.col("text").alias("document_text"))
    return questions.index_rows(coder, docs, "doc_id", "document_text", "1")


def _items(spark, sf):
    return X.table(spark, sf, "benchmark").select("item_id", F.col("text").alias("question"))


@query("ctx_retrieval", f"""WITH {_ENCODED}, {_ASKED}, {matching.s_counts('q_counts', 'items', 'item_id', 'question')},
{s_hashed('q_cells', 'q_counts', 'item_id')}, {matching.s_weights('q', 'q_cells', 'item_id')},
{matching.s_ranked('q', 'w', 'item_id', 'doc_id', 5)}, {_BLOCKS}
SELECT item_id, question, context, {_PROMPT} AS prompt FROM contexts JOIN items USING (item_id)""")
def ctx_retrieval(spark, sf):
    coder = encoder(spark, sf)
    asked, index = coder.vectors(_items(spark, sf), "item_id", "question"), _index(spark, sf, coder)
    found = questions.retrieved(asked, index.select("doc_id", "terms", "weights"), "item_id", "doc_id", 5)
    return context.retrieval_context(
        found.join(index.drop("terms", "weights"), "doc_id").join(_items(spark, sf), "item_id"), "item_id", "question")


@query("ctx_answer", f"""WITH {_ENCODED}, {_ASKED}, {s_likeness('items', 'item_id', 'question')}, judged AS (
  SELECT item_id, question, {_reason('question')} AS reason FROM items LEFT JOIN likeness USING (item_id)), q AS (
  SELECT asked.* FROM asked JOIN judged USING (item_id) WHERE reason IS NULL),
{matching.s_ranked('q', 'w', 'item_id', 'doc_id', 5)}, {_BLOCKS}
SELECT item_id, question, reason IS NULL AS is_safe, coalesce(reason, '') AS reason,
       CASE WHEN reason IS NULL THEN coalesce(context, '') END AS context,
       CASE WHEN reason IS NULL THEN {_PROMPT.replace(', context,', ", coalesce(context, ''),")} END AS prompt
FROM judged LEFT JOIN contexts USING (item_id)""")
def ctx_answer(spark, sf):
    coder = encoder(spark, sf)
    return questions.answer_prompts(
        coder, _index(spark, sf, coder), _items(spark, sf), "item_id", "question", "doc_id", 5, **_SCREEN)


def _block(heading, sql, key, n):
    return (f"(SELECT concat('{heading}', chr(10), string_agg(concat('- ', {key}, ': ', cast(job_count AS varchar), ' jobs'), "
            f"chr(10) ORDER BY job_count DESC, {key})) FROM (SELECT * FROM ({sql}) ORDER BY job_count DESC, {key} LIMIT {n}))")


_GAP = f"""{X.ranked_skills(20)}, statuses AS (
  SELECT profile_id, target_role, r.role_category AS market_role, skill, skill_rank, job_count,
         ({M._IN_LIST} OR {M._IN_TEXT} OR {M._phrases()}) AS have
  FROM profiles JOIN ranked r ON {M._FALLBACK}), gaps AS (
  SELECT profile_id, any_value(target_role) AS role, any_value(market_role) AS market_role,
         {X.s_round('coalesce(sum(job_count) FILTER (have), 0) / sum(job_count) * 100')} AS match_score,
         string_agg(skill, ', ' ORDER BY skill_rank) FILTER (have AND have_rank <= 10) AS available,
         string_agg(skill, ', ' ORDER BY skill_rank) FILTER (NOT have AND have_rank <= 10) AS missing
  FROM (SELECT *, row_number() OVER (PARTITION BY profile_id, have ORDER BY skill_rank) AS have_rank FROM statuses)
  GROUP BY profile_id)"""


@query("ctx_market", f"""{matching._JOBS}, {X.PROFILES}, {_GAP}, asked AS (
  SELECT profile_id, concat(target_role, ' ', profile_text) AS ask FROM profiles),
{matching.s_counts('p_counts', 'asked', 'profile_id', 'ask')}, {matching.s_weights('q', 'p_counts', 'profile_id')},
{matching.s_ranked('q', 'w', 'profile_id', 'job_id', 5)}, listed AS (
  SELECT profile_id, string_agg(concat('- ', coalesce(job_title, ''), ' at ', coalesce(company, ''), ', match score ',
         cast({X.s_round('score * 100')} AS varchar)), chr(10) ORDER BY rank) AS recommended
  FROM ranked_docs JOIN gold USING (job_id) GROUP BY profile_id)
SELECT profile_id, concat_ws(chr(10),
  concat('Total cleaned job records: ', cast((SELECT count(*) FROM gold) AS varchar)),
  {_block('Role demand:', M.counts('role_category'), 'role_category', 7)},
  {_block('Top market skills:', M.SKILL_COUNTS, 'skill', 10)},
  {_block('Top hiring companies:', M.counts('company'), 'company', 10)},
  'Predicted best role for user: ' || role,
  'Market jobs analyzed for predicted role: ' || cast(role_market_jobs AS varchar),
  'Profile match: ' || cast(match_score AS varchar) || '%',
  'Available skills: ' || nullif(available, ''), 'Missing skills: ' || nullif(missing, ''),
  'Recommended jobs:' || chr(10) || recommended) AS context
FROM gaps JOIN role_market ON role_category = market_role LEFT JOIN listed USING (profile_id)""")
def ctx_market(spark, sf):
    gold = X.gold_table(spark, sf)
    rows = M.gap_rows(spark, sf, 20, "fallback", "either", gold)
    owned = F.col("status") == "Available"
    scores = gap.gap_scores(rows, "job_count").select("profile_id", "match_score")
    lists = rows.groupBy("profile_id").agg(
        F.first("target_role").alias("role"), F.first("role_market_jobs").alias("role_market_jobs"),
        gap.skill_list(owned, 10).alias("available"), gap.skill_list(~owned, 10).alias("missing"))
    asked = X.profiles(spark, sf).withColumn("ask", F.concat("target_role", F.lit(" "), "profile_text"))
    rec = plan.Recommender(gold, X.STOPS, matching.MAX_FEATURES, min_df=2)
    listed = plan.recommended_lines(rec.recommend(asked, "ask", 5))
    profiles = scores.join(lists, "profile_id").join(listed, "profile_id", "left")
    return context.market_context(gold, profiles)


@query("ctx_history", "SELECT conv_id, turn, role, text AS content FROM conversations ORDER BY conv_id, turn")
def ctx_history(spark, sf):
    return context.history(X.table(spark, sf, "conversations"))
