"""Recommender, advisor and role-classifier jobs for whole tables of profiles."""

from __future__ import annotations

from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from vacancia.functions import enrich as E, text as X
from vacancia.operators import classify as C, gap, nearest, tfidf
from vacancia.session import materialize

DISPLAY = ["job_title", "company", "location", "experience", "salary", "role_category",
           "skills", "job_url"]


class Recommender:
    """TF-IDF of the postings; ``recommend`` ranks postings for a table of profiles.

    Fitting writes the vocabulary (``max_features`` rows) once; ``vocabulary`` takes a
    stored one instead. Term counts are not written, and rows of terms are made for ``weights``
    only: texts are cut for the fit and for the vectors, where they are stored.
    """

    def __init__(
        self, jobs: DataFrame, stop_words=(), max_features: int = 7000, min_df: int = 2,
        vocabulary: DataFrame | None = None,
    ):
        self.jobs = jobs.withColumn("recommendation_text", X.recommendation_text())
        self.stop_words = stop_words
        self.counts = tfidf.term_counts(self.jobs, "job_id", "recommendation_text", stop_words)
        if vocabulary is None:
            n_docs = self.jobs.select(F.count(F.lit(1))).scalar()
            totals = tfidf.term_totals(self.jobs, "recommendation_text", stop_words)
            vocabulary = materialize(tfidf.vocabulary_of(totals, n_docs, max_features, min_df), "vocabulary")
        self.vocabulary = vocabulary

    @cached_property
    def terms(self) -> tfidf.Terms:
        return tfidf.Terms(self.vocabulary)

    def weights(self) -> DataFrame:
        return tfidf.weights_of(self.counts, "job_id", self.vocabulary)

    def vectors(self, keep=("job_id",), codes=None) -> DataFrame:
        """The same weights, a row a posting, terms by number."""
        return self.terms.vectors(self.jobs, keep, "recommendation_text", self.stop_words, codes=codes)

    def query_weights(self, profiles: DataFrame, text: str) -> DataFrame:
        return tfidf.transform(profiles, "profile_id", text, self.vocabulary, self.stop_words)

    def query_vectors(self, profiles: DataFrame, text: str, keep=("profile_id",)) -> DataFrame:
        return self.terms.vectors(profiles, keep, text, self.stop_words)

    def scores(self, profiles: DataFrame, text: str, n: int, role: str | None = None,
               rows_per_block: int = 20_000) -> DataFrame:
        """(profile_id, job_id, score, rank); with ``role`` only postings of that role."""
        cell = "cell_role" if role else None
        if role:
            profiles = profiles.withColumn(cell, F.col(role))
        asked = materialize(self.query_vectors(profiles, text, ["profile_id", *([cell] if role else [])]), "asked")
        # Only terms some profile uses can score: at most the vocabulary.
        used = [r.term for r in asked.select(F.explode("terms").alias("term")).distinct().collect()]
        jobs, cells = self.jobs, [cell] if role else []
        if role:  # roles are configuration; postings of no asked role are not read further
            jobs = jobs.withColumn(cell, F.col("role_category")).join(F.broadcast(asked.select(cell).distinct()), cell, "left_semi")
        # Not stored: worked out where they are stored as text, on their only way to the blocks.
        docs = self.terms.vectors(jobs, ["job_id", *cells], "recommendation_text", self.stop_words, codes=used)
        ranked = nearest.top_documents(
            asked, docs, "profile_id", "job_id", n, cell, rows_per_block, counted=jobs
        )
        # n rows a profile, stored: what joins them knows their size.
        ranked = materialize(ranked, "ranked")
        return ranked.withColumnsRenamed({"q_id": "profile_id", "d_id": "job_id"})

    def recommend(self, profiles: DataFrame, text: str, n: int = 10, role: str | None = None) -> DataFrame:
        """Ranked postings with a match percent and the display columns there are."""
        shown = [c for c in DISPLAY if c in self.jobs.columns]
        ranked = self.scores(profiles, text, n, role)
        return ranked.join(self.jobs.select("job_id", *shown), "job_id").withColumn(
            "match_percent", X.rounded(F.col("score") * 100)
        )


def train(
    df: DataFrame, text: str, label: str, key: str, max_features: int = C.MAX_FEATURES,
    stop_words=None, **settings,
):
    """Split, fit the shared features and hand back what every family needs."""
    # Stored: every fit and encoding below reads the rows again. ``df`` should be a stored table.
    rows = materialize(C.stratified_split(df.na.drop(subset=[text, label]), label, key, stored=True), "split")
    train_rows = C.balanced(rows.filter("NOT is_test"), label)
    features = C.fit_features(train_rows, text, max_features, stop_words=stop_words)
    indexer = C.label_index(train_rows, label)
    encode = PipelineModel([features, indexer])
    counter = next(s for s in features.stages if hasattr(s, "vocabulary"))
    size = len(counter.vocabulary)
    families = C.estimators(size, len(indexer.labels), train_rows.count(), **settings)
    return encode, indexer, families, train_rows, rows.filter("is_test")


def fit_family(encode, indexer, estimator, encoded_train: DataFrame) -> PipelineModel:
    """Text-in, role-out pipeline of one family."""
    model = estimator.fit(encoded_train)
    return PipelineModel([encode.stages[0], model, C.label_text(indexer)])


def predict(model: PipelineModel, profiles: DataFrame, text: str, fitted_text: str) -> DataFrame:
    """Predicted role per profile; the model reads the column it was fitted on."""
    kept = profiles.columns
    out = model.transform(profiles.withColumn(fitted_text, F.col(text)))
    return out.select(*kept, "predicted_role")


def recommended_lines(ranked: DataFrame) -> DataFrame:
    """(profile_id, recommended): a profile's ranked postings as text, n lines at most."""
    line = F.concat(
        F.lit("- "), X.blank("job_title"), F.lit(" at "), X.blank("company"),
        F.lit(", match score "), F.col("match_percent").cast("string"),
    )
    lines = F.sort_array(F.collect_list(F.struct("rank", line.alias("line"))))
    return ranked.groupBy("profile_id").agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("recommended")
    )


def advise(
    profiles: DataFrame, jobs: DataFrame, recommender: Recommender, role: str,
    top_skills: int = 15, top_jobs: int = 10,
) -> DataFrame:
    """One wide row per profile: role, gap, learning path and recommended postings."""
    targets = profiles.withColumns({
        "target_role": F.col(role), "profile_text": F.lower("profile_text"),
        "owned_skills": E.raw_tokens("profile_text"),
    })
    matched = gap.match_role(targets, jobs, "fallback")
    rows = gap.gap_rows(
        matched, gap.ranked_role_skills(jobs, top_skills, whole_market=True), "substring"
    )
    scores = rows.groupBy("profile_id").agg(
        X.percent(F.count_if(F.col("status") == "Available"), F.count(F.lit(1))).alias("match_score"),
        gap.skill_list(F.col("status") == "Available", top_skills).alias("available"),
        gap.skill_list(F.col("status") == "Missing", top_skills).alias("missing"),
        gap.skill_list(F.col("status") == "Missing", 5).alias("learning_path"),
    )
    asked = targets.withColumn("query", F.concat_ws(" ", "profile_text", "target_role"))
    listed = recommender.recommend(asked, "query", top_jobs, "target_role")
    listed = recommended_lines(listed)
    base = matched.select("profile_id", F.col("target_role").alias("role"), "role_market_jobs")
    return base.join(scores, "profile_id", "left").join(listed, "profile_id", "left").withColumn(
        "match_score", F.coalesce("match_score", F.lit(0.0))
    )
