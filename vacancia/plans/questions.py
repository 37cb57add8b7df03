"""Question flow: an encoder, a document index, screening, retrieval, prompts."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from vacancia import dictionaries as D
from vacancia.functions import vectors as V
from vacancia.operators import context, dedup, nearest, screening, tfidf
from vacancia.operators.reshape import explode_items
from vacancia.session import materialize

DIMENSIONS = 1 << 14


class Encoder:
    """Hashed TF-IDF: texts of any table meet in one space of ``dimensions`` cells.

    The fitted model is the table (term, df, idf) of the cells in use; store it with any
    writer and pass it back as ``model``.
    """

    def __init__(self, model: DataFrame, stop_words=(), dimensions: int = DIMENSIONS):
        self.model, self.stop_words, self.dimensions = model, stop_words, dimensions

    @classmethod
    def fit(cls, docs: DataFrame, doc_id: str, text: str, stop_words=(), dimensions: int = DIMENSIONS):
        counts = tfidf.hashed_counts(docs, doc_id, text, dimensions, stop_words)
        n_docs = docs.select(F.count(F.lit(1))).scalar()
        model = tfidf.vocabulary_of(counts, n_docs, max_features=None, min_df=1)
        return cls(materialize(model.withColumn("term", F.col("term").cast("string")), "encoder"), stop_words, dimensions)

    @cached_property
    def _idf(self) -> Column:
        """The idf of every cell as one constant array (``dimensions`` numbers), NaN where the model has none."""
        idf = ["NaN"] * self.dimensions
        for r in self.model.select("term", "idf").collect():  # a row a cell at most
            idf[int(r.term)] = repr(r.idf)
        return F.split(F.lit(",".join(idf)), ",").cast("array<double>")

    def encoded(self, df: DataFrame, row_id: str, text: str) -> DataFrame:
        """``df`` with ``terms`` (cell numbers) and ``weights`` of unit length, NULL without a known term.

        Worked out inside the row: texts move once, their terms never.
        """
        rows = tfidf.hashed_rows(df, row_id, text, self.dimensions, self.stop_words)
        weighed = F.transform("_cells", lambda c: F.struct(
            c["term"].alias("term"), (c["tf"] * F.get(self._idf, c["term"])).alias("weight")))
        rows = rows.select(*df.columns, F.filter(weighed, lambda c: ~F.isnan(c["weight"])).alias("_w"))
        length = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda s, c: s + c["weight"] * c["weight"]))
        there = F.size("_w") > 0
        return rows.select(*df.columns, F.when(there, F.col("_w.term")).alias("terms"), F.when(there, V.once(
            length, lambda n: F.transform("_w", lambda c: c["weight"] / n))).alias("weights"))

    def weights(self, df: DataFrame, row_id: str, text: str) -> DataFrame:
        """(row_id, term, weight) of unit length."""
        rows = self.encoded(df.select(row_id, text), row_id, text)
        pairs = explode_items(rows, [row_id], F.arrays_zip("terms", "weights"), "_p")
        return pairs.select(row_id, F.col("_p.terms").cast("string").alias("term"), F.col("_p.weights").alias("weight"))

    def vectors(self, df: DataFrame, row_id: str, text: str) -> DataFrame:
        """(row_id, terms, weights) of the rows with a known term, stored."""
        rows = self.encoded(df.select(row_id, text), row_id, text).select(row_id, "terms", "weights")
        # Filtered when stored: a filter on computed arrays would be pushed down to the text and cut it again.
        return materialize(rows, "vectors").filter("terms IS NOT NULL")


def index_rows(encoder: Encoder, documents: DataFrame, key: str, text: str, stamp: str) -> DataFrame:
    """Documents with their vectors, stored; every column stays as metadata."""
    return materialize(encoder.encoded(documents, key, text).withColumn("stamp", F.lit(stamp)), "index")


def refreshed(index: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The index with changed documents replaced and new ones added, by id and stamp."""
    return dedup.upsert(index, changes, key, "stamp")


def unsafe_likeness(encoder: Encoder, asked: DataFrame, question_id: str, patterns=None) -> DataFrame:
    """(question_id, max_similarity) to the closest unsafe pattern, 0 without a common term.

    ``asked`` are vectors; ``patterns`` a list of texts, the shipped ones by default.
    """
    spark = asked.sparkSession
    rows = spark.createDataFrame(list(enumerate(D.UNSAFE_PATTERNS if patterns is None else patterns)),
                                 "pattern_id int, pattern string")
    best = nearest.top_documents(asked, encoder.vectors(rows, "pattern_id", "pattern"), question_id, "pattern_id", 1)
    return best.select(F.col("q_id").alias(question_id), F.col("score").alias("max_similarity"))


def screened(encoder: Encoder, questions: DataFrame, asked: DataFrame, question_id: str, question: str,
             patterns=None, regex: str = D.INJECTION_REGEX, threshold: float = D.SIMILARITY_THRESHOLD) -> DataFrame:
    """``questions`` with ``is_safe`` and ``reason``, judged by their own vectors."""
    scored = materialize(unsafe_likeness(encoder, asked, question_id, patterns), "likeness")
    judged = questions.join(scored, question_id, "left").na.fill(0.0, ["max_similarity"])
    return screening.verdict(judged, question, "max_similarity", regex, threshold)


def retrieved(asked: DataFrame, index: DataFrame, question_id: str, key: str, k: int = 5) -> DataFrame:
    """(question_id, key, rank): the k closest documents of each question."""
    ranked = nearest.top_documents(asked, index, question_id, key, k)
    return materialize(ranked, "ranked").select(
        F.col("q_id").alias(question_id), F.col("d_id").alias(key), "rank")


def answer_prompts(encoder: Encoder, index: DataFrame, questions: DataFrame, question_id: str, question: str,
                   key: str, k: int = 5, **screen) -> DataFrame:
    """One row a question: verdict, and for safe ones the context and the prompt.

    ``index`` has the key, ``terms``, ``weights``, the metadata columns and
    ``document_text``. Unsafe questions are not searched; safe ones that match no document
    get a prompt without documents.
    """
    asked = encoder.vectors(questions, question_id, question)
    judged = materialize(screened(encoder, questions, asked, question_id, question, **screen), "judged")
    safe = judged.filter("is_safe")
    found = retrieved(asked.join(safe.select(question_id), question_id, "left_semi"),
                      index.filter("terms IS NOT NULL").select(key, "terms", "weights"), question_id, key, k)
    shown = index.select(key, "title", "company", "location", "skills", "document_text")
    contexts = context.retrieval_context(
        found.join(shown, key).join(safe.select(question_id, question), question_id), question_id, question)
    out = judged.select(question_id, question, "is_safe", "reason").join(
        contexts.select(question_id, "context", "prompt"), question_id, "left")
    empty = context.question_prompt(F.lit(""), F.col(question))
    return out.withColumns({
        "context": F.when(F.col("is_safe"), F.coalesce("context", F.lit(""))),
        "prompt": F.when(F.col("is_safe"), F.coalesce("prompt", empty))})
