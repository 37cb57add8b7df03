"""Multinomial naive Bayes in closed form: sums of term weights, no iteration.

A class's probability of a term is its smoothed share of the class's weights. A document adds
up ``weight * log p`` over its terms; terms that a class lacks all have the same probability
there, so a model row is what a term gains over that, and only terms that a class has are rows.
Classes are configuration-sized and read to the driver; terms and documents are not.

Documents may be rows of terms or vectors with numbered ``terms``. Vectors stay a row each: they are
summed by class where they lie, and judged in batches by a table of gains, terms by classes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from vacancia.operators.tfidf import listed
from vacancia.session import materialize

#: Digits of a score that count in the ranking of classes.
SCORE_PLACES = 9


class Model(NamedTuple):
    gains: DataFrame  # term, label, gain
    classes: list  # rows of label, prior, absent


def fit(weights: DataFrame, labels: DataFrame, vocabulary_size: int, key: str, label: str, smoothing: float = 1.0) -> Model:
    """The model of (key, term, weight) rows whose (key, label) are known.

    Keys without terms count for the prior of their class. Null labels are left out. Vectors
    carry their label themselves.
    """
    known = labels.filter(F.col(label).isNotNull()).select(key, F.col(label).alias("label"))
    if "terms" in weights.columns:
        of_class = listed(weights.filter(F.col(label).isNotNull()), label).withColumnRenamed(label, "label")
    else:
        of_class = weights.join(known, key)
    sums = materialize(of_class.groupBy("label", "term").agg(F.sum("weight").alias("s")), "class-terms")
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.join(sums.groupBy("label").agg(F.sum("s").alias("total")), "label", "left")
    below = F.coalesce("total", F.lit(0.0)) + F.lit(smoothing * vocabulary_size)
    every = Window.partitionBy(F.lit(0))  # over one row per class
    classes = totals.select("label", F.log(F.col("n") / F.sum("n").over(every)).alias("prior"), F.log(smoothing / below).alias("absent"))
    gains = sums.select("term", "label", F.log((F.col("s") + smoothing) / F.lit(smoothing)).alias("gain"))
    return Model(gains, classes.orderBy("label").collect())


def _judged(vectors: DataFrame, model: Model) -> DataFrame:
    """Vectors without their terms, with ``prediction``."""
    labels = [c.label for c in model.classes]
    prior, absent = (np.array([c[x] for c in model.classes]) for x in ("prior", "absent"))
    rows = model.gains.collect()  # terms of the vocabulary by classes
    gains = np.zeros((len(labels), 1 + max((r.term for r in rows), default=0)))
    for r in rows:
        gains[labels.index(r.label), r.term] = r.gain
    kept = vectors.drop("terms", "weights")
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField("prediction", T.StringType())])

    def judged(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            at, weight = (batch.column(c).flatten().to_numpy() for c in ("terms", "weights"))
            known = at < gains.shape[1]  # no class has a later term
            total = np.bincount(row, weight, len(sizes))
            scores = [prior[c] + total * absent[c] + np.bincount(row[known], weight[known] * gains[c, at[known]], len(sizes))
                      for c in range(len(labels))]
            best = np.round(scores, SCORE_PLACES).argmax(axis=0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(labels, pa.string()).take(pa.array(best))], schema.fieldNames())

    return vectors.mapInArrow(judged, schema)


def predict(weights: DataFrame, keys: DataFrame | None, model: Model, key: str) -> DataFrame:
    """``keys`` with ``prediction``, their likeliest class; ties go to the first label.

    Keys without a term of the vocabulary get the class of the highest prior. Vectors are their
    own keys: all columns but the terms and weights stay.
    """
    if "terms" in weights.columns:
        if not model.classes:
            return weights.drop("terms", "weights").withColumn("prediction", F.lit(None).cast("string"))
        return _judged(weights, model)
    absent = weights.groupBy(key).agg(F.sum("weight").alias("_sum"))
    gained = weights.join(model.gains, "term").groupBy(key, "label").agg(F.sum(F.col("weight") * F.col("gain")).alias("_gain"))
    if not model.classes:
        return keys.withColumn("prediction", F.lit(None).cast("string"))
    rows = F.array(*[F.struct(F.lit(c.label).alias("label"), F.lit(c.prior).alias("prior"), F.lit(c.absent).alias("absent"))
                     for c in model.classes])
    scored = keys.select(key).join(absent, key, "left").withColumn("_c", F.explode(rows)).select(
        key, F.col("_c.label").alias("label"),
        (F.col("_c.prior") + F.coalesce("_sum", F.lit(0.0)) * F.col("_c.absent")).alias("_base")).join(gained, [key, "label"], "left")
    score = F.round(F.col("_base") + F.coalesce("_gain", F.lit(0.0)), SCORE_PLACES)
    best = scored.groupBy(key).agg(F.min_by("label", F.struct(-score, "label")).alias("prediction"))
    return keys.join(best, key)
