"""Expressions over dense array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vacancia.functions.text import col, once


def doubles(v) -> Column:
    return col(v).cast("array<double>")


def dot(a, b) -> Column:
    products = F.zip_with(doubles(a), doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def normalize(v) -> Column:
    """Unit-length vector; the zero vector stays as it is."""
    length = F.nullif(norm(v), F.lit(0.0))
    scaled = once(length, lambda n: F.transform(doubles(v), lambda x: x / n))
    return F.when(length.isNotNull(), scaled).otherwise(doubles(v))


def max_cosine(v, patterns: list[list[float]]) -> Column:
    """Largest cosine with any of a short list of pattern vectors (configuration)."""
    literal = F.array(*[F.array(*[F.lit(float(x)) for x in p]) for p in patterns])
    length = norm(v)
    scores = F.transform(literal, lambda p: dot(v, p) / (norm(p) * length))
    return F.array_max(scores)
