"""Bring raw frames to the master or silver column lists; row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vacancia import schema as S
from vacancia.dictionaries import SALARY_BAND
from vacancia.functions import text as X


def _renamed(df: DataFrame, synonyms: dict, target: str, fold_case: bool) -> Column | None:
    """The value of ``target``: first non-null among the headers that mean it."""
    names = {c: (c.strip().lower() if fold_case else c) for c in df.columns}
    # A header that already has the target name goes first.
    sources = [c for c, n in names.items() if n == target]
    sources += [c for c, n in names.items() if n != target and synonyms.get(n) == target]
    if not sources:
        return None
    return F.coalesce(*[F.col(f"`{c}`").cast("string") for c in sources])


def _project(df, synonyms, columns, fold_case):
    out = []
    for name in columns:
        value = _renamed(df, synonyms, name, fold_case)
        out.append((F.lit(None).cast("string") if value is None else value).alias(name))
    return out


def _source(source) -> Column:
    return (F.lit(source) if isinstance(source, str) else source).alias("source")


def standardise_master(df: DataFrame, source, keep=()) -> DataFrame:
    """The 12 master columns; ``source`` (name or Column) replaces any own source.

    ``keep`` names further columns to carry along, such as the file path.
    """
    cols = _project(df, S.MASTER_SYNONYMS, S.MASTER_COLUMNS, fold_case=False)
    at = S.MASTER_COLUMNS.index("source")
    return df.select(*cols[:at], _source(source), *cols[at + 1:], *keep)


def standardise_silver(df: DataFrame, source, keep=()) -> DataFrame:
    """The nine silver columns plus ``source``; headers compare lower-cased, stripped."""
    cols = _project(df, S.SILVER_SYNONYMS, S.SILVER_COLUMNS, fold_case=True)
    return df.select(*cols, _source(source), *keep)


def by_name(schema):
    """A standardiser to the columns of ``schema``, found by name; others are NULL."""

    def standardise(df: DataFrame, source, keep=()) -> DataFrame:
        cols = _project(df, {}, [f.lower() for f in schema.fieldNames()], fold_case=True)
        return df.select(*[c.alias(f) for c, f in zip(cols, schema.fieldNames())], *keep)

    return standardise


def backfill(df: DataFrame, columns=S.GOLD_REQUIRED, fill_null: bool = False) -> DataFrame:
    """Add absent columns as empty text; optionally blank the NULLs of all text columns."""
    missing = {c: F.lit("") for c in columns if c not in df.columns}
    df = df.withColumns(missing) if missing else df
    return df.na.fill("") if fill_null else df


def available(df: DataFrame, wanted, numeric=(), zero_filled=()) -> DataFrame:
    """Those of the wanted columns that exist; numerics coerced, some NULLs to zero."""
    out = []
    for name in wanted:
        if name not in df.columns:
            continue
        c = F.col(name)
        if name in numeric:
            c = c.try_cast("double")
        if name in zero_filled:
            c = F.coalesce(c, F.lit(0.0))
        out.append(c.alias(name))
    return df.select(*out)


def preview(df: DataFrame, without, order, n: int = 20) -> DataFrame:
    return df.drop(*without).orderBy(*order).limit(n)


def required(df: DataFrame, columns=("job_title", "company")) -> DataFrame:
    return df.na.drop(how="any", subset=list(columns))


def non_blank(df: DataFrame, title="title", company="company") -> DataFrame:
    """Rows whose cleaned title and cleaned company both keep some text."""
    return df.filter(X.strict_left(title) & X.company_left(company))


def salary_band(df: DataFrame, low=SALARY_BAND[0], high=SALARY_BAND[1]) -> DataFrame:
    return df.filter(F.col("salary_avg").between(low, high))


def known_role(df: DataFrame, other: str = "Other") -> DataFrame:
    return df.filter(F.col("role_category") != other)


def trainable(df: DataFrame, text="combined_text", label="role_category") -> DataFrame:
    return df.na.drop(subset=[text, label])


def union_all(frames) -> DataFrame:
    """Concatenate standardised frames by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
