"""Keep-one-row operators, upsert and source sets.

``row_number() = 1`` gets a partial group limit below the shuffle: each map task
ships at most one row per key, so a key that holds a third of the rows costs one
row per task. Every order ends with all columns, so reruns give the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacancia.functions import text as X


def total_order(df: DataFrame, first=()) -> list[Column]:
    return [*first, *[F.col(f"`{c}`").asc_nulls_first() for c in df.columns]]


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def first_by_id(df: DataFrame, key="job_id") -> DataFrame:
    """One row per id; "first seen" is the smallest row in the total order."""
    return keep_first(df, [key], total_order(df))


def newest(df: DataFrame, keys, stamp: str) -> DataFrame:
    """The row of the latest batch per key; NULL key parts equal each other."""
    return keep_first(df, keys, total_order(df, [F.col(stamp).desc_nulls_last()]))


def last_by_id(batches: DataFrame, stamp="batch_ts") -> DataFrame:
    return newest(batches, ["job_id"], stamp)


def last_by_fields(batches: DataFrame, stamp="batch_ts") -> DataFrame:
    return newest(batches, ["title", "company", "location"], stamp)


def first_lowered(df: DataFrame, keys=("title", "company", "location")) -> DataFrame:
    """Normalise the key fields in place, then keep the first row of each."""
    df = df.withColumns({k: X.strip(F.lower(F.col(k))) for k in keys})
    return keep_first(df, list(keys), total_order(df))


def first_role_match(matches: DataFrame) -> DataFrame:
    """One row per posting: the match of the earliest role in the dictionary."""
    return keep_first(matches, ["job_id"], total_order(matches, [F.col("role_position").asc()]))


def upsert(current: DataFrame, changes: DataFrame, key: str, stamp: str) -> DataFrame:
    """Current rows replaced by newer rows of the same key, new keys added."""
    return newest(current.unionByName(changes), [key], stamp)


def with_dedup_key(df: DataFrame) -> DataFrame:
    return df.withColumn("dedup_key", X.dedup_key("title", "company", "location"))


def source_sets(df: DataFrame, key="dedup_key") -> DataFrame:
    """Distinct sources per key and their sorted comma list.

    Duplicates collapse map-side in a plain hash aggregate, so a hot key ships its
    distinct sources only, and the lists are built from those few rows.
    """
    pairs = df.select(key, "source").dropDuplicates()
    sources = F.sort_array(F.collect_list("source"))
    return pairs.groupBy(key).agg(
        F.count("source").alias("source_count"),
        F.array_join(sources, ",").alias("sources_available"),
    )


def with_source_sets(df: DataFrame, key="dedup_key") -> DataFrame:
    """Every row with its key's source count and list (hot keys: AQE skew join)."""
    return df.join(source_sets(df, key), key, "left")


def best_row(df: DataFrame, key="dedup_key", stamp="scraped_at") -> DataFrame:
    """Newest row per key with the key's source sets, in one pass and without a join.

    The source count is constant within a key, so only the stamp ranks its rows.
    Keeping the newest row per (key, source) first leaves a key no more rows than it
    has sources, and those few rows carry both the winner and the source list.
    """
    order = total_order(df, [F.col(stamp).desc_nulls_last()])
    per_source = keep_first(df, [key, "source"], order)
    w = Window.partitionBy(key)
    sources = F.sort_array(F.collect_list("source").over(w))
    ranked = per_source.withColumns({
        "source_count": F.count("source").over(w),
        "sources_available": F.array_join(sources, ","),
        "_rank": F.row_number().over(w.orderBy(*order)),
    })
    return ranked.filter("_rank = 1").drop("_rank")


def distinct_in_order(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values with the position of their first appearance."""
    return df.groupBy(value).agg(F.min(order).alias("first_seen")).orderBy("first_seen", value)
