"""Places of rows in the order of their group, without a task for each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import stored


def placed(df: DataFrame, group: str, *order: Column | str) -> DataFrame:
    """``df`` with ``place`` (from 0 in its group's order) and ``width`` (the group's rows).

    Rows are range-partitioned by group and order, so a group of a third of all rows spreads
    over a third of the partitions; only one count for each group and partition travels on.
    Null groups are a group. Ties keep an arbitrary but fixed order: rows are stored sorted.
    """
    keys = [F.col(group), *order]
    rows = stored(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()),
        "ordered").withColumn("_part", F.shiftright("_at", 33))
    runs = rows.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"))
    within = Window.partitionBy("_group")
    before = F.sum("_n").over(within.orderBy("_of").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = runs.select("_group", "_of", (before - F.col("_n") - F.col("_first")).alias("_lift"),
                       F.sum("_n").over(within).alias("width"))
    return rows.join(runs, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of"))).select(
        *df.columns, (F.col("_at") + F.col("_lift")).alias("place"), "width")
