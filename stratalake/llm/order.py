"""Places of rows within their groups, where one group may hold most of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm import store


def placed(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``place`` (from 0 in its group, by ``order``, nulls first) and ``group_size``.

    Rows are ranged over tasks by group and order, so a large group lies in many tasks; each task numbers
    its own rows, and only one count per group and task is summed up. Rows that tie in ``order`` take their
    places in any order. ``group`` holds no nulls. Columns whose names begin with ``__`` are reserved.
    """
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    kept = store.keep(ranged, label).withColumn("__task", F.shiftright("__at", 33))
    tasks = kept.groupBy(group, "__task").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    in_group = Window.partitionBy(group)
    before = F.sum("__n").over(in_group.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    bases = tasks.select(group, "__task", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__base"), F.sum("__n").over(in_group).alias("group_size"))
    return kept.join(bases, [group, "__task"]).withColumn("place", F.col("__at") + F.col("__base")).drop("__at", "__task", "__base")
