"""Keyed merges as pure functions: ``(target, source) -> new target``.

Each merge is an anti join plus a union. The target is the streamed side of the join, so while the
source slice is small (AQE measures it) the target is neither shuffled nor sorted.
A key that is NULL matches nothing, as in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """More than one source row for a merge key."""


def require_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when typed keys collide, for example ``1`` and ``01`` that were distinct as text."""
    repeated = (
        source.dropna(subset=list(keys)).groupBy(*keys).count().where("count > 1").select(*keys).limit(1).collect()
    )
    if repeated:
        raise DuplicateKeyError(f"several source rows for key {repeated[0].asDict()}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete matched keys flagged deleted, replace matched live ones, insert the other live ones.

    A source row whose flag is NULL does nothing.
    """
    acting = source.where(F.col("_is_deleted").isNotNull())
    kept = target.join(acting.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(acting.where(~F.col("_is_deleted")), allowMissingColumns=True)


def merge_replace(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update all, insert all, never delete: keys missing from the source stay."""
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def update_matched(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    condition: Column,
    assignments: Mapping[str, Column],
) -> DataFrame:
    """Set columns of the target rows that have an update row and meet ``condition``."""
    hit = updates.select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = target.join(hit, list(keys), "left")
    applies = F.col("_hit").isNotNull() & condition
    return joined.select(
        *[
            F.when(applies, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in target.columns
        ]
    )


def append_evolving(target: DataFrame, source: DataFrame) -> DataFrame:
    """Union by name; columns that only one side has are NULL on the other."""
    return target.unionByName(source, allowMissingColumns=True)


def merge_audit(batch: DataFrame) -> DataFrame:
    """Counts of rows, upserts and deletes of a prepared batch in one pass."""
    return batch.agg(
        F.count("*").alias("batch_rows"),
        F.count_if(~F.col("_is_deleted")).alias("upserts"),
        F.count_if(F.col("_is_deleted")).alias("deletes"),
    )
