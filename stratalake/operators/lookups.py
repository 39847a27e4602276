"""Joins of facts with dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def size_bound(df: DataFrame) -> int:
    """Bytes of a frame as the optimizer bounds them from its files; nothing is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a dimension whose bound is small; no job is run while the plan is made.

    A larger one comes back without a hint: Spark then joins by shuffle, with AQE skew handling, and still
    broadcasts a side that it measures to be small.
    """
    return F.broadcast(dim) if size_bound(dim) <= max_bytes else dim


def left_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Left equi-join on differently named columns; the dimension's key is dropped."""
    return facts.join(dim, facts[fact_key] == dim[dim_key], "left").drop(dim[dim_key])


def left_chain(first: DataFrame, others: Sequence[DataFrame], key: str | list[str]) -> DataFrame:
    """Left joins of several frames on one shared key."""
    return reduce(lambda left, right: left.join(right, key, "left"), others, first)
