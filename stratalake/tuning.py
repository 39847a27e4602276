"""Execution settings, caching and timing around unchanged queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession

from stratalake.sources.writers import discard


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for a block, restored afterwards. Actions must run inside the block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Bytes of files that a task reads where rows are folded: it sorts them, and cells are many times wider than what is stored.
FOLD_SPLIT = 32 << 20


def fold_splits(spark: SparkSession) -> AbstractContextManager[None]:
    """Smaller splits for a stream that is started in the block and folds its rows."""
    return settings(spark, {"spark.sql.files.maxPartitionBytes": str(FOLD_SPLIT)})


def adaptive(spark: SparkSession) -> AbstractContextManager[None]:
    """Adaptive execution for what a function handed to ``foreachBatch`` runs.

    A stream switches it off in its session; the batch is an ordinary frame, and without it neither the many shuffle
    partitions of a small batch are merged nor a large bucket is split.
    """
    return settings(spark, {"spark.sql.adaptive.enabled": "true"})


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files go when the statement that made them ends, not with the driver's next garbage collection.

    For statements that run once: a frame that is run again makes its shuffles anew.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def shuffle_partitions(cores: int, per_core: int = 3) -> int:
    """Two to four partitions per core; AQE merges those that turn out small."""
    return max(1, cores * per_core)


@contextmanager
def cached(df: DataFrame, fill: bool = False) -> Iterator[DataFrame]:
    """Keep a frame with several consumers in memory, spilling to disk; released at the end."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if fill:
            df.count()
        yield df
    finally:
        df.unpersist()


def seconds(query: Callable[[], DataFrame]) -> float:
    """Wall clock of defining and fully running a query."""
    start = time.perf_counter()
    discard(query())
    return time.perf_counter() - start


def compare(variants: dict[str, Callable[[], DataFrame]], rounds: int = 3) -> dict[str, list[float]]:
    """Timings of several variants, in alternating order so that none profits from going last."""
    times: dict[str, list[float]] = {name: [] for name in variants}
    for turn in range(rounds):
        order = list(variants) if turn % 2 == 0 else list(reversed(variants))
        for name in order:
            times[name].append(seconds(variants[name]))
    return times


def observed_rows(observation: Observation, name: str) -> int:
    """A count of an observation whose plan has run; 0 when the plan was found to be empty and its metrics with it."""
    try:
        return observation.get[name]
    except (Py4JJavaError, KeyError):
        return 0
