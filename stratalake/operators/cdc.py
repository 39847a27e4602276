"""Change folding: newest value per key, whatever the order of arrival.

A folded table holds one *cell* per tracked unit: ``struct(_seq, values)``. Folding keeps the
greatest cell per key. That operation is associative, commutative and idempotent, so changes are
pre-aggregated before the shuffle (a hot key sends one row per input partition), late rows cannot
overwrite newer ones, and replaying a batch changes nothing.

* Without ``ignore_nulls`` a key has one cell with the whole row.
* With ``ignore_nulls`` every column has its own cell, and NULL never enters a cell: a newer row
  with NULL keeps the older value, even when rows arrive out of order.

Rows of one key with one sequence value are decided by their values, the same in every run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQ = "_seq"
ROW_CELL = "cell"
STORED, NEWS = "_stored", "_news"


def to_cells(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, ignore_nulls: bool = False
) -> DataFrame:
    values = [c for c in changes.columns if c not in keys]
    if ignore_nulls:
        cells = [
            F.when(
                F.col(c).isNotNull() & F.col(sequence_by).isNotNull(),
                F.struct(F.col(sequence_by).alias(SEQ), F.col(c).alias("value")),
            ).alias(c)
            for c in values
        ]
    else:
        ordered = [sequence_by, *[c for c in values if c != sequence_by]]
        cells = [
            F.when(
                F.col(sequence_by).isNotNull(),
                F.struct(F.col(sequence_by).alias(SEQ), *[F.col(c) for c in ordered]),
            ).alias(ROW_CELL)
        ]
    return changes.where(F.col(sequence_by).isNotNull()).select(*keys, *cells)


def fold_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cells.columns if c not in keys])


def fold_folded(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`fold_cells` of one cell per column (``ignore_nulls``) that come from a few folds, so that a key has a row per fold at most.

    Nothing is gained by folding such rows before the shuffle, and their cells are wide: they are dealt by key as plain values,
    with one sequence value where all cells of the row have the same, and are made cells again behind the shuffle.
    """
    values = [c for c in cells.columns if c not in keys]
    names = {c: f"_value_{i}" for i, c in enumerate(values)}
    newest = F.greatest(*[F.col(f"{c}.{SEQ}") for c in values]) if len(values) > 1 else F.col(f"{values[0]}.{SEQ}")
    unequal = reduce(or_, [F.coalesce(F.col(f"{c}.{SEQ}") != newest, F.lit(False)) for c in values])
    own = F.when(unequal, F.struct(*[F.col(f"{c}.{SEQ}").alias(n) for c, n in names.items()]))
    plain = cells.select(*keys, *[F.col(f"{c}.value").alias(n) for c, n in names.items()], newest.alias("_newest"), own.alias("_own"))
    dealt = plain.repartition(*keys)
    wide = [F.when(F.col(n).isNotNull(), F.struct(F.coalesce(F.col(f"_own.{n}"), F.col("_newest")).alias(SEQ), F.col(n).alias("value"))).alias(c) for c, n in names.items()]
    return fold_cells(dealt.select(*keys, *wide), keys)


def merge_cells(state: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold new cells into stored ones; columns new to the table start empty for older keys."""
    return fold_cells(state.unionByName(incoming, allowMissingColumns=True), keys)


def merge_news(state: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`merge_cells` of folded cells, with a column `NEWS`: whether ``incoming`` brings the key something the state lacks.

    A key that holds a NULL matches nothing stored, so it is always news.
    """
    both = state.withColumn(STORED, F.lit(True)).unionByName(incoming.withColumn(STORED, F.lit(False)), allowMissingColumns=True)
    cells = [c for c in both.columns if c not in (*keys, STORED)]
    unequal = [~F.max(c).eqNullSafe(F.max(F.when(F.col(STORED), F.col(c)))) for c in cells]
    arrived = F.bool_or(~F.col(STORED))
    news = reduce(or_, unequal, F.bool_and(~F.col(STORED)) | reduce(or_, [F.col(k).isNull() for k in keys], F.lit(False)) & arrived)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cells], news.alias(NEWS))


def from_cells(state: DataFrame, keys: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """The current rows of a folded table."""
    if ignore_nulls:
        return state.select(*keys, *[F.col(f"{c}.value").alias(c) for c in state.columns if c not in keys])
    names = [n for n in state.schema[ROW_CELL].dataType.names if n != SEQ]
    return state.select(*keys, *[F.col(f"{ROW_CELL}.{n}").alias(n) for n in names])


def fold_changes(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, ignore_nulls: bool = False
) -> DataFrame:
    """Type 1 result of a whole change log at once."""
    cells = to_cells(changes, keys, sequence_by, ignore_nulls)
    return from_cells(fold_cells(cells, keys), keys, ignore_nulls)
