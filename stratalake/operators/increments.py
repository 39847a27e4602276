"""Aggregates that follow a changing table: sums that take rows back, and counts of each value.

A change of a keyed table is a set of signed rows: the stored row of every touched key with -1, the row that
replaces it with +1. From them come two deltas:

* totals: per group the signed number of rows, and of every summed column its signed sum and number of known values;
* values: per group, column and value the signed number of rows. A value whose number falls to zero is gone, so
  distinct counts and maxima can be taken back, which their plain aggregates can't.

Deltas add up in any order. Adding one to a state touches its own groups only; results are finished per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGN, ROWS = "_sign", "n_rows"
MEASURE, VALUE = "measure", "value"


@dataclass(frozen=True)
class Measures:
    """What is kept per group: columns to sum, to count distinct values of, and to take the greatest text of."""

    groups: Sequence[str]
    sums: Sequence[str] = ()
    distincts: Sequence[str] = ()
    maxima: Sequence[str] = field(default=())

    @property
    def value_keys(self) -> list[str]:
        return [*self.groups, MEASURE, VALUE]


def signed_rows(before: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes that a merge of ``batch`` makes: ``before`` holds at least the stored rows of its keys.

    As in the merge, a row flagged deleted only takes back, and a row whose flag is NULL does nothing.
    """
    acting = batch.where(F.col("_is_deleted").isNotNull())
    plus = acting.where(~F.col("_is_deleted")).withColumn(SIGN, F.lit(1))
    if before is None:
        return plus
    minus = before.join(acting.select(*keys), list(keys), "left_semi").withColumn(SIGN, F.lit(-1))
    return minus.unionByName(plus, allowMissingColumns=True)


def totals_of(rows: DataFrame, measures: Measures) -> DataFrame:
    sign = F.col(SIGN).cast("bigint")
    sums = [F.sum(sign * F.col(c)).alias(f"sum_{c}") for c in measures.sums]
    known = [F.sum(F.when(F.col(c).isNotNull(), sign)).alias(f"known_{c}") for c in measures.sums]
    return rows.groupBy(*measures.groups).agg(F.sum(sign).alias(ROWS), *sums, *known).na.fill(0, [f"{p}_{c}" for c in measures.sums for p in ("sum", "known")])


def values_of(rows: DataFrame, measures: Measures) -> DataFrame:
    """One row per group, column and value; NULL is no value."""
    texts = dict(rows.dtypes)
    if wrong := [c for c in measures.maxima if texts[c] != "string"]:
        raise TypeError(f"maxima are kept as text, {wrong} are not")
    pairs = F.array(*[F.struct(F.lit(c).alias(MEASURE), F.col(c).cast("string").alias(VALUE)) for c in {*measures.distincts, *measures.maxima}])
    listed = rows.select(*measures.groups, SIGN, F.inline(pairs)).where(F.col(VALUE).isNotNull())
    return _summed(listed.groupBy(*measures.value_keys).agg(F.sum(F.col(SIGN).cast("bigint")).alias(ROWS)))


def _summed(state: DataFrame) -> DataFrame:
    return state.where(F.col(ROWS) != 0)


def add(state: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State and delta together; what has no rows left is dropped."""
    both = state.unionByName(delta)
    numbers = [c for c in both.columns if c not in keys]
    return _summed(both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers]))


def finished(totals: DataFrame, values: DataFrame, measures: Measures) -> DataFrame:
    """Per group: n_rows, sum_* (NULL without a known value), known_*, distinct_* and max_*.

    Stored values are distinct already, so they are counted in one aggregation without being multiplied.
    """
    of = F.col(MEASURE)
    counted = values.groupBy(*measures.groups).agg(
        *[F.count_if(of == c).alias(f"distinct_{c}") for c in measures.distincts],
        *[F.max(F.when(of == c, F.col(VALUE))).alias(f"max_{c}") for c in measures.maxima],
    )
    kept = totals.select(
        *measures.groups, ROWS, *[F.when(F.col(f"known_{c}") > 0, F.col(f"sum_{c}")).alias(f"sum_{c}") for c in measures.sums], *[f"known_{c}" for c in measures.sums]
    )
    renamed = [F.col(g).alias(f"_of_{g}") for g in measures.groups]
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in measures.groups]
    joined = kept.join(counted.select(*renamed, *[c for c in counted.columns if c not in measures.groups]), same, "left")
    return joined.drop(*[f"_of_{g}" for g in measures.groups]).na.fill(0, [f"distinct_{c}" for c in measures.distincts])
