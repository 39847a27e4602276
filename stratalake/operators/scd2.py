"""History of changes with validity intervals (type 2).

``apply_scd2`` is one plan from (history, source) to the new history, so the source is read at one
version and old and new intervals meet at the same instant. Only current rows take part in joins;
closed rows pass through, however many versions a key has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.columns import all_of, any_of, same_keys
from stratalake.operators.ranged import with_next

VALIDITY = ("effective_from", "effective_to", "is_current")


def _moment(as_of: datetime | str) -> Column:
    return F.lit(as_of).cast("timestamp")


def open_versions(rows: DataFrame, as_of: datetime | str) -> DataFrame:
    """Rows as current versions that start at ``as_of``; the initial load of a history."""
    return rows.withColumns(
        {
            "effective_from": _moment(as_of),
            "effective_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


def differs(left: str, right: str, tracked: Sequence[str], null_safe: bool = True) -> Column:
    """Any tracked column changed. ``null_safe=False`` ignores changes from or to NULL."""
    if null_safe:
        return any_of(~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in tracked)
    return F.coalesce(any_of(F.col(f"{left}.{c}") != F.col(f"{right}.{c}") for c in tracked), F.lit(False))


def changed_rows(
    current: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Source rows whose key has a current version with other tracked values."""
    pairs = source.alias("s").join(current.select(*keys, *tracked).alias("t"), same_keys("s", "t", keys))
    return pairs.where(differs("s", "t", tracked, null_safe)).select("s.*")


def new_rows(current: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key has no current version; a fully closed key counts as new."""
    return source.join(current.select(*keys), list(keys), "left_anti").select(*source.columns)


def changes_sql(
    current: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Changed and new rows by one SQL statement: a single left join whose partner is missing or differs."""
    on = " AND ".join(f"s.`{k}` = t.`{k}`" for k in keys)
    same = "s.`{0}` <=> t.`{0}`" if null_safe else "coalesce(s.`{0}` = t.`{0}`, true)"
    kept = " AND ".join([f"t.`{keys[0]}` IS NOT NULL", *(same.format(c) for c in tracked)])
    return source.sparkSession.sql(
        f"SELECT s.* FROM {{source}} AS s LEFT JOIN {{current}} AS t ON {on} WHERE NOT ({kept})", source=source, current=current
    )


def close_versions(
    current: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: datetime | str,
    null_safe: bool = True,
) -> DataFrame:
    """Current rows after the load: those with a changed source row end at ``as_of``.

    Source keys must be unique.
    """
    incoming = source.select(*keys, *tracked, F.lit(True).alias("_matched")).alias("s")
    joined = current.alias("t").join(incoming, same_keys("s", "t", keys), "left")
    ends = F.col("s._matched").isNotNull() & differs("s", "t", tracked, null_safe)
    return joined.select(
        *[F.col(f"t.{c}") for c in current.columns if c not in VALIDITY],
        F.col("t.effective_from"),
        F.when(ends, _moment(as_of)).otherwise(F.col("t.effective_to")).alias("effective_to"),
        F.when(ends, F.lit(False)).otherwise(F.col("t.is_current")).alias("is_current"),
    )


def apply_scd2(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: datetime | str,
    null_safe: bool = True,
) -> DataFrame:
    """The new history. Applied to current rows only, it returns them plus what closes and opens."""
    usable = source.dropna(subset=list(keys))
    settled = history.where(~F.col("is_current"))
    stored = history.where(F.col("is_current")).select(*keys, F.struct(*history.columns).alias("t"))
    arrived = usable.select(*keys, F.struct(*usable.columns).alias("s"))
    # every current row and every source row once: a row that stays or ends, and a row that begins
    met = stored.join(arrived, list(keys), "full_outer")
    is_new = F.col("t").isNull()
    ends = F.col("s").isNotNull() & ~is_new & differs("s", "t", tracked, null_safe)
    columns = [*history.columns, *(c for c in usable.columns if c not in history.columns)]
    types = {**dict(usable.dtypes), **dict(history.dtypes)}

    def row(side: str, known: Sequence[str], validity: dict[str, Column]) -> Column:
        value = lambda c: validity.get(c, F.col(f"{side}.{c}") if c in known else F.lit(None))
        return F.struct(*[value(c).cast(types[c]).alias(c) for c in columns])

    kept = row("t", history.columns, {
        "effective_to": F.when(ends, _moment(as_of)).otherwise(F.col("t.effective_to")),
        "is_current": F.col("t.is_current") & ~ends,
    })
    begun = row("s", usable.columns, {
        "effective_from": _moment(as_of), "effective_to": F.lit(None), "is_current": F.lit(True),
    })
    rows = F.array_compact(F.array(F.when(~is_new, kept), F.when(is_new | ends, begun)))
    return settled.unionByName(met.select(F.inline(rows)), allowMissingColumns=True)


def intervals(log: DataFrame, keys: Sequence[str], starts: str, grain: str = "day") -> DataFrame:
    """Validity of every version of a complete log: each ends where the next of its key starts.

    Rows are ordered within (key, period of ``grain``) and periods within a key, so the versions of
    one large key are spread over its periods instead of being sorted in a single task. Starts
    must be distinct per key. NULL keys are one key.
    """
    period = "_period"
    placed = log.withColumn(period, F.date_trunc(grain, starts))
    in_period = Window.partitionBy(*keys, period).orderBy(starts)
    firsts = placed.groupBy(*keys, period).agg(F.min(starts).alias("_first"))
    following = F.lead("_first").over(Window.partitionBy(*keys).orderBy(period))
    renamed = [F.col(c).alias(f"_of_{c}") for c in (*keys, period)]
    next_first = firsts.select(*renamed, following.alias("_next_first"))
    ordered = placed.withColumn("_next", F.lead(starts).over(in_period))
    joined = ordered.join(next_first, all_of(F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*keys, period)), "left")
    ends = F.coalesce(F.col("_next"), F.col("_next_first"))
    return joined.select(
        *log.columns, F.col(starts).alias("effective_from"), ends.alias("effective_to"), ends.isNull().alias("is_current")
    )


def intervals_by_range(log: DataFrame, keys: Sequence[str], starts: str, path: str, tasks: int | None = None) -> DataFrame:
    """The same intervals from rows dealt by ranges of (key, start), without a window: no task follows a key or a period.

    ``path`` is a fresh folder that all executors can reach.
    """
    closed = with_next(log, keys, starts, "effective_to", path, tasks)
    return closed.select(*log.columns, F.col(starts).alias("effective_from"), "effective_to", F.col("effective_to").isNull().alias("is_current"))


def valid_at(history: DataFrame, moment: datetime | str) -> DataFrame:
    at = _moment(moment)
    return history.where(
        all_of(
            [
                F.col("effective_from") <= at,
                F.col("effective_to").isNull() | (F.col("effective_to") > at),
            ]
        )
    )


def history_of(history: DataFrame, condition: Column, limit: int = 10) -> DataFrame:
    """Versions of one key, the most recently closed first and the current one last."""
    return history.where(condition).orderBy(F.col("effective_to").desc(), F.col("effective_from").desc()).limit(limit)
