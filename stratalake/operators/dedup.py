"""Latest row per key.

``row_number() = 1`` is planned with a per-partition limit below the shuffle, so a key that holds a
large part of the rows is reduced to one row per input partition before any row moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank_in_key"


def tie_break_columns(df: DataFrame, keys: Sequence[str], order_by: str) -> list[str]:
    """All other columns: they decide between rows of one key with one time, the same in every run."""
    return [c for c in df.columns if c not in keys and c != order_by]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str = "_ingestion_timestamp",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    ties = tie_break_columns(df, keys, order_by) if tie_break is None else tie_break
    newest_first = Window.partitionBy(*keys).orderBy(
        F.col(order_by).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ties]
    )
    return df.withColumn(_RANK, F.row_number().over(newest_first)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key_sql(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str = "_ingestion_timestamp",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The same in SQL text with a common table expression; the plan is identical."""
    ties = tie_break_columns(df, keys, order_by) if tie_break is None else tie_break
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in (order_by, *ties))
    by = ", ".join(f"`{k}`" for k in keys)
    return df.sparkSession.sql(
        f"""
        WITH numbered AS (
            SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS {_RANK}
            FROM {{rows}}
        )
        SELECT * FROM numbered WHERE {_RANK} = 1
        """,
        rows=df,
    ).drop(_RANK)
