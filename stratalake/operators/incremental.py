"""Slices of a growing source table and their preparation for a merge."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedup import latest_per_key
from stratalake.operators.transforms import Transform

INGESTED = "_ingestion_timestamp"
OPEN_DATE = "9999-01-01"


def high_watermark(target: DataFrame, time_column: str = INGESTED):
    """Newest time in the target, or None for an empty one: a single value on the driver."""
    return target.agg(F.max(time_column)).first()[0]


def newer_than(source: DataFrame, watermark, time_column: str = INGESTED) -> DataFrame:
    """Rows after the watermark. The literal reaches the scan, so older row groups are skipped.

    No watermark (empty target) means a full load, otherwise nothing would ever be loaded.
    """
    if watermark is None:
        return source
    time = F.col(time_column)
    if dict(source.dtypes)[time_column] == "string":
        time = time.try_cast("timestamp")
    return source.where(time > F.lit(watermark))


def between(
    source: DataFrame, start: str | datetime, end: str | datetime, time_column: str = INGESTED
) -> DataFrame:
    """Rows strictly inside ``(start, end)``."""
    low, high = (F.lit(v).cast("timestamp") for v in (start, end))
    return source.where((F.col(time_column) > low) & (F.col(time_column) < high))


def select_slice(
    source: DataFrame,
    target: DataFrame | None,
    start: str = OPEN_DATE,
    end: str = OPEN_DATE,
    time_column: str = INGESTED,
) -> DataFrame:
    """No target: everything. Both dates given: that open interval. Otherwise: newer than the target."""
    if target is None:
        return source
    if OPEN_DATE not in (start, end):
        return between(source, start, end, time_column)
    return newer_than(source, high_watermark(target, time_column), time_column)


def prepare_slice(
    rows: DataFrame,
    keys: Sequence[str],
    transform: Transform,
    order_by: str = INGESTED,
    validate_first: bool = False,
    dedup=latest_per_key,
) -> DataFrame:
    """Latest row per key, then the typed transform.

    With ``validate_first`` an unusable newest row no longer hides an older usable one, and keys
    are compared after their cast, so ``1`` and ``01`` are one key.
    """
    if validate_first:
        return dedup(transform(rows), keys, order_by)
    return transform(dedup(rows, keys, order_by))


def split_deletes(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(deletes, upserts)``; rows with an unknown flag are in neither."""
    return batch.where(F.col("_is_deleted")), batch.where(~F.col("_is_deleted"))


def inject_change(source: DataFrame, condition, changes: dict, as_of, time_column: str = INGESTED) -> DataFrame:
    """A changed copy of the oldest row that meets ``condition``, to be appended to the source."""
    oldest = source.where(condition).orderBy(F.col(time_column).asc(), *source.columns).limit(1)
    return oldest.withColumns({c: F.lit(v).cast(source.schema[c].dataType) for c, v in {**changes, time_column: as_of}.items()})
