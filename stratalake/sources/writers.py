"""Batch and stream sinks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.functions.columns import hour_parts


def json_snapshot(df: DataFrame, base: str, folder: str, moment: datetime) -> str:
    """Overwrite ``base/folder/<hour>`` with a JSON export; returns the path."""
    path = f"{base.rstrip('/')}/{folder}/{moment:%Y-%m-%d_%H}"
    df.write.mode("overwrite").json(path)
    return path


def hourly_csv(df: DataFrame, path: str, time_column: str = "event_time") -> None:
    """CSV with header under ``year=/month=/day=/hour=``; only the hours in ``df`` are replaced.

    Rows are gathered per hour before the write so that an hour is a few files; AQE splits an hour
    that is larger than the target size.
    """
    parts = hour_parts(F.col(time_column).try_cast("timestamp"))
    (
        df.withColumns(parts)
        .hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("header", "true")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .csv(path)
    )


def discard(df: DataFrame) -> None:
    """Run the whole plan and drop the rows."""
    df.write.format("noop").mode("overwrite").save()


def append_files(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def flag_partitioned(df: DataFrame, path: str, flag: str = "is_quarantined") -> None:
    """Staging files in one folder per flag value, so that each branch reads its own rows only."""
    df.write.mode("overwrite").partitionBy(flag).parquet(path)


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), compression: str | None = None
) -> StreamingQuery:
    """Append what is available now and stop; progress is kept in the checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*partition_by)
        .options(**({"compression": compression} if compression else {}))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def show(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)
