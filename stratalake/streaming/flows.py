"""Trip flow: landing files to Bronze, rule flag, quarantine and clean branches, change folding.

Each flow reads what is available and stops; it can equally run continuously with another trigger.
Progress is in the checkpoint, together with a name of the run: a new checkpoint is a new run, whose
batch numbers begin at 0 again. Folding is idempotent: a batch that brings nothing newer, as a replay
does, commits nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.cdc import NEWS, fold_cells, from_cells, merge_news, to_cells
from stratalake.operators.quality import flag_rows, rule_metrics
from stratalake.operators.transforms import type_trips
from stratalake.sources.snapshots import SnapshotTable
from stratalake.tuning import adaptive, cached, fold_splits

# Key of a trip.
TRIP_KEYS = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "fare_amount")


def bronze(stream: DataFrame, as_of: datetime | str | None, batch_id: str) -> DataFrame:
    """Lineage columns on a file stream. Without ``as_of`` the time of each micro-batch is used."""
    arrived = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return stream.withColumns({"_ingestion_timestamp": arrived, "_batch_id": F.lit(batch_id)})


def staging(trips: DataFrame, rules: Mapping[str, str], checked_at: datetime | str, strict_null: bool = False) -> DataFrame:
    """Typed trips with the rule flag; the same function serves batch and stream."""
    return flag_rows(type_trips(trips), rules, checked_at, strict_null)


def observed(staged: DataFrame, rules: Mapping[str, str], name: str = "rule_failures") -> DataFrame:
    """Failures per rule reported with the progress of every micro-batch; all rows pass through."""
    return staged.observe(name, F.count("*").alias("rows"), *rule_metrics(rules))


def without_repeats(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """One row per key among rows that lie at most ``delay`` apart, and no row later than that.

    Keys are remembered in the state store until the newest ``time`` seen is ``delay`` past them, so the state holds the keys of
    that span, not of the whole stream; rows older than the watermark are dropped.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def split_to_files(
    staged: DataFrame, clean_path: str, quarantine_path: str, checkpoint: str, flag: str = "is_quarantined"
) -> StreamingQuery:
    """Both branches from one read of the stream.

    Every batch of a run has its own folder, which a replay overwrites, so rows are stored exactly
    once and no run touches the folders of another.
    """
    run = run_name(staged.sparkSession, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path, rows in (
                (quarantine_path, batch.where(f"{flag} = true")),
                (clean_path, batch.where(f"{flag} = false").drop(flag, "_dq_checked_at")),
            ):
                rows.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")
        finally:
            batch.unpersist()

    return _run(staged, store, checkpoint)


def fold_into(
    changes: DataFrame,
    table: SnapshotTable,
    sequence_by: str,
    checkpoint: str,
    stream_id: str,
    ignore_nulls: bool = False,
) -> StreamingQuery:
    """Keep the newest value per key of ``table`` by ``sequence_by``, whatever the order of arrival.

    A micro-batch is folded per key first; then only the buckets it touches are rewritten.
    """
    keys = list(table.keys)

    def apply(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            target = table.using(batch.sparkSession)
            with cached(fold_cells(to_cells(batch, keys, sequence_by, ignore_nulls), keys)) as folded:
                if folded.isEmpty():
                    return
                if not target.exists():
                    target.overwrite(folded.limit(0), operation="create")
                with cached(merge_news(target.touched_by(folded), folded, keys)) as merged:  # for the question and for the merge
                    if not target.version() or not merged.where(NEWS).isEmpty():
                        target.merge(folded, lambda _stored, _source: merged.drop(NEWS), operation="fold", streams={stream_id: batch_id})

    with fold_splits(changes.sparkSession):
        return _run(changes, apply, checkpoint)


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to, kept in its folder and lost with it."""
    path = f"{checkpoint.rstrip('/')}/run"
    try:
        return spark.read.text(path).first()["value"]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.text(path)
    return spark.read.text(path).first()["value"]


def current_rows(table: SnapshotTable, ignore_nulls: bool = False, version: int | None = None) -> DataFrame:
    """The folded table as plain rows."""
    return from_cells(table.read(version), list(table.keys), ignore_nulls)


def _run(stream: DataFrame, apply, checkpoint: str) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
