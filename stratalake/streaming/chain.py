"""Trips from landing files to folded rows as one chain of streams.

Four hops with a checkpoint each, run in order; every hop reads what the one before it has written:

1. landing files to Bronze, with lineage columns, under a schema that is inferred and widened;
2. Bronze to staging: typed trips with the rule flag, one folder per flag value;
3. staging to the quarantine, which only grows;
4. staging to the fold of clean trips: the newest known value per trip key and column.

Staging and quarantine are file sinks, so hops 3 and 4 read their commit log and never a broken attempt.
Bronze and the fold are stored by batch: a batch that is run again overwrites its own folder, and a hop starts
only after the one before it has ended well.

The fold stores what a batch brings, pre-aggregated per key, and reads nothing that is stored. Folding is idempotent
and does not depend on order, so the current rows are the fold of all stored cells, late rows and
replays included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from stratalake.operators.cdc import fold_cells, fold_folded, from_cells, to_cells
from stratalake.operators.quality import QUARANTINED, clean, quarantined
from stratalake.sources.evolving import SchemaStore, evolving_stream
from stratalake.sources.writers import append_stream
from stratalake.streaming.flows import TRIP_KEYS, bronze, run_name, staging
from stratalake.tuning import adaptive, fold_splits, shuffles_removed

#: Every row is stored once per hop, so the hops are written denser than by default.
COMPRESSION = "zstd"
_LINEAGE = [StructField("_source_file", StringType()), StructField("_ingestion_timestamp", TimestampType()), StructField("_batch_id", StringType())]


class TripChain:
    """The four hops below ``base``, a folder that all executors can reach."""

    def __init__(self, spark: SparkSession, base: str, rules: Mapping[str, str], keys: Sequence[str] = TRIP_KEYS):
        self.spark = spark
        self.base = base.rstrip("/")
        self.rules = rules
        self.keys = list(keys)
        self.schemas = SchemaStore(spark, f"{self.base}/schema")

    def run(
        self,
        landing: str,
        as_of: datetime | str | None = None,
        batch_id: str = "run",
        checked_at: datetime | str | None = None,
        files_per_batch: int | None = None,
    ) -> int:
        """Take everything that is new in ``landing`` through all hops; returns how often the schema grew underway.

        Without ``as_of`` rows are stamped with the time of their micro-batch; ``checked_at`` follows ``as_of``.
        """
        restarts = self._to_bronze(landing, as_of, batch_id, files_per_batch)
        if self.schemas.schema() is not None:
            self._to_staging(checked_at or as_of or datetime.now())
            self._to_quarantine()
            self._to_fold()
        return restarts

    def _progress(self, hop: str) -> str:
        return f"{self.base}/progress/{hop}"

    def _to_bronze(self, landing: str, as_of, batch_id: str, files_per_batch: int | None) -> int:
        run = run_name(self.spark, self._progress("bronze"))

        def store(batch: DataFrame, number: int) -> None:
            rows = bronze(batch, as_of, batch_id)
            rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{self.base}/bronze/run={run}/batch={number}")

        return evolving_stream(self.spark, landing, self.schemas, store, self._progress("bronze"), files_per_batch)

    def bronze_schema(self) -> StructType:
        """The newest schema with the lineage columns behind."""
        known = self.schemas.schema()
        return StructType([f for f in known.fields if f.name not in {x.name for x in _LINEAGE}] + _LINEAGE)

    def _to_staging(self, checked_at) -> None:
        raw = self.spark.readStream.schema(self.bronze_schema()).parquet(f"{self.base}/bronze/*/*")
        append_stream(staging(raw, self.rules, checked_at), f"{self.base}/staging", self._progress("staging"), [QUARANTINED], COMPRESSION)

    def staging_schema(self) -> StructType:
        empty = self.spark.createDataFrame([], self.bronze_schema())
        return staging(empty, self.rules, datetime(1970, 1, 1)).schema

    def _staged(self) -> DataFrame:
        return self.spark.readStream.schema(self.staging_schema()).parquet(f"{self.base}/staging")

    def _to_quarantine(self) -> None:
        append_stream(quarantined(self._staged()), f"{self.base}/quarantine", self._progress("quarantine"), compression=COMPRESSION)

    def _cells(self, trips: DataFrame) -> DataFrame:
        return to_cells(trips, self.keys, "_ingestion_timestamp", ignore_nulls=True)

    def _to_fold(self) -> None:
        run = run_name(self.spark, self._progress("fold"))

        def store(batch: DataFrame, number: int) -> None:
            with adaptive(batch.sparkSession), shuffles_removed(batch.sparkSession):
                folded = fold_cells(self._cells(batch), self.keys)
                folded.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{self.base}/cells/run={run}/batch={number}")

        stream = clean(self._staged()).writeStream.foreachBatch(store).option("checkpointLocation", self._progress("fold"))
        with fold_splits(self.spark):
            stream.trigger(availableNow=True).start().awaitTermination()

    # -- results ------------------------------------------------------------------------------

    def bronze_rows(self) -> DataFrame:
        return self.spark.read.schema(self.bronze_schema()).parquet(f"{self.base}/bronze/*/*")

    def quarantine_rows(self) -> DataFrame:
        return self.spark.read.schema(quarantined(self.spark.createDataFrame([], self.staging_schema())).schema).parquet(f"{self.base}/quarantine")

    def trips(self) -> DataFrame:
        """Clean trips, one row per key, each column with its newest value that is known."""
        shape = self._cells(clean(self.spark.createDataFrame([], self.staging_schema()))).schema
        cells = self.spark.read.schema(shape).parquet(f"{self.base}/cells/*/*")
        return from_cells(fold_folded(cells, self.keys), self.keys, ignore_nulls=True)
