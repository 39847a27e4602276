"""Tables with versions on plain Parquet folders.

A table is a folder with

* ``data/snap_version=<v>/snap_bucket=<b>/*.parquet`` - rows that version ``v`` wrote, and
* ``history/snap_version=<v>/`` - one row that describes the version.

The history row is written last by a single-file Spark write. It is the commit point: without it the
data of a broken attempt is never read, and the next attempt overwrites it, also a broken history
write. A row's bucket is a hash of its keys. Keys, bucket count and append-only condition are stored
with the table: another key or bucket count is an error, a table opened without keys takes the stored
ones. A merge reads and rewrites only the buckets its source touches. Rows with an
``append_only`` mark (closed history, log tables) live in bucket -1, which is only added to.
One writer per table at a time; readers are not blocked. Several folders of one bucket are the
result of appends.

A history row lists all folders of its version with their newest ingestion time. So a version is
opened by reading one history file, the watermark of a table costs no scan, and an incremental read
opens only folders that can hold newer rows.

Only history rows and bucket numbers reach the driver, never table data. Choose the number of
buckets so that one bucket is about one well-sized file (table size / 512 MB).
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from stratalake.tuning import cached

VERSION, BUCKET = "snap_version", "snap_bucket"
INGESTED = "_ingestion_timestamp"
APPEND_BUCKET = -1
FOLDER = StructType(
    [
        StructField("bucket", IntegerType()),
        StructField("version", LongType()),
        StructField("rows", LongType()),
        StructField("newest", TimestampType()),
    ]
)
HISTORY = StructType(
    [
        StructField("committed_at", TimestampType()),
        StructField("operation", StringType()),
        StructField("rewritten", ArrayType(IntegerType())),
        StructField("rows_written", LongType()),
        StructField("metrics", MapType(StringType(), LongType())),
        StructField("folders", ArrayType(FOLDER)),
        StructField("schema_json", StringType()),
        StructField("streams", MapType(StringType(), LongType())),
        StructField("keys", ArrayType(StringType())),
        StructField("buckets", IntegerType()),
        StructField("append_only", StringType()),
    ]
)


@dataclass(frozen=True)
class State:
    """What one version consists of."""

    version: int
    schema: StructType
    folders: list[Row]
    streams: dict[str, int]
    keys: tuple[str, ...]
    buckets: int
    append_only: str | None


class LayoutError(ValueError):
    """A table is opened with other keys, buckets or append-only rows than it was created with."""


class VersionNotFoundError(LookupError):
    """The table has no such version."""


class SnapshotTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = (),
        buckets: int = 16,
        append_only: Column | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.buckets = buckets
        self.append_only = append_only

    def using(self, spark: SparkSession) -> SnapshotTable:
        """The same table through another session, as inside a stream's batch function."""
        return SnapshotTable(spark, self.path, self.keys, self.buckets, self.append_only)

    # -- history ------------------------------------------------------------------------------

    def history(self) -> DataFrame:
        """One row per version; ``version`` and ``timestamp`` first."""
        if not self.versions():
            rows = self.spark.createDataFrame([], StructType([*HISTORY.fields, StructField(VERSION, LongType())]))
        else:
            rows = self._history_files()
        return rows.select(
            F.col(VERSION).cast("bigint").alias("version"),
            F.col("committed_at").alias("timestamp"),
            *[c for c in HISTORY.names if c != "committed_at"],
        )

    def _history_files(self) -> DataFrame:
        return self.spark.read.schema(HISTORY).parquet(f"{self.path}/history")

    def versions(self) -> list[int]:
        """Committed versions, from the file listing alone."""
        try:
            files = self._history_files().inputFiles()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({int(re.search(rf"{VERSION}=(\d+)", f).group(1)) for f in files})

    def newest_versions(self, count: int = 2) -> DataFrame:
        return self.history().select("version", "timestamp", "operation", "metrics").orderBy(F.desc("version")).limit(count)

    def exists(self) -> bool:
        return bool(self.versions())

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def version_at(self, moment: datetime) -> int | None:
        """Newest version committed at or before ``moment``; None when the table is younger."""
        eligible = self.history().where(F.col("timestamp") <= F.lit(moment).cast("timestamp"))
        return eligible.agg(F.max("version")).first()[0]

    def last_batch(self, stream_id: str) -> int | None:
        """Newest stream batch already committed, to skip a replay."""
        state = self._state()
        return state.streams.get(stream_id) if state else None

    def _state(self, version: int | None = None) -> State | None:
        """The layout of a version (default: the newest); opens one history file."""
        known = self.versions()
        if version is None:
            if not known:
                return None
            version = known[-1]
        elif version not in known:
            raise VersionNotFoundError(f"{self.path} has no version {version}")
        row = self.spark.read.schema(HISTORY).parquet(f"{self.path}/history/{VERSION}={version}").first()
        return State(
            version,
            StructType.fromJson(json.loads(row["schema_json"])),
            row["folders"],
            row["streams"],
            tuple(row["keys"] or ()),
            row["buckets"],
            row["append_only"],
        )

    def _agreed(self, state: State | None) -> SnapshotTable:
        """This table with the stored layout; a contradiction raises."""
        if state is None:
            return self
        if self.keys and self.keys != state.keys:
            raise LayoutError(f"{self.path} has the keys {list(state.keys)}, not {list(self.keys)}")
        if self.keys and self.buckets != state.buckets:
            raise LayoutError(f"{self.path} has {state.buckets} buckets, not {self.buckets}")
        mark = None if self.append_only is None else str(self.append_only)
        if (self.keys or state.append_only) and mark != state.append_only:
            raise LayoutError(f"{self.path} has the append-only condition {state.append_only}, not {mark}")
        return SnapshotTable(self.spark, self.path, state.keys, state.buckets, self.append_only)

    # -- reading ------------------------------------------------------------------------------

    def _load(self, state: State, only: set[int] | None = None, newer_than: datetime | None = None) -> DataFrame:
        paths = [
            f"{self.path}/data/{VERSION}={f['version']}/{BUCKET}={f['bucket']}"
            for f in state.folders
            if (only is None or f["bucket"] in only) and (newer_than is None or _may_exceed(f["newest"], newer_than))
        ]
        if not paths:
            return self.spark.createDataFrame([], state.schema)
        return self.spark.read.schema(state.schema).parquet(*paths)

    def watermark(self) -> datetime | None:
        """Newest ingestion time of the current rows, taken from the history."""
        state = self._state()
        return max((f["newest"] for f in state.folders if f["newest"]), default=None) if state else None

    def read(
        self, version: int | None = None, as_of: datetime | None = None, newer_than: datetime | None = None
    ) -> DataFrame:
        """The newest rows, those of a version, or those at a time.

        ``newer_than`` leaves out folders without a row ingested after that time; the folders that
        are read may hold older rows too.
        """
        if as_of is not None:
            version = self.version_at(as_of)
            if version is None:
                raise VersionNotFoundError(f"{self.path} has no version at {as_of}")
        state = self._state(version)
        if state is None:
            raise VersionNotFoundError(f"{self.path} has no version")
        return self._load(state, newer_than=newer_than)

    def read_or_none(self) -> DataFrame | None:
        state = self._state()
        return self._load(state) if state else None

    def register(self, view: str, version: int | None = None, as_of: datetime | None = None) -> None:
        """Make one version available to SQL text."""
        self.read(version, as_of).createOrReplaceTempView(view)

    # -- writing ------------------------------------------------------------------------------

    def _hash(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _bucket(self) -> Column:
        if not self.keys:
            return F.lit(APPEND_BUCKET)
        if self.append_only is None:
            return self._hash()
        return F.when(self.append_only, F.lit(APPEND_BUCKET)).otherwise(self._hash())

    def _commit(
        self,
        rows: DataFrame,
        operation: str,
        before: State | None,
        rewritten: set[int],
        schema: StructType,
        as_of: datetime | None,
        metrics: dict[str, int] | None = None,
        streams: dict[str, int] | None = None,
    ) -> int:
        version = before.version + 1 if before else 0
        target = f"{self.path}/data/{VERSION}={version}"
        placed = rows.withColumn(BUCKET, self._bucket())
        if self.keys:
            # One folder per bucket with few files; AQE splits a bucket that grew too large.
            placed = placed.hint("rebalance", BUCKET)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        kept = [f for f in before.folders if f["bucket"] not in rewritten] if before else []
        added = self._describe(target, version, rows.schema)
        entry = Row(
            committed_at=as_of or datetime.now(timezone.utc),
            operation=operation,
            rewritten=sorted(rewritten),
            rows_written=sum(f["rows"] for f in added),
            metrics=metrics or {},
            folders=sorted(kept + added, key=lambda f: (f["bucket"], f["version"])),
            schema_json=schema.json(),
            streams={**(before.streams if before else {}), **(streams or {})},
            keys=list(self.keys),
            buckets=self.buckets,
            append_only=None if self.append_only is None else str(self.append_only),
        )
        (
            self.spark.createDataFrame([entry], HISTORY)
            .coalesce(1)
            .write.mode("errorifexists" if version in self.versions() else "overwrite")  # over a broken attempt
            .parquet(f"{self.path}/history/{VERSION}={version}")
        )
        return version

    def _describe(self, target: str, version: int, schema: StructType) -> list[Row]:
        """Rows and newest ingestion time of each folder just written; reads at most one column."""
        timed = INGESTED in schema.names and schema[INGESTED].dataType == TimestampType()
        needed = [StructField(INGESTED, TimestampType())] if timed else []
        stored = self.spark.read.schema(StructType([*needed, StructField(BUCKET, IntegerType())])).parquet(target)
        newest = F.max(INGESTED) if timed else F.lit(None).cast("timestamp")
        found = stored.groupBy(BUCKET).agg(F.count("*").alias("n"), newest.alias("newest")).collect()
        return [Row(bucket=r[BUCKET], version=version, rows=r["n"], newest=r["newest"]) for r in found]

    def overwrite(self, rows: DataFrame, as_of=None, operation="overwrite", metrics=None) -> int:
        """Create the table or replace all its rows (also the refresh of a materialized result)."""
        before = self._state()
        replaced = {f["bucket"] for f in before.folders} if before else set()
        return self._agreed(before)._commit(rows, operation, before, replaced, rows.schema, as_of, metrics)

    def append(self, rows: DataFrame, as_of=None, metrics=None) -> int:
        """Add rows; a column new to the table is NULL in older rows and the other way round."""
        before = self._state()
        schema = widen(before.schema, rows.schema) if before else rows.schema
        return self._agreed(before)._commit(rows, "append" if before else "create", before, set(), schema, as_of, metrics)

    def touched_by(self, source: DataFrame) -> DataFrame:
        """The rows of the buckets that hold the keys of ``source``."""
        before = self._state()
        agreed = self._agreed(before)
        return self._load(before, agreed._buckets_of(agreed._typed(source, before)))

    def _typed(self, source: DataFrame, state: State) -> DataFrame:
        other = [k for k in self.keys if source.schema[k].dataType != state.schema[k].dataType]
        return source.withColumns({k: F.col(k).cast(state.schema[k].dataType) for k in other}) if other else source

    def _buckets_of(self, source: DataFrame) -> set[int]:
        return {r[0] for r in source.select(self._hash()).distinct().collect()}

    def merge(
        self,
        source: DataFrame,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
        as_of=None,
        operation: str = "merge",
        metrics: dict[str, int] | None = None,
        streams: dict[str, int] | None = None,
    ) -> int:
        """``combine(rows of the touched buckets, source)`` replaces those buckets.

        ``source`` is kept while it is read several times. Rows of the append-only bucket are not passed in; rows that ``combine`` marks append-only are added to it.
        ``streams`` records the last batch of a stream with the version.
        """
        before = self._state()
        if before is None:
            raise VersionNotFoundError(f"{self.path} has no version")
        agreed = self._agreed(before)
        typed = agreed._typed(source, before)
        with nullcontext(typed) if typed.is_cached else cached(typed) as source:
            touched = agreed._buckets_of(source)
            result = combine(self._load(before, touched), source)
            schema = widen(before.schema, result.schema)
            return agreed._commit(result, operation, before, touched, schema, as_of, metrics, streams)


def _may_exceed(newest: datetime | None, moment: datetime) -> bool:
    """A folder without a recorded time may hold anything."""
    return newest is None or newest > moment


def widen(old: StructType, new: StructType) -> StructType:
    """Columns of both; a column that changed its type is an error."""
    known = {f.name: f.dataType for f in old.fields}
    for field in new.fields:
        if field.name in known and known[field.name] != field.dataType:
            raise TypeError(
                f"column {field.name} changed from {known[field.name].simpleString()} to {field.dataType.simpleString()}"
            )
    return StructType(old.fields + [f for f in new.fields if f.name not in known])
