"""File streams whose schema is inferred from new files and widened while they run.

A `SchemaStore` keeps the schemas of a landing folder as numbered versions, with the modification time up to
which files are known. A refresh opens the footers of newer files only, by Spark's own merging of schemas;
where files disagree on a type, the list is halved until each part agrees and the parts are widened. Columns
only come, types only grow, so rows that were stored under an earlier version stay readable.

`evolving_stream` looks for newer files before every micro-batch is stored. When one widens the schema, the
batch is given up, the stream starts again with the wider one and meets the same files: none of their
columns is lost, and nothing is stored twice, for the batch keeps its number.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StructField,
    StructType,
)

from stratalake.sources.readers import file_stream

#: Each type holds all values of the ones it is reached from.
_WIDER = {
    ByteType: (ShortType, IntegerType, LongType, DoubleType),
    ShortType: (IntegerType, LongType, DoubleType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
}
#: Files are looked at again when they were modified this long before the newest known one.
OVERLAP_SECONDS = 2
STORED = "version bigint, schema_json string, known_until string"


class SchemaConflictError(TypeError):
    """A column changed to a type that does not hold its earlier values."""


class _SchemaWidened(Exception):
    """A micro-batch may hold columns that its schema lacks."""


def widen_type(old: DataType, new: DataType, name: str = "") -> DataType:
    """The type that holds the values of both."""
    if old == new:
        return old
    if isinstance(old, StructType) and isinstance(new, StructType):
        return widen_schema(old, new, f"{name}." if name else "")
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(widen_type(old.elementType, new.elementType, name))
    if isinstance(old, MapType) and isinstance(new, MapType):
        return MapType(widen_type(old.keyType, new.keyType, name), widen_type(old.valueType, new.valueType, name))
    if isinstance(new, _WIDER.get(type(old), ())):
        return new
    if isinstance(old, _WIDER.get(type(new), ())):
        return old
    raise SchemaConflictError(f"column {name} changed from {old.simpleString()} to {new.simpleString()}")


def widen_schema(old: StructType, new: StructType, prefix: str = "") -> StructType:
    """Columns of both, all nullable; those of ``old`` first."""
    arrived = {f.name: f.dataType for f in new.fields}
    known = [StructField(f.name, widen_type(f.dataType, arrived.get(f.name, f.dataType), prefix + f.name)) for f in old.fields]
    return StructType(known + [StructField(f.name, f.dataType) for f in new.fields if f.name not in old.names])


def schema_of_files(spark: SparkSession, paths: Sequence[str]) -> StructType:
    """The widened schema of Parquet files, from their footers."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except Exception as failure:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in f"{getattr(failure, 'getCondition', str)()} {failure}":
            raise
    half = len(paths) // 2
    return widen_schema(schema_of_files(spark, paths[:half]), schema_of_files(spark, paths[half:]))


class SchemaStore:
    """Versions of the schema of one landing folder, kept under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def versions(self) -> DataFrame:
        try:
            return self.spark.read.schema(STORED).json(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], STORED)

    def _newest(self):
        return self.versions().orderBy(F.desc("version"), F.desc("known_until")).first()

    def schema(self) -> StructType | None:
        """The widest schema so far; None before the first file."""
        newest = self._newest()
        return StructType.fromJson(json.loads(newest["schema_json"])) if newest else None

    def new_files(self, landing: str, after: str | None) -> DataFrame:
        """(path, modified) of files modified after a moment; their content is not read."""
        reader = self.spark.read.format("binaryFile")
        if after:
            reader = reader.option("modifiedAfter", after)
        overlapping = F.col("modificationTime") - F.expr(f"INTERVAL {OVERLAP_SECONDS} SECOND")
        return reader.load(landing).select("path", F.date_format(overlapping, "yyyy-MM-dd'T'HH:mm:ss").alias("modified"))

    def refresh(self, landing: str) -> bool:
        """Take in the files that are new in ``landing``; True when they widened the schema."""
        newest = self._newest()
        try:
            found = self.new_files(landing, newest and newest["known_until"]).collect()  # paths of new files, as the stream lists them too
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            found = []
        if not found:
            return False
        arrived = schema_of_files(self.spark, [r["path"] for r in found])
        before = self.schema()
        after = widen_schema(before or arrived, arrived)
        until = max(r["modified"] for r in found)
        if newest and after == before and until == newest["known_until"]:
            return False
        row = (newest["version"] + (after != before) if newest else 0, after.json(), until)
        self.spark.createDataFrame([row], STORED).coalesce(1).write.mode("append").json(self.path)
        return after != before


def evolving_stream(
    spark: SparkSession,
    landing: str,
    store: SchemaStore,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    files_per_batch: int | None = None,
) -> int:
    """Hand the rows of all available files to ``apply``, batch by batch; returns how often the schema forced a new start.

    ``apply`` must overwrite what an earlier attempt of the same batch left.
    """
    store.refresh(landing)
    starts = 0
    while (schema := store.schema()) is not None:
        widened = []

        def guarded(batch: DataFrame, batch_id: int) -> None:
            if store.refresh(landing):
                widened.append(batch_id)
                raise _SchemaWidened(f"batch {batch_id} is read again with a wider schema")
            apply(batch, batch_id)

        stream = file_stream(spark, landing, schema, files_per_batch)
        query = stream.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
            return starts
        except StreamingQueryException:
            if not widened:
                raise
            starts += 1
    return starts
