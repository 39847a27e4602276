"""Batch and stream sources."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratalake.operators.quality import in_hour

# Columns of the shop event export, in file order.
EVENT_FILE = (
    "event_time string, event_type string, product_id bigint, category_id bigint, "
    "category_code string, brand string, price double, user_id bigint, user_session string"
)


class MissingSourceError(LookupError):
    """A source table or folder is absent."""


def texts(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def json_as_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """JSON folder with every scalar kept as text.

    Without ``columns`` a first pass over all files finds them; with them the files are read once, and columns
    that a file lacks are NULL.
    """
    reader = spark.read.option("primitivesAsString", "true")
    return (reader.schema(texts(columns)) if columns else reader).json(path)


def csv_as_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV folder as text; declared ``columns`` must be those of the files, in their order."""
    reader = spark.read.option("header", "true")
    return (reader.schema(texts(columns)).option("enforceSchema", "false") if columns else reader).csv(path)


def csv_declared(spark: SparkSession, path: str, schema: str | StructType = EVENT_FILE) -> DataFrame:
    """CSV with a declared schema: one pass, unreadable fields become NULL."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with inferred types; inference reads the file twice, so for small lookup files only."""
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def parquet_files(spark: SparkSession, *globs: str) -> DataFrame:
    return spark.read.parquet(*globs)


def table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table or view; raises ``MissingSourceError`` when it does not exist."""
    if not spark.catalog.tableExists(name):
        raise MissingSourceError(f"source table {name} does not exist")
    return spark.read.table(name)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can see any file under ``path`` (a folder or a glob)."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def rows(spark: SparkSession, data: Sequence, schema: str | StructType) -> DataFrame:
    return spark.createDataFrame(data, schema)


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Files that no earlier run of the same checkpoint has read, with the path of each row's file.

    The schema is declared: columns that older files lack are NULL, and it is extended by passing
    the wider schema on the next start.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn("_source_file", F.col("_metadata.file_path"))


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def with_source_file(df: DataFrame) -> DataFrame:
    """Path of the file each row came from; works on any file scan."""
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def hour_available(hourly: DataFrame, moment: datetime) -> bool:
    """Gate for a job that needs one hourly partition; reads that partition only, one row at most."""
    return not in_hour(hourly, moment).isEmpty()


def missing_hours(hourly: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected hours without any row."""
    parts = ["year", "month", "day", "hour"]
    return expected.join(hourly.select(*parts).distinct(), parts, "left_anti")
