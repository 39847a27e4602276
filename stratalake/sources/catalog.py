"""Catalog tables that keep their rows in buckets of the join key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.readers import table


def save_table(df: DataFrame, name: str, path: str | None = None, buckets: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Create or replace a catalog table from a query and return it as read by name.

    With ``buckets`` rows are dealt by the hash that the reader expects, one sorted file per bucket, so tables with equal
    buckets are joined, and grouped, by their keys without a shuffle. A key with a large share of the rows
    makes one large bucket: keep such a table without buckets, so that AQE can split the key.
    """
    rows = df.repartition(buckets, *keys) if buckets else df
    writer = rows.write.format("parquet").mode("overwrite")
    if buckets:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return table(df.sparkSession, name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Take a table out of the catalog; files of a table with a path of its own stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
