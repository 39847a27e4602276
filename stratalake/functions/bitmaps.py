"""Exact distinct counts of whole-number ids by bitmaps that can be merged.

An id is a bit: its bucket of 32,768 ids, and a place in it. One row per (group, measure, bucket) holds the bits, built
below the shuffle and merged above it, so a group with most of all rows sends one row per bucket and input task.
Rows of several measures are listed beside each other, so no row is multiplied into grouping sets, and stored bitmaps
of hours add up to those of days. A bucket takes 4 kB: meant for ids that lie close together, as surrogate keys do;
scattered ids are cheaper by ``count_distinct``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURE, BUCKET, BITS = "measure", "bucket", "bits"


def bitmaps(df: DataFrame, groups: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """(groups, measure, bucket, bits) of the ids in the columns ``measures`` names; NULL is no id."""
    pairs = F.array(*[F.struct(F.lit(name).alias(MEASURE), F.col(c).cast("bigint").alias("_id")) for name, c in measures.items()])
    listed = df.select(*groups, F.inline(pairs)).where(F.col("_id").isNotNull())
    placed = listed.select(*groups, MEASURE, F.bitmap_bucket_number("_id").alias(BUCKET), F.bitmap_bit_position("_id").alias("_bit"))
    return placed.groupBy(*groups, MEASURE, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITS))


def merged(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return parts.groupBy(*groups, MEASURE, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(parts: DataFrame, groups: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Distinct ids per group and measure; ``parts`` holds every (group, measure, bucket) once."""
    ids = F.bitmap_count(BITS)
    return parts.groupBy(*groups).agg(*[F.coalesce(F.sum(F.when(F.col(MEASURE) == m, ids)), F.lit(0)).alias(m) for m in measures])
