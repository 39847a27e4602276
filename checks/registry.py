"""Registration of queries with their comparison statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from checks.domain import Domain, with_views
from stratalake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
STATEMENTS: dict[str, str] = {}


def _zoneless(df: DataFrame) -> DataFrame:
    """Times as zone-less values, so a comparison does not depend on the reader's time zone."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


def query(name: str, sql: str | None = None):
    """Register ``build(domain) -> DataFrame`` under ``name``; ``sql`` must give the same rows."""

    def register(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: _zoneless(build(Domain(configure(spark), sf_dir)))
        if sql is not None:
            STATEMENTS[name] = with_views(sql)
        return build

    return register


# Rounded totals in SQL, as in ``stratalake.functions.numeric.Fixed(2)``.
def total(x: str) -> str:
    return f"(sum(CAST(floor({x} * 100 + 0.5) AS BIGINT)) / 100.0)"


def mean(x: str) -> str:
    return f"({total(x)} / count({x}))"


def rounded(x: str, digits: int) -> str:
    scale = float(10**digits)
    return f"(floor(({x}) * {scale} + 0.5) / {scale})"
