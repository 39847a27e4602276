"""Row rules with quarantine, and a check report for event tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.columns import EVENT_TYPES, all_of

QUARANTINED = "is_quarantined"


class DataQualityError(AssertionError):
    """A hard check failed."""


def trip_rules(start: str = "2024-01-01", end: str = "2025-01-01") -> dict[str, str]:
    """Named conditions a trip must meet; pickups are expected in ``[start, end)``."""
    # Rule names and bounds.
    return {
        "pickup_datetime_not_null": "tpep_pickup_datetime IS NOT NULL",
        "dropoff_datetime_not_null": "tpep_dropoff_datetime IS NOT NULL",
        "dropoff_after_pickup": "tpep_dropoff_datetime > tpep_pickup_datetime",
        "trip_within_period": f"tpep_pickup_datetime >= '{start}' AND tpep_pickup_datetime < '{end}'",
        "fare_amount_positive": "fare_amount > 0",
        "total_amount_positive": "total_amount > 0",
        "trip_distance_non_negative": "trip_distance >= 0",
        "pu_location_valid": "PULocationID BETWEEN 1 AND 265",
        "do_location_valid": "DOLocationID BETWEEN 1 AND 265",
        "payment_type_valid": "payment_type BETWEEN 1 AND 6 OR payment_type IS NULL",
    }


def passes(rule: str) -> Column:
    """The rule as a definite answer: unknown counts as failed, so no row falls between the sinks."""
    return F.coalesce(F.expr(f"({rule})"), F.lit(False))


def fails_any(rules: Mapping[str, str], strict_null: bool = False) -> Column:
    """True when at least one rule fails.

    ``strict_null=True`` keeps SQL's third value: a row whose only problem is an unknown rule gets
    NULL and belongs to neither side of the split.
    """
    if strict_null:
        return ~all_of(F.expr(f"({rule})") for rule in rules.values())
    return ~all_of(passes(rule) for rule in rules.values())


def flag_rows(
    df: DataFrame, rules: Mapping[str, str], checked_at: datetime | str, strict_null: bool = False
) -> DataFrame:
    return df.withColumns(
        {QUARANTINED: fails_any(rules, strict_null), "_dq_checked_at": F.lit(checked_at).cast("timestamp")}
    )


def quarantined(flagged: DataFrame) -> DataFrame:
    return flagged.where(f"{QUARANTINED} = true")


def clean(flagged: DataFrame) -> DataFrame:
    return flagged.where(f"{QUARANTINED} = false").drop(QUARANTINED, "_dq_checked_at")


def passing(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows that meet every rule, without a flag column.

    The rules stay separate conjuncts, so simple ones (``fare_amount > 0``) are pushed to the scan.
    """
    return df.where(all_of(F.expr(f"({rule})") for rule in rules.values()))


def rule_flags(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One boolean per rule next to the row, to see which rules a quarantined row broke."""
    return df.withColumns({name: passes(rule) for name, rule in rules.items()})


def rule_counts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Passed and failed rows per rule, in one pass over the data."""
    counted = df.agg(
        *[
            F.struct(F.count_if(passes(rule)).alias("passed"), F.count_if(~passes(rule)).alias("failed")).alias(name)
            for name, rule in rules.items()
        ]
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"{n}.passed"), F.col(f"{n}.failed")) for n in rules]
    )
    return counted.select(F.inline(rows))


def rule_metrics(rules: Mapping[str, str]) -> list[Column]:
    """The same counts as metrics for ``DataFrame.observe``, also on a stream."""
    return [F.count_if(~passes(rule)).alias(f"failed_{name}") for name, rule in rules.items()]


def in_hour(df: DataFrame, moment: datetime) -> DataFrame:
    """Rows of one hourly partition; the predicate holds partition columns only, so others are pruned."""
    return df.where(
        all_of(F.col(part) == F.lit(getattr(moment, part)) for part in ("year", "month", "day", "hour"))
    )


def invalid_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct values outside the allowed set; NULL is invalid."""
    valid = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.where(~valid).select(column).distinct()


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values on more than one row, with their count."""
    return df.groupBy(column).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


# Check names with severity, in the order in which failures are reported.
CHECKS = {
    "row_count": "hard",
    "null_event_times": "hard",
    "invalid_event_types": "hard",
    "bad_prices": "hard",
    "duplicate_sessions": "soft",
}


def _bad_price() -> Column:
    return F.col("price").isNull() | (F.col("price") <= 0)


def _judged(values: DataFrame, *more: str) -> DataFrame:
    severity = F.element_at(F.create_map(*[F.lit(x) for pair in CHECKS.items() for x in pair]), F.col("check_name"))
    passed = F.when(F.col("check_name") == "row_count", F.col("value") > 0).otherwise(F.col("value") == 0)
    return values.select(*more, "check_name", severity.alias("severity"), "value", passed.alias("passed"))


def check_report(events: DataFrame, moment: datetime | None = None, checks: Sequence[str] = tuple(CHECKS)) -> DataFrame:
    """Rows ``(check_name, severity, value, passed)`` for an event table, or for one hour of it.

    Only the named ``checks`` are in the plan. The checks on rows share one global aggregate; invalid types
    and repeated sessions are branches of their own, each over its one column.
    """
    part = events if moment is None else in_hour(events, moment)
    of_rows = {"row_count": F.count("*"), "null_event_times": F.count_if(F.col("event_time").isNull()), "bad_prices": F.count_if(_bad_price())}
    together = [c for c in checks if c in of_rows]
    branches = []
    if together:
        counted = part.agg(*[of_rows[c].alias(c) for c in together])
        branches.append(counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("value")) for c in together]))))
    alone = {
        "invalid_event_types": lambda: invalid_values(part, "event_type", EVENT_TYPES),
        "duplicate_sessions": lambda: repeated_values(part, "user_session"),
    }
    branches += [alone[c]().agg(F.count("*").alias("value")).select(F.lit(c).alias("check_name"), "value") for c in checks if c in alone]
    return _judged(reduce(DataFrame.unionByName, branches))


PARTS = ("year", "month", "day", "hour")


def hourly_report(events: DataFrame) -> DataFrame:
    """The report of every hourly partition at once, with the invalid event types found in it.

    Rows are pre-aggregated per hour; repeated sessions are counted per (hour, session) first, so one large hour
    is spread over tasks. Only the different invalid values of an hour are listed.
    """
    hour = list(PARTS)
    rows = events.groupBy(*hour).agg(F.count("*").alias("row_count"), F.count_if(F.col("event_time").isNull()).alias("null_event_times"), F.count_if(_bad_price()).alias("bad_prices"))
    valid = F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    wrong = events.where(~valid).select(*hour, "event_type").distinct()
    kinds = wrong.groupBy(*hour).agg(F.count("*").alias("invalid_event_types"), F.array_sort(F.collect_list("event_type")).alias("invalid_types"))
    repeated = events.groupBy(*hour, "user_session").agg(F.count("*").alias("rows")).where("rows > 1")
    sessions = repeated.groupBy(*hour).agg(F.count("*").alias("duplicate_sessions"))
    known = rows.join(kinds, hour, "left").join(sessions, hour, "left").na.fill(0, ["invalid_event_types", "duplicate_sessions"])
    listed = F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("value")) for c in CHECKS])
    found = known.select(*hour, F.concat_ws(",", "invalid_types").alias("invalid_types"), F.inline(listed))
    return _judged(found, *hour, "invalid_types")


def first_failures(report: DataFrame) -> DataFrame:
    """Per hour the first hard check that failed, in the order of `CHECKS`, or NULL; soft ones never stop an hour."""
    place = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(CHECKS) for x in (c, i)]), F.col("check_name"))
    failed = (F.col("severity") == "hard") & ~F.col("passed")
    return report.groupBy(*PARTS).agg(F.min_by("check_name", F.when(failed, place)).alias("failed_check"), F.min(F.when(failed, place)).alias("_place")).select(
        *PARTS, F.when(F.col("_place").isNotNull(), F.col("failed_check")).alias("failed_check")
    )


def run_checks(events: DataFrame, moment: datetime) -> dict[str, int | list]:
    """The checks of one hour one after the other: a hard one that fails stops the rest, repeated sessions are looked for last."""
    part = in_hour(events, moment)
    results: dict[str, int | list] = {}
    for name, severity in CHECKS.items():
        row = check_report(part, checks=[name]).first()
        results[name] = row["value"]
        if severity == "hard" and not row["passed"]:
            if name == "invalid_event_types":
                found = invalid_values(part, "event_type", EVENT_TYPES).limit(LISTED).collect()
                results[name] = sorted((r[0] for r in found), key=str)
            raise DataQualityError(f"check {name} failed in hour {moment:%Y-%m-%d %H}:00 with value {results[name]}")
    return results


#: Invalid values that an error message lists.
LISTED = 20


def enforce(report: DataFrame) -> dict[str, int]:
    """Values by check; raises on the first failed hard check. The report has one row per check."""
    results = {row["check_name"]: row for row in report.collect()}
    for name, severity in CHECKS.items():
        if severity == "hard" and not results[name]["passed"]:
            raise DataQualityError(f"check {name} failed with value {results[name]['value']}")
    return {name: results[name]["value"] for name in CHECKS}
