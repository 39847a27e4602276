from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.functions.columns import EVENT_TYPES
from stratalake.operators import quality as q

TRIP = (
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, fare_amount double, total_amount double, "
    "trip_distance double, PULocationID int, DOLocationID int, payment_type int"
)
GOOD = (datetime(2024, 5, 1, 8), datetime(2024, 5, 1, 9), 10.0, 12.0, 3.0, 1, 265, 1)


def broken(position, value):
    return tuple(value if n == position else v for n, v in enumerate(GOOD))


@pytest.mark.parametrize(
    "position, value, rule",
    [
        (0, None, "pickup_datetime_not_null"), (1, None, "dropoff_datetime_not_null"), (1, datetime(2024, 5, 1, 8), "dropoff_after_pickup"),
        (0, datetime(2023, 12, 31, 23), "trip_within_period"), (2, 0.0, "fare_amount_positive"), (2, None, "fare_amount_positive"),
        (3, -1.0, "total_amount_positive"), (4, -0.1, "trip_distance_non_negative"), (5, 0, "pu_location_valid"),
        (6, 266, "do_location_valid"), (7, 7, "payment_type_valid"),
    ],
)
def test_each_rule_sends_a_row_to_quarantine(frame, position, value, rule):
    rules, rows = q.trip_rules(), frame(TRIP, GOOD, broken(position, value))
    flagged = q.flag_rows(rows, rules, "2024-06-01")
    assert q.clean(flagged).count() == 1 and q.quarantined(flagged).count() == 1
    assert q.passing(rows, rules).count() == 1
    counts = {r["rule"]: (r["passed"], r["failed"]) for r in q.rule_counts(rows, rules).collect()}
    assert counts[rule] == (1, 1)
    assert not q.rule_flags(rows, rules).orderBy(F.col(rule)).first()[rule]


def test_unknown_payment_type_is_valid(frame):
    assert q.passing(frame(TRIP, broken(7, None)), q.trip_rules()).count() == 1


def test_strict_null_leaves_rows_on_neither_side(frame):
    rows = frame(TRIP, GOOD, broken(2, None))
    strict = q.flag_rows(rows, q.trip_rules(), "2024-06-01", strict_null=True)
    assert q.clean(strict).count() == 1 and q.quarantined(strict).count() == 0
    lenient = q.flag_rows(rows, q.trip_rules(), "2024-06-01")
    assert q.clean(lenient).count() + q.quarantined(lenient).count() == 2


EVENT = "event_time timestamp, event_type string, price double, user_session string"
NOON = datetime(2024, 1, 1, 12)


def test_report_values(frame):
    events = frame(
        EVENT, (NOON, "view", 1.0, "a"), (None, "view", 0.0, "a"), (NOON, "error", None, "b"), (NOON, None, 2.0, None), (NOON, None, 2.0, None)
    )
    report = {r["check_name"]: (r["value"], r["passed"]) for r in q.check_report(events).collect()}
    assert report == {
        "row_count": (5, True), "null_event_times": (1, False), "invalid_event_types": (2, False), "bad_prices": (2, False),
        "duplicate_sessions": (2, False),
    }
    assert {r[0] for r in q.invalid_values(events, "event_type", EVENT_TYPES).collect()} == {"error", None}


def test_soft_check_does_not_raise(frame):
    values = q.enforce(q.check_report(frame(EVENT, (NOON, "view", 1.0, "a"), (NOON, "cart", 1.0, "a"))))
    assert values == {"row_count": 2, "null_event_times": 0, "invalid_event_types": 0, "bad_prices": 0, "duplicate_sessions": 1}


@pytest.mark.parametrize(
    "rows, failed",
    [
        ([], "row_count"),
        ([(None, "error", 0.0, "a")], "null_event_times"),
        ([(NOON, "error", 0.0, "a")], "invalid_event_types"),
        ([(NOON, "view", 0.0, "a")], "bad_prices"),
    ],
)
def test_first_hard_failure_is_raised(spark, rows, failed):
    with pytest.raises(q.DataQualityError, match=failed):
        q.enforce(q.check_report(spark.createDataFrame(rows, EVENT)))


def test_a_report_of_one_check_runs_its_branch_only(spark):
    from checks.domain import Domain
    from stratalake.operators.quality import check_report
    from stratalake.operators import transforms as t

    events = t.conform(Domain(spark, "/root/testdata/sf0.001").view("ecommerce_store"), t.STORE_EVENTS)
    plan = lambda name: check_report(events, checks=[name])._jdf.queryExecution().executedPlan().toString()
    for name in ("row_count", "null_event_times", "bad_prices"):
        text = plan(name)
        assert text.count("FileScan") == 1 and "user_session" not in text and text.count("HashAggregate") == 2
    assert plan("invalid_event_types").count("FileScan") == 1 and "user_session" not in plan("invalid_event_types")
    assert "price" not in plan("duplicate_sessions")


HOURLY = "year int, month int, day int, hour int, event_time timestamp, event_type string, price double, user_session string"


def test_checks_of_one_hour_stop_at_the_first_hard_failure(spark, frame):
    from datetime import datetime

    from stratalake.operators.quality import first_failures, hourly_report, run_checks

    at = datetime(2024, 1, 1)
    events = frame(
        HOURLY,
        (2024, 1, 1, 0, at, "view", 1.0, "a"), (2024, 1, 1, 0, at, "view", 1.0, "a"),
        (2024, 1, 1, 1, at, "swap", None, "b"), (2024, 1, 1, 1, at, None, 1.0, "b"), (2024, 1, 1, 1, at, "gift", 1.0, "c"),
        (2024, 1, 1, 2, None, "gift", 0.0, "c"),
        (2024, 1, 1, 3, at, "cart", 0.0, "c"),
    )
    assert run_checks(events, datetime(2024, 1, 1, 0)) == {"row_count": 2, "null_event_times": 0, "invalid_event_types": 0, "bad_prices": 0, "duplicate_sessions": 1}
    for hour, message in ((1, r"invalid_event_types .*\[None, 'gift', 'swap'\]"), (2, "null_event_times"), (3, "bad_prices"), (4, "row_count")):
        with pytest.raises(q.DataQualityError, match=message):
            run_checks(events, datetime(2024, 1, 1, hour))
    report = hourly_report(events)
    assert {(r.hour, r.failed_check) for r in first_failures(report).collect()} == {(0, None), (1, "invalid_event_types"), (2, "null_event_times"), (3, "bad_prices")}
    assert {(r.hour, r.invalid_types) for r in report.collect()} == {(0, ""), (1, "gift,swap"), (2, "gift"), (3, "")}
    assert {r.value for r in report.where("hour = 1 AND check_name = 'invalid_event_types'").collect()} == {3}
