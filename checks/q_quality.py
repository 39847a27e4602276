"""Row rules, quarantine, check report, value lists, tuning (Q, U, B)."""

from pyspark.sql import functions as F

from checks.domain import RULES
from checks.q_analytics import CENTS, JOB_SQL, VENDOR_SQL
from checks.registry import query
from stratalake.functions import enrich
from stratalake.functions.columns import hour_parts
from stratalake.operators import quality as q
from stratalake.operators import transforms as t
from stratalake.plans import brands as b
from stratalake.plans import trips as tr
from stratalake.tuning import cached, compare, settings, shuffle_partitions

# The rules in SQL of their own, unknown counting as failed.
RULE_SQL = {
    "pickup_datetime_not_null": "tpep_pickup_datetime IS NOT NULL",
    "dropoff_datetime_not_null": "tpep_dropoff_datetime IS NOT NULL",
    "dropoff_after_pickup": "coalesce(tpep_dropoff_datetime > tpep_pickup_datetime, FALSE)",
    "trip_within_period": "coalesce(year(tpep_pickup_datetime) BETWEEN 1996 AND 2000, FALSE)",
    "fare_amount_positive": "coalesce(fare_amount > 0, FALSE)",
    "total_amount_positive": "coalesce(total_amount > 0, FALSE)",
    "trip_distance_non_negative": "coalesce(trip_distance >= 0, FALSE)",
    "pu_location_valid": "coalesce(PULocationID >= 1 AND PULocationID <= 265, FALSE)",
    "do_location_valid": "coalesce(DOLocationID >= 1 AND DOLocationID <= 265, FALSE)",
    "payment_type_valid": "payment_type IS NULL OR payment_type IN (1, 2, 3, 4, 5, 6)",
}


@query("q1_to_q10_row_rules", "SELECT *, " + ", ".join(f"({s}) AS {n}" for n, s in RULE_SQL.items()) + " FROM typed_trips")
def _(d):
    return q.rule_flags(d.trips, RULES)


@query(
    "q17_rule_counts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {s}) AS passed, count(*) FILTER (WHERE NOT ({s})) AS failed FROM typed_trips"
        for n, s in RULE_SQL.items()
    ),
)
def _(d):
    return q.rule_counts(d.trips, RULES)


@query("q18_flag_rows", "SELECT * FROM flagged_trips")
def _(d):
    return q.flag_rows(d.trips, RULES, "2024-02-01 00:00:00")


@query(
    "q18_split_keeps_every_row",
    "SELECT is_quarantined AS rejected, count(*) AS n FROM flagged_trips GROUP BY 1",
)
def _(d):
    kept = q.clean(d.flagged).select(F.lit(False).alias("rejected"))
    return kept.unionByName(q.quarantined(d.flagged).select(F.lit(True).alias("rejected"))).groupBy("rejected").agg(
        F.count("*").alias("n")
    )


def _unchecked(d):
    """Typed shop events before any validation."""
    return t.conform(d.view("ecommerce_store"), t.STORE_EVENTS)


UNCHECKED = """(SELECT CASE WHEN event_time IS NULL THEN NULL ELSE CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) END AS event_time,
    event_type, user_session, TRY_CAST(price AS DOUBLE) AS price FROM ecommerce_store)"""
CHECK_SQL = {
    "row_count": f"SELECT 'row_count' AS check_name, 'hard' AS severity, count(*) AS value, count(*) > 0 AS passed FROM {UNCHECKED}",
    "null_event_times": f"""SELECT 'null_event_times' AS check_name, 'hard' AS severity, count(*) AS value, count(*) = 0 AS passed
FROM {UNCHECKED} WHERE event_time IS NULL""",
    "invalid_event_types": f"""SELECT 'invalid_event_types' AS check_name, 'hard' AS severity, count(*) AS value, count(*) = 0 AS passed
FROM (SELECT DISTINCT event_type FROM {UNCHECKED}) WHERE event_type IS NULL OR event_type NOT IN ('view', 'cart', 'purchase')""",
    "bad_prices": f"""SELECT 'bad_prices' AS check_name, 'hard' AS severity, count(*) AS value, count(*) = 0 AS passed
FROM {UNCHECKED} WHERE price IS NULL OR price <= 0""",
    "duplicate_sessions": f"""SELECT 'duplicate_sessions' AS check_name, 'soft' AS severity, count(*) AS value, count(*) = 0 AS passed
FROM (SELECT user_session FROM {UNCHECKED} GROUP BY 1 HAVING count(*) > 1)""",
}


def _register_check(number: int, check: str) -> None:
    @query(f"q{number}_{check}", CHECK_SQL[check])
    def _(d):
        return q.check_report(_unchecked(d), checks=[check])


for _number, _check in enumerate(CHECK_SQL, start=11):
    _register_check(_number, _check)


@query("q16_check_report", " UNION ALL ".join(CHECK_SQL.values()))
def _(d):
    return q.check_report(_unchecked(d))


@query("q16_first_hard_failure", "SELECT count(*) AS events, 'invalid_event_types' AS failed_check FROM ecommerce_store")
def _(d):
    try:
        q.enforce(q.check_report(_unchecked(d)))
        failed = "none"
    except q.DataQualityError as problem:
        failed = str(problem).split()[1]
    return d.view("ecommerce_store").agg(F.count("*").alias("events"), F.lit(failed).alias("failed_check"))


def _by_landing_hour(d):
    """Unchecked events in partitions by the hour in which they landed."""
    return _unchecked(d).withColumns(hour_parts(F.col("_ingestion_timestamp")))


HOURLY = """(SELECT year(t)::INT AS year, month(t)::INT AS month, day(t)::INT AS day, hour(t)::INT AS hour, * EXCLUDE (t)
FROM (SELECT CAST(_ingestion_timestamp AS TIMESTAMP) AS t, event_time, event_type, user_session, TRY_CAST(price AS DOUBLE) AS price FROM ecommerce_store))"""
HOURLY_SQL = f"""
WITH e AS {HOURLY},
r AS (SELECT year, month, day, hour, count(*) AS row_count, count(*) FILTER (WHERE event_time IS NULL) AS null_event_times,
        count(*) FILTER (WHERE price IS NULL OR price <= 0) AS bad_prices FROM e GROUP BY ALL),
k AS (SELECT year, month, day, hour, count(*) AS n, coalesce(string_agg(event_type, ',' ORDER BY event_type), '') AS types
      FROM (SELECT DISTINCT year, month, day, hour, event_type FROM e WHERE event_type IS NULL OR event_type NOT IN ('view', 'cart', 'purchase')) GROUP BY ALL),
s AS (SELECT year, month, day, hour, count(*) AS n FROM (SELECT year, month, day, hour, user_session FROM e GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL),
a AS (SELECT r.*, coalesce(k.n, 0) AS kinds, coalesce(types, '') AS invalid_types, coalesce(s.n, 0) AS sessions FROM r LEFT JOIN k USING (year, month, day, hour) LEFT JOIN s USING (year, month, day, hour))
SELECT year, month, day, hour, invalid_types, 'row_count' AS check_name, 'hard' AS severity, row_count AS value, row_count > 0 AS passed FROM a
UNION ALL SELECT year, month, day, hour, invalid_types, 'null_event_times', 'hard', null_event_times, null_event_times = 0 FROM a
UNION ALL SELECT year, month, day, hour, invalid_types, 'invalid_event_types', 'hard', kinds, kinds = 0 FROM a
UNION ALL SELECT year, month, day, hour, invalid_types, 'bad_prices', 'hard', bad_prices, bad_prices = 0 FROM a
UNION ALL SELECT year, month, day, hour, invalid_types, 'duplicate_sessions', 'soft', sessions, sessions = 0 FROM a"""


@query("q16_hourly_report", HOURLY_SQL)
def _(d):
    return q.hourly_report(_by_landing_hour(d))


@query(
    "q16_first_failure_by_hour",
    f"""SELECT year, month, day, hour, CASE WHEN bool_or(check_name = 'null_event_times' AND NOT passed) THEN 'null_event_times'
    WHEN bool_or(check_name = 'invalid_event_types' AND NOT passed) THEN 'invalid_event_types'
    WHEN bool_or(check_name = 'bad_prices' AND NOT passed) THEN 'bad_prices' END AS failed_check FROM ({HOURLY_SQL}) GROUP BY ALL""",
)
def _(d):
    return q.first_failures(q.hourly_report(_by_landing_hour(d)))


# -- value lists ------------------------------------------------------------------------------


@query("u1_keyed_pick", "SELECT user_id, 1::BIGINT AS names, TRUE AS listed FROM silver_store GROUP BY user_id")
def _(d):
    named = d.store.select("user_id", enrich.pick(enrich.FIRST_NAMES, "user_id").alias("name"))
    return named.groupBy("user_id").agg(
        F.count_distinct("name").alias("names"), F.bool_and(F.col("name").isin(*enrich.FIRST_NAMES)).alias("listed")
    )


@query("u1_row_function", "SELECT count(*) AS rows, TRUE AS listed FROM silver_store")
def _(d):
    named = d.store.select(enrich.random_pick(enrich.FIRST_NAMES).alias("name"))
    return named.agg(F.count("*").alias("rows"), F.bool_and(F.col("name").isin(*enrich.FIRST_NAMES)).alias("listed"))


@query("u1_vectorised_pick", f"SELECT user_id, CASE user_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS label, count(*) AS n FROM silver_store GROUP BY 1, 2")
def _(d):
    return d.store.select("user_id", enrich.vectorised_pick("abc", "user_id").alias("label")).groupBy("user_id", "label").agg(
        F.count("*").alias("n")
    )


@query(
    "u2_users_with_attributes",
    "SELECT user_id, count(*) AS rows, count(DISTINCT user_session) AS sessions, 1::BIGINT AS variants, TRUE AS complete FROM silver_store GROUP BY user_id",
)
def _(d):
    attributes = F.struct("first_name", "last_name", "phone_number")
    return t.enrich_users(d.store).groupBy("user_id").agg(
        F.count("*").alias("rows"),
        F.count_distinct("user_session").alias("sessions"),
        F.count_distinct(attributes).alias("variants"),
        F.bool_and(F.col("first_name").isNotNull() & F.col("phone_number").rlike(r"^\d{10}$")).alias("complete"),
    )


# -- tuning -----------------------------------------------------------------------------------


@query("b1_cached_input", "SELECT event_type, count(*) AS n FROM silver_store GROUP BY 1")
def _(d):
    path = d.scratch("b1")
    with cached(d.store, fill=True) as store:
        store.groupBy("event_type").agg(F.count("*").alias("n")).write.parquet(path)
    return d.spark.read.parquet(path)


@query("b2_partition_and_adaptive_settings", VENDOR_SQL)
def _(d):
    path = d.scratch("b2")
    chosen = {"spark.sql.shuffle.partitions": str(shuffle_partitions(4, 2)), "spark.sql.adaptive.enabled": "false"}
    with settings(d.spark, chosen):
        tr.vendor_stats(d.trips, CENTS).write.parquet(path)
    return d.spark.read.parquet(path)


@query("b3_timed_variants", JOB_SQL)
def _(d):
    times = compare({"branches": lambda: b.brand_job(d.store, CENTS), "single pass": lambda: b.brand_job_single_pass(d.store, CENTS)}, rounds=1)
    assert all(seconds > 0 for runs in times.values() for seconds in runs)
    return b.brand_job_single_pass(d.store, CENTS)
