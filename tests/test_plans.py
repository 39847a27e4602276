"""Analytics: variants agree, and plans have the intended shape."""

import pytest
from pyspark.sql import functions as F

from checks.domain import CHANGE_KEYS, RULES, Domain
from stratalake.functions.numeric import PLAIN, Fixed
from stratalake.operators import cdc, merge, quality
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.incremental import newer_than
from stratalake.plans import brands, sales, trips
from stratalake.sources.snapshots import SnapshotTable
from stratalake.tuning import settings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def domain(spark):
    return Domain(spark, SF)


def plan_of(df, part="executedPlan"):
    return getattr(df._jdf.queryExecution(), part)().toString()


def close(left, right):
    assert left.columns == right.columns
    ours, theirs = sorted(left.collect(), key=repr), sorted(right.collect(), key=repr)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        for x, y in zip(a, b):
            assert x == (pytest.approx(y, rel=1e-9, abs=1e-9) if isinstance(y, float) else y)


def test_single_pass_brand_job_equals_branches(domain):
    close(brands.brand_job_single_pass(domain.store, Fixed(2)), brands.brand_job(domain.store, Fixed(2)))


def test_brand_job_without_carts_or_views(frame):
    schema = "event_type string, brand string, price double, user_id int, product_id int, category_id int"
    events = frame(
        schema, ("purchase", "a", 2.0, 1, 1, 1), ("purchase", None, 3.0, 1, 1, 1), ("view", None, 1.0, 2, 2, 2),
        ("view", "b", 1.0, 2, 2, 2), ("error", "a", 1.0, 3, None, 3),
    )
    close(brands.brand_job_single_pass(events), brands.brand_job(events))


def test_tuned_trip_reports_equal_plain_ones(domain):
    exact = Fixed(2)
    tuned, plain = (trips.trip_reports(domain.trips, domain.zone_file, exact, tuned=t) for t in (True, False))
    for name in tuned:
        close(tuned[name], plain[name])


def test_fixed_totals_agree_with_double_arithmetic(domain):
    by_zone = lambda math: domain.trips.groupBy("PULocationID").agg(
        math.total(F.col("total_amount")).alias("t"), math.mean(F.col("tip_amount")).alias("m")
    )
    close(by_zone(Fixed(2)), by_zone(PLAIN))


def test_fixed_totals_do_not_depend_on_the_partitioning(domain):
    total = lambda df: df.agg(Fixed(2).total(F.col("total_amount"))).first()[0]
    assert total(domain.trips) == total(domain.trips.repartition(13, "DOLocationID"))


def test_unique_transactions_give_the_same_summary(domain):
    build = lambda flag: sales.customer_sales_summary(domain.customers, domain.transactions, "2024-01-01", flag)
    close(build(True), build(False))
    assert "Expand" in plan_of(build(False), "optimizedPlan") and "Expand" not in plan_of(build(True), "optimizedPlan")


def test_summary_reads_current_rows_of_a_history(domain):
    history = domain.history_one
    summary = sales.customer_sales_summary(history, domain.transactions, "2024-01-01")
    assert summary.count() == history.where("is_current").count()


def test_customer_without_sales_has_null_measures(frame):
    customers = frame("customerID bigint, first_name string, last_name string, email_address string, city string, state string, country string", (1, None, "B", "e", "c", "s", "x"))
    sold = frame("customerID bigint, totalPrice bigint, transactionID bigint, quantity bigint, franchiseID bigint, dateTime string", (2, 5, 1, 1, 1, "t"))
    row = sales.customer_sales_summary(customers, sold, "2024-01-01").first()
    assert row["full_name"] == "B" and row["total_spent"] is None and row["total_transactions"] is None


def test_summary_drops_small_routes(domain):
    assert trips.trip_summary(domain.clean_trips, domain.zones).where("total_trips < 5").isEmpty()
    everything = trips.trip_summary(domain.clean_trips, domain.zones, min_trips=1)
    assert everything.agg(F.sum("total_trips")).first()[0] > 0


# -- plan shapes ------------------------------------------------------------------------------


def test_latest_row_is_limited_below_the_shuffle(domain):
    plan = plan_of(latest_per_key(domain.changes, CHANGE_KEYS, "changed_at"))
    partial, shuffle = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan and shuffle < partial


def test_folding_aggregates_below_the_shuffle(domain):
    plan = plan_of(cdc.fold_changes(domain.changes, CHANGE_KEYS, "changed_at"))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max")


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.sql("SELECT 1 AS k, timestamp'2024-01-01' AS _ingestion_timestamp, 'x' AS wide").write.parquet(path)
    sliced = newer_than(spark.read.parquet(path), spark.sql("SELECT timestamp'2023-01-01'").first()[0]).select("k")
    plan = plan_of(sliced)
    assert "GreaterThan(_ingestion_timestamp" in plan and "wide" not in plan.split("ReadSchema")[1]


def test_rules_reach_the_scan(spark, tmp_path, domain):
    path = str(tmp_path / "trips")
    domain.trips.write.parquet(path)
    with settings(spark, {"spark.sql.maxMetadataStringLength": "10000"}):
        plan = plan_of(quality.passing(spark.read.parquet(path), RULES).select("tip_amount"))
    assert "GreaterThan(fare_amount,0.0)" in plan and "IsNotNull(tpep_pickup_datetime)" in plan


def test_hour_filter_prunes_partitions(spark, tmp_path):
    from datetime import datetime

    path = str(tmp_path / "hourly")
    spark.sql("SELECT 1 AS v, 2024 AS year, 1 AS month, 1 AS day, id AS hour FROM range(3)").write.partitionBy("year", "month", "day", "hour").parquet(path)
    plan = plan_of(quality.in_hour(spark.read.parquet(path), datetime(2024, 1, 1, 2)))
    assert "(hour" in plan.split("PartitionFilters")[1].split("]")[0] and "PushedFilters: []" in plan


def test_trip_report_reads_only_its_columns_and_does_not_shuffle_trips(spark, tmp_path, domain):
    path = str(tmp_path / "trips")
    domain.trips.write.parquet(path)
    plan = plan_of(trips.pickup_stats(spark.read.parquet(path), domain.zone_file))
    schema = next(part for part in plan.split("ReadSchema: ")[1:] if "PULocationID" in part)
    assert "fare_amount" not in schema.split(">")[0]
    assert plan.index("Exchange hashpartitioning(PULocationID") < plan.index("partial_sum")


def test_small_merge_source_leaves_the_target_unshuffled(spark, tmp_path, domain):
    table = SnapshotTable(spark, str(tmp_path / "t"), CHANGE_KEYS, buckets=2)
    table.overwrite(domain.old_state)
    source = spark.createDataFrame(domain.new_batch.limit(5).collect(), domain.new_batch.schema)
    merged = merge.merge_upsert(table.read(), source, CHANGE_KEYS)
    merged.collect()
    plan = plan_of(merged)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]
