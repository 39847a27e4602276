"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   data folder           (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the session  (default 8)
BENCH_ROUNDS   timed runs per query  (default 3, the median counts)

The domain tables are stored once as Parquet before the timing, several files each, as the inputs
of such jobs are. Every run defines the query anew and writes all its rows to the no-op sink; cache
fills and commits are inside the timer. ``plain_forms`` holds
the branch form of the brand job and the five trip reports as they run without AQE, with 200 shuffle
partitions and without hints, and the brand job over a cached input with the cache filled inside
the timer; they are measured in the same session on the same data, in alternating order. ``spread`` holds the
fastest and slowest run of each query, ``jobs`` one run of each job that stores tables or streams.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.domain import AS_OF, CHANGE_KEYS, RULES, Domain
from stratalake.functions.numeric import PLAIN
from stratalake.operators import cdc, merge, quality, scd2
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.transforms import SYSTEM_COLUMNS
from stratalake.plans import brands, trips
from stratalake.plans.gold import SalesSummary
from stratalake.plans.layers import Lakehouse
from stratalake.plans.sales import customer_sales_summary
from stratalake.session import local_session
from stratalake.sources.snapshots import SnapshotTable
from stratalake.sources.writers import discard
from stratalake.streaming.chain import TripChain
from stratalake.tuning import cached, compare, settings

STORED = (
    "customers", "transactions", "store", "trips", "clean_trips", "zone_file", "zones", "changes",
    "old_state", "new_batch", "history_one", "day_two",
)
PLAIN_SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "200"}


def stored(d: Domain) -> SimpleNamespace:
    """The domain tables as Parquet folders of eight files (dimensions: one)."""
    base = d.scratch("bench")
    for name in STORED:
        files = 1 if name.startswith("zone") else 8
        getattr(d, name).repartition(files).write.parquet(f"{base}/{name}")
    return SimpleNamespace(**{name: d.spark.read.parquet(f"{base}/{name}") for name in STORED}, base=base)


def merge_into_table(spark: SparkSession, d: SimpleNamespace) -> Callable[[], DataFrame]:
    """A merge committed as a new version of a stored table of eight buckets."""
    table = SnapshotTable(spark, f"{d.base}/merged", CHANGE_KEYS, buckets=8)
    table.overwrite(d.old_state)

    def run() -> DataFrame:
        table.merge(d.new_batch, lambda target, source: merge.merge_upsert(target, source, CHANGE_KEYS))
        return spark.range(0)

    return run


def headline(spark: SparkSession, d: SimpleNamespace) -> dict[str, Callable[[], DataFrame]]:
    report = {
        "g5_pickup_stats": "pickup", "g6_dropoff_stats": "dropoff", "g7_payment_stats": "payment",
        "g8_hourly_volume": "hourly", "g9_vendor_stats": "vendor",
    }
    return {
        "g1_customer_sales_summary": lambda: customer_sales_summary(d.customers, d.transactions, AS_OF, True, PLAIN),
        "g4_brand_job_single_pass": lambda: brands.brand_job_single_pass(d.store),
        **{name: (lambda kind=kind: trips.trip_reports(d.trips, d.zone_file)[kind]) for name, kind in report.items()},
        "g11_revenue_by_borough": lambda: trips.revenue_by_borough(d.clean_trips, d.zones),
        "g12_trip_time_patterns": lambda: trips.trip_time_patterns(d.clean_trips),
        "g13_trip_summary": lambda: trips.trip_summary(d.clean_trips, d.zones),
        "w1_latest_row_per_key": lambda: latest_per_key(d.changes, CHANGE_KEYS, "changed_at"),
        "k5_merge_into_table": merge_into_table(spark, d),
        "k5_merge_upsert_delete": lambda: merge.merge_upsert(d.old_state, d.new_batch, CHANGE_KEYS),
        "t6_fold_ignoring_nulls": lambda: cdc.fold_changes(d.changes, CHANGE_KEYS, "changed_at", True),
        "x6_apply_history": lambda: scd2.apply_scd2(d.history_one, d.day_two, ["customerID"], ["city", "email_address"], AS_OF),
        "q17_rule_counts": lambda: quality.rule_counts(d.trips, RULES),
        "q16_check_report": lambda: quality.check_report(d.store),
    }


def plain_forms(spark: SparkSession, d: SimpleNamespace, rounds: int) -> dict[str, float]:
    def reports(tuned: bool) -> list[DataFrame]:
        return list(trips.trip_reports(d.trips, d.zone_file, tuned=tuned).values())

    def run_all(frames: list[DataFrame]) -> DataFrame:
        for frame in frames[:-1]:
            discard(frame)
        return frames[-1]

    def with_cache() -> DataFrame:
        with cached(d.store, fill=True) as store:
            discard(brands.brand_job(store))
        return spark.range(0)

    times = compare(
        {
            "brand_job_single_pass": lambda: brands.brand_job_single_pass(d.store),
            "brand_job_branches_adaptive": lambda: brands.brand_job(d.store),
            "brand_job_branches_cache_in_timer": with_cache,
            "trip_reports_tuned": lambda: run_all(reports(True)),
        },
        rounds,
    )
    with settings(spark, PLAIN_SETTINGS):
        times |= compare(
            {
                "brand_job_branches_plain": lambda: brands.brand_job(d.store),
                "trip_reports_plain": lambda: run_all(reports(False)),
            },
            rounds,
        )
    return {name: round(statistics.median(values), 3) for name, values in times.items()}


def jobs(spark: SparkSession, d: SimpleNamespace) -> dict[str, float]:
    """Seconds of one run of each job that stores something: an incremental load, a Gold refresh, the trip chain."""
    times = {}

    def timed(name: str, run: Callable[[], object]) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    house = Lakehouse(spark, f"{d.base}/house", buckets=8)
    bronze = house.table("bronze.sales_transactions")
    rows = d.transactions.withColumns({c: F.col(c).cast("string") for c in d.transactions.columns if c not in SYSTEM_COLUMNS})
    first, second = (F.col("transactionID").cast("bigint") % 10 != 0), (F.col("transactionID").cast("bigint") % 10 == 0)
    summary = SalesSummary(house)
    house.table("bronze.sales_customers").append(d.customers.withColumns({c: F.col(c).cast("string") for c in d.customers.columns if c not in SYSTEM_COLUMNS}))
    for name, part, moment in (("first", first, "2024-03-01"), ("increment", second, "2024-03-02")):
        bronze.append(rows.where(part).withColumn("_ingestion_timestamp", F.lit(moment).cast("timestamp")))
        timed(f"i8_{name}_load", summary.load)
        timed(f"i10_{name}_refresh", lambda: summary.refresh("2024-03-03"))
    d.trips.drop("_ingestion_timestamp").write.parquet(f"{d.base}/landing")
    timed("t1_to_t6_trip_chain", lambda: TripChain(spark, f"{d.base}/chain", RULES).run(f"{d.base}/landing", AS_OF, "bench", AS_OF))
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    d = stored(Domain(spark, sf_dir))
    queries = headline(spark, d)
    for build in queries.values():
        discard(build())
    times, spread = {}, {}
    for name, build in queries.items():
        taken = compare({name: build}, rounds)[name]
        times[name], spread[name] = round(statistics.median(taken), 3), [round(min(taken), 3), round(max(taken), 3)]
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "spread": spread,
        "plain_forms": plain_forms(spark, d, rounds),
        "jobs": jobs(spark, d),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
