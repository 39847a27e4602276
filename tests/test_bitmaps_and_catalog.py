import random
import uuid

from pyspark.sql import functions as F

from checks.domain import Domain
from stratalake.functions.bitmaps import bitmaps, distinct_counts, merged
from stratalake.functions.numeric import Fixed
from stratalake.plans.brands import brand_job_single_pass
from stratalake.sources.catalog import drop_table, save_table
from stratalake.sources.readers import file_stream
from stratalake.sources.writers import append_stream
from stratalake.streaming import flows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bitmap_counts_equal_distinct_counts(spark, bag):
    rng = random.Random(2)
    ids = [None, 0, 1, -1, 32_767, 32_768, 32_769, -32_768, -32_769, 2**40, -(2**40)]
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 3), rng.choice(ids), rng.choice(ids)) for _ in range(300)] + [("only nulls", 1, None, None), ("half", 1, 5, None)]
    df = spark.createDataFrame(rows, "g string, h int, x bigint, y bigint")
    measures = {"xs": "x", "ys": "y"}
    plain = df.groupBy("g").agg(F.count_distinct("x").alias("xs"), F.count_distinct("y").alias("ys")).where("xs + ys > 0")
    assert bag(distinct_counts(bitmaps(df, ["g"], measures), ["g"], list(measures)), "g", "xs", "ys") == bag(plain, "g", "xs", "ys")
    parts = bitmaps(df, ["g", "h"], measures)
    assert bag(distinct_counts(merged(parts, ["g"]), ["g"], list(measures)), "g", "xs", "ys") == bag(plain, "g", "xs", "ys")


def test_brand_job_by_bitmaps_multiplies_no_row(spark):
    store = Domain(spark, "/root/testdata/sf0.001").store
    assert "Expand" in _plan(brand_job_single_pass(store, Fixed(2)))
    assert "Expand" not in _plan(brand_job_single_pass(store, Fixed(2), by_bitmaps=True))


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    left = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    right = spark.range(0, 3000, 3).selectExpr("id % 1000 AS rk", "id AS w")
    names = [f"t_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    try:
        a = save_table(left, names[0], str(tmp_path / "a"), 4, ["k"])
        b = save_table(right, names[1], str(tmp_path / "b"), 4, ["rk"])
        joined = a.join(b.hint("merge"), F.col("k") == F.col("rk")).groupBy("k").agg(F.count("*").alias("n"), F.max("w").alias("w"))
        assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
        plain = left.join(right, F.col("k") == F.col("rk")).groupBy("k").agg(F.count("*").alias("n"), F.max("w").alias("w"))
        assert joined.exceptAll(plain).isEmpty() and joined.count() == plain.count()
        assert "Exchange" in _plan(plain)
    finally:
        for name in names:
            drop_table(spark, name)
    assert not spark.catalog.tableExists(names[0])


def test_repeats_are_dropped_and_late_rows_too(spark, tmp_path):
    schema = "id int, at timestamp"
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliveries = (
        [(1, "2024-01-10"), (2, "2024-01-12"), (2, "2024-01-12")],
        [(1, "2024-01-10"), (3, "2024-01-11"), (4, "2024-01-01")],  # a repeat, a row in time, and one behind the watermark
        [(5, "2024-02-01")],
        [(2, "2024-01-31")],  # long forgotten, so it is a row of its own
    )
    for rows in deliveries:
        df = spark.createDataFrame(rows, "id int, at string").select("id", F.col("at").cast("timestamp").alias("at"))
        df.coalesce(1).write.mode("append").parquet(landing)
        stream = file_stream(spark, landing, df.schema).drop("_source_file")
        append_stream(flows.without_repeats(stream, ["id"], "at", "3 days"), out, str(tmp_path / "progress"))
    kept = sorted((r.id, str(r.at)[:10]) for r in spark.read.schema(schema).parquet(out).collect())
    assert kept == [(1, "2024-01-10"), (2, "2024-01-12"), (2, "2024-01-31"), (3, "2024-01-11"), (5, "2024-02-01")]
