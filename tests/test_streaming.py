from datetime import datetime

import pytest

from stratalake.operators.cdc import fold_changes
from stratalake.operators.quality import clean, flag_rows, quarantined, trip_rules
from stratalake.operators.transforms import type_trips
from stratalake.sources.readers import file_stream
from stratalake.sources.snapshots import SnapshotTable
from stratalake.sources.writers import append_stream
from stratalake.streaming import flows
from checks.domain import Domain

SF = "/root/testdata/sf0.001"
CHANGE = "k int, s int, a int, b string"


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")

    def add(*rows):
        spark.createDataFrame(list(rows), CHANGE).coalesce(1).write.mode("append").parquet(path)
        return path

    return add


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_stream_fold_equals_batch_fold_with_late_rows(spark, tmp_path, landing, bag, ignore_nulls):
    table = SnapshotTable(spark, str(tmp_path / "t"), ["k"], buckets=3)
    deliveries = [
        [(1, 5, 1, "x"), (2, 1, 1, None)],
        [(1, 2, 9, "late"), (2, 3, None, "new"), (3, 1, 1, "c")],
        [(2, 2, 7, "late"), (1, 6, None, None)],
    ]
    for rows in deliveries:
        stream = file_stream(spark, landing(*rows), spark.createDataFrame([], CHANGE).schema).drop("_source_file")
        flows.fold_into(stream, table, "s", str(tmp_path / "progress"), "changes", ignore_nulls)
    everything = spark.createDataFrame([r for d in deliveries for r in d], CHANGE)
    expected = fold_changes(everything, ["k"], "s", ignore_nulls)
    assert bag(flows.current_rows(table, ignore_nulls), "k", "s", "a", "b") == bag(expected, "k", "s", "a", "b")
    assert table.version() == 3 and table.last_batch("changes") == 2
    newest = table.version()
    stream = file_stream(spark, landing((1, 1, 1, "again")), everything.schema).drop("_source_file")
    flows.fold_into(stream, table, "s", str(tmp_path / "lost-progress"), "changes", ignore_nulls)
    assert table.version() == newest
    flows.fold_into(stream, table, "s", str(tmp_path / "other-progress"), "another stream", ignore_nulls)
    assert bag(flows.current_rows(table, ignore_nulls), "k", "s", "a", "b") == bag(expected, "k", "s", "a", "b")


def test_branches_of_the_stream_equal_the_batch(spark, tmp_path, bag):
    raw = Domain(spark, SF).view("trips")
    landed, rules = str(tmp_path / "trips"), trip_rules("1996-01-01", "2001-01-01")
    raw.repartition(2).write.parquet(landed)
    stream = file_stream(spark, landed, raw.schema, files_per_batch=1)
    staged = flows.staging(flows.bronze(stream, datetime(2024, 1, 1), "b"), rules, "2024-02-01")
    flows.split_to_files(staged, str(tmp_path / "clean"), str(tmp_path / "bad"), str(tmp_path / "progress"))
    flagged = flag_rows(type_trips(raw), rules, "2024-02-01")
    columns = ["tpep_pickup_datetime", "fare_amount", "PULocationID"]
    assert bag(spark.read.parquet(str(tmp_path / "clean")), *columns) == bag(clean(flagged), *columns)
    assert bag(spark.read.parquet(str(tmp_path / "bad")), *columns) == bag(quarantined(flagged), *columns)
    assert clean(flagged).count() + quarantined(flagged).count() == raw.count()


def test_file_stream_reads_each_file_once(spark, tmp_path, landing):
    schema = spark.createDataFrame([], CHANGE).schema
    path, out = landing((1, 1, 1, "a")), str(tmp_path / "out")
    for expected in (1, 1, 2):
        if expected == 2:
            landing((2, 2, 2, "b"))
        append_stream(file_stream(spark, path, schema), out, str(tmp_path / "progress"))
        stored = spark.read.parquet(out)
        assert stored.count() == expected
    assert stored.where("_source_file LIKE '%landing%'").count() == 2
