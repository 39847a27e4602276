from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.functions.columns import hour_parts
from stratalake.operators.lookups import broadcast_if_small, left_lookup, size_bound
from stratalake.sources import readers, writers
from stratalake.tuning import cached, compare, settings, shuffle_partitions

NOON, EVENING = datetime(2024, 5, 1, 12, 30), datetime(2024, 5, 1, 20, 0)


def test_json_values_stay_text(spark, tmp_path, frame):
    path = writers.json_snapshot(frame("a int, b double, c boolean", (1, 2.5, True)), str(tmp_path), "x", NOON)
    assert path.endswith("/x/2024-05-01_12")
    assert readers.json_as_text(spark, path).first().asDict() == {"a": "1", "b": "2.5", "c": "true"}


def test_csv_text_declared_inferred(spark, tmp_path, frame):
    path = str(tmp_path / "csv")
    frame("n string, t string", ("007", "a"), ("x", "b")).coalesce(1).write.option("header", True).csv(path)
    assert {r["n"] for r in readers.csv_as_text(spark, path).collect()} == {"007", "x"}
    assert {r["n"] for r in readers.csv_declared(spark, path, "n bigint, t string").collect()} == {7, None}
    numbers = str(tmp_path / "numbers")
    frame("LocationID int, z string", (1, "a")).write.option("header", True).csv(numbers)
    assert dict(readers.csv_inferred(spark, numbers).dtypes)["LocationID"] == "int"


def test_hourly_csv_replaces_only_its_hours(spark, tmp_path, frame):
    path = str(tmp_path / "hourly")
    writers.hourly_csv(frame("event_time string, v int", ("2024-05-01 12:10:00 UTC", 1), ("2024-05-01 13:00:00 UTC", 2)), path)
    writers.hourly_csv(frame("event_time string, v int", ("2024-05-01 13:30:00 UTC", 3)), path)
    stored = spark.read.option("header", True).csv(path)
    assert {(r["hour"], r["v"]) for r in stored.collect()} == {(12, "1"), (13, "3")}
    assert readers.hour_available(stored, NOON) and not readers.hour_available(stored, EVENING)


def test_missing_hours(frame, bag):
    present = frame("t timestamp", (NOON,)).withColumns(hour_parts(F.col("t")))
    expected = frame("year int, month int, day int, hour int", (2024, 5, 1, 12), (2024, 5, 1, 13))
    assert bag(readers.missing_hours(present, expected)) == [(2024, 5, 1, 13)]


def test_missing_table_and_folder(spark, tmp_path):
    with pytest.raises(readers.MissingSourceError):
        readers.table(spark, "nothing_here")
    assert not readers.folder_exists(spark, str(tmp_path / "nothing"))
    spark.range(1).write.parquet(str(tmp_path / "some"))
    assert readers.folder_exists(spark, str(tmp_path / "some"))


def test_broadcast_only_within_the_bound(spark, frame, tmp_path):
    unbounded = frame("id int, name string", (1, "a"), (2, "b"), (3, "c"))
    unbounded.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    facts = frame("fk int", (1,), (9,))

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(left_lookup(facts, broadcast_if_small(dim), "fk", "id"))
    assert "strategy=broadcast" not in plan(left_lookup(facts, broadcast_if_small(dim, size_bound(dim) - 1), "fk", "id"))
    assert "strategy=broadcast" not in plan(left_lookup(facts, broadcast_if_small(unbounded), "fk", "id"))


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, {"spark.sql.shuffle.partitions": "77", "spark.sql.adaptive.enabled": "false"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert shuffle_partitions(8) == 24


def test_cache_is_released(frame):
    df = frame("a int", (1,))
    with cached(df, fill=True) as kept:
        assert kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_compare_alternates(frame):
    order = []

    def variant(name):
        def build():
            order.append(name)
            return frame("a int", (1,))

        return build

    times = compare({"p": variant("p"), "q": variant("q")}, rounds=2)
    assert order == ["p", "q", "q", "p"] and all(len(v) == 2 for v in times.values())
