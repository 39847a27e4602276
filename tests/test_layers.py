"""Load jobs over a temporary root."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators.incremental import between, newer_than, select_slice, split_deletes
from stratalake.operators.merge import DuplicateKeyError
from stratalake.operators.transforms import TRANSFORMS
from stratalake.plans.layers import STORE_LOADS, USER_HISTORY, Lakehouse, Load
from stratalake.sources.readers import MissingSourceError

DAY = [datetime(2024, 1, n) for n in range(1, 9)]
RAW = "k string, v string, _is_deleted boolean"


@pytest.fixture
def house(spark, tmp_path):
    TRANSFORMS["silver.t"] = lambda df: df.withColumn("k", F.col("k").try_cast("int")).dropna(subset=["k"])
    yield Lakehouse(spark, str(tmp_path / "house"), buckets=4)
    del TRANSFORMS["silver.t"]


JOB = Load("bronze.t", "silver.t", ["k"])


def test_load_cycle_with_update_delete_insert_and_late_rows(house, frame, bag):
    house.ingest(frame(RAW, ("1", "a", False), ("2", "b", False), ("x", "bad", False), ("3", "gone", True)), "bronze.t", "f0", DAY[0], "b0")
    assert house.load(JOB, as_of=DAY[0]) == 0
    assert bag(house.source("silver.t"), "k", "v") == [(1, "a"), (2, "b")]
    assert house.load(JOB, as_of=DAY[1]) is None
    house.ingest(frame(RAW, ("1", "A", False), ("2", None, True), ("4", "d", False)), "bronze.t", "f1", DAY[2], "b1")
    assert house.load(JOB, as_of=DAY[2]) == 1
    assert bag(house.source("silver.t"), "k", "v") == [(1, "A"), (4, "d")]
    metrics = house.table("silver.t").newest_versions(1).first()["metrics"]
    assert metrics == {"slice_rows": 3, "batch_rows": 3, "upserts": 2, "deletes": 1}
    house.ingest(frame(RAW, ("1", "late", False)), "bronze.t", "f2", DAY[1], "b2")
    assert house.load(JOB, as_of=DAY[3]) is None
    assert house.load(JOB, start="2024-01-01", end="2024-01-03", as_of=DAY[4]) == 2
    assert bag(house.source("silver.t"), "k", "v") == [(1, "late"), (4, "d")]


def test_empty_target_loads_everything_again(house, frame):
    house.ingest(frame(RAW, ("1", "a", True)), "bronze.t", "f", DAY[0], "b")
    house.load(JOB, as_of=DAY[0])
    assert house.source("silver.t").isEmpty()
    house.ingest(frame(RAW, ("1", "a", False)), "bronze.t", "f", DAY[1], "c")
    house.load(JOB, as_of=DAY[1])
    assert house.source("silver.t").count() == 1


def test_colliding_keys_raise_and_validation_first_resolves_them(house, frame, bag):
    house.ingest(frame(RAW, ("1", "a", False), ("01", "b", False)), "bronze.t", "f", DAY[0], "b")
    with pytest.raises(DuplicateKeyError):
        house.load(JOB, as_of=DAY[0])
    house.load(JOB, as_of=DAY[0], validate_first=True)
    assert bag(house.source("silver.t"), "k", "v") == [(1, "b")]


def test_missing_source_and_missing_transform(house, frame):
    with pytest.raises(MissingSourceError):
        house.load(JOB)
    house.ingest(frame(RAW, ("1", "a", False)), "bronze.t", "f", DAY[0], "b")
    with pytest.raises(ValueError, match="silver.unknown"):
        house.load(Load("bronze.t", "silver.unknown", ["k"]))


STORE_COLUMNS = (
    "event_time string, event_type string, product_id string, category_id string, category_code string, brand string, "
    "price string, user_id string, user_session string"
)


def store_rows(*seconds):
    kinds = (("view", "sony"), ("cart", "sony"), ("purchase", "apple"), ("error", None))
    return [
        (f"2024-01-01 10:00:0{second} UTC", kind, "1", "2", "c", brand, "5", "7", "s") for second, (kind, brand) in zip(seconds, kinds)
    ]


def store_counts(house):
    return {j.target.split("_")[1]: house.source(j.target).count() for j in STORE_LOADS}


def test_store_loads_follow_each_other(house, frame):
    house.ingest(frame(STORE_COLUMNS, *store_rows(0, 1, 2, 3)), "bronze.ecommerce_store", "f", DAY[0], "b")
    versions = house.load_all(STORE_LOADS, as_of=DAY[0])
    assert set(versions.values()) == {0}
    assert store_counts(house) == {"store": 4, "brands": 2, "purchases": 1, "views": 1, "carts": 1, "users": 1}
    house.load(USER_HISTORY, as_of=DAY[1])
    assert house.source(USER_HISTORY.target).where("is_current").count() == 1
    assert house.load(USER_HISTORY, as_of=DAY[2]) is None


def test_events_of_one_second_survive_when_the_type_is_filtered_first(house, frame):
    house.ingest(frame(STORE_COLUMNS, *store_rows(0, 0, 0, 0)), "bronze.ecommerce_store", "f", DAY[0], "b")
    house.load_all(STORE_LOADS, as_of=DAY[0], validate_first=True)
    assert store_counts(house) == {"store": 4, "brands": 2, "purchases": 1, "views": 1, "carts": 1, "users": 1}


def test_refresh_keeps_vanished_keys_and_materialize_does_not(house, frame, bag):
    for target, refresh in (("gold.a", True), ("gold.b", False)):
        for n, rows in enumerate([[(1, "x"), (2, "y")], [(2, "Y")]]):
            build = lambda rows=rows: frame("k int, v string", *rows)
            house.refresh(target, ["k"], build, DAY[n]) if refresh else house.materialize(target, build, DAY[n])
    assert bag(house.source("gold.a")) == [(1, "x"), (2, "Y")]
    assert bag(house.source("gold.b")) == [(2, "Y")]


def test_time_travel_report(house, frame):
    with pytest.raises(MissingSourceError):
        house.time_travel("gold.t")
    house.materialize("gold.t", lambda: frame("k int", (1,)), DAY[0])
    assert house.time_travel("gold.t") == {"current_version": 0, "previous_version": None}
    house.materialize("gold.t", lambda: frame("k int", (1,), (2,)), DAY[2])
    assert house.time_travel("gold.t", DAY[1]) == {
        "current_version": 1, "previous_version": 0, "previous_rows": 1, "rows_at_time": 1,
    }
    assert house.time_travel("gold.t", datetime(2020, 1, 1))["rows_at_time"] is None


def test_slices(frame, bag):
    rows = frame("k int, _ingestion_timestamp timestamp", *[(n, DAY[n]) for n in range(6)])
    assert bag(newer_than(rows, DAY[3]), "k") == [(4,), (5,)]
    assert newer_than(rows, None).count() == 6
    assert bag(between(rows, "2024-01-01", "2024-01-03"), "k") == [(1,)]
    assert bag(select_slice(rows, rows.where("k < 5")), "k") == [(5,)]
    assert select_slice(rows, rows, start="2024-01-02").isEmpty()
    text = rows.withColumn("_ingestion_timestamp", F.col("_ingestion_timestamp").cast("string"))
    assert bag(newer_than(text, DAY[4]), "k") == [(5,)]


def test_rows_with_unknown_delete_flag_are_on_no_side(frame):
    deletes, upserts = split_deletes(frame(RAW, ("1", "a", True), ("2", "b", False), ("3", "c", None)))
    assert (deletes.count(), upserts.count()) == (1, 1)


def test_folder_ingestion_and_absent_folder(house, frame, spark, tmp_path):
    path = str(tmp_path / "raw")
    with pytest.raises(MissingSourceError):
        house.ingest_files(path, "bronze.raw")
    frame("n int", (7,)).write.json(path)
    house.ingest_files(path, "bronze.raw", as_of=DAY[0], batch_id="b")
    row = house.source("bronze.raw").first()
    assert (row["n"], row["_source_file"], row["_batch_id"], row["_is_deleted"]) == ("7", path, "b", False)
