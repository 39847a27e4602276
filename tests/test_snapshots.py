from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators.merge import merge_replace, merge_upsert
from stratalake.operators.scd2 import apply_scd2, open_versions
from stratalake.sources.snapshots import SnapshotTable, VersionNotFoundError, widen

DAY = [datetime(2024, 1, n) for n in range(1, 9)]
SCHEMA = "k int, v string, _is_deleted boolean"


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), ["k"], buckets=4)


def replace(target, source):
    return merge_replace(target, source, ["k"])


def test_versions_and_times(table, frame, bag):
    assert not table.exists() and table.version() is None and table.read_or_none() is None
    table.overwrite(frame("k int, v string", *[(n, "a") for n in range(20)]), DAY[0], "create")
    table.merge(frame("k int, v string", (3, "b"), (99, "b")), replace, DAY[2])
    assert table.version() == 1
    assert table.read(version=0).count() == 20 and table.read().count() == 21
    assert bag(table.read().where("v = 'b'"), "k") == [(3,), (99,)]
    assert table.read(as_of=DAY[1]).count() == 20 and table.read(as_of=DAY[2]).count() == 21
    assert [r["version"] for r in table.newest_versions().collect()] == [1, 0]
    with pytest.raises(VersionNotFoundError):
        table.read(version=7)
    with pytest.raises(VersionNotFoundError):
        table.read(as_of=datetime(2023, 1, 1))


def test_only_touched_buckets_are_rewritten(table, frame):
    table.overwrite(frame("k int, v string", *[(n, "a") for n in range(40)]), DAY[0])
    table.merge(frame("k int, v string", (5, "b")), replace, DAY[1])
    newest = table.history().orderBy(F.desc("version")).first()
    assert len(newest["rewritten"]) == 1 and newest["rows_written"] < 40
    assert table.read().count() == 40


def test_bucket_that_lost_all_rows(table, frame, bag):
    table.overwrite(frame(SCHEMA, (1, "a", False), (2, "b", False)), DAY[0])
    table.merge(frame(SCHEMA, (1, None, True), (2, None, True)), lambda t, s: merge_upsert(t, s, ["k"]), DAY[1])
    assert bag(table.read()) == []
    table.merge(frame(SCHEMA, (1, "z", False)), lambda t, s: merge_upsert(t, s, ["k"]), DAY[2])
    assert bag(table.read(), "k", "v") == [(1, "z")]


def test_data_of_a_broken_attempt_is_never_read(table, frame, bag, spark):
    table.overwrite(frame("k int, v string", (1, "a")), DAY[0])
    spark.createDataFrame([(9, "broken", 0)], "k int, v string, snap_bucket int").write.partitionBy("snap_bucket").parquet(
        f"{table.path}/data/snap_version=1"
    )
    assert bag(table.read()) == [(1, "a")]
    table.merge(frame("k int, v string", (2, "b")), replace, DAY[1])
    assert bag(table.read()) == [(1, "a"), (2, "b")]


def test_a_version_is_committed_once(table, frame):
    table.overwrite(frame("k int", (1,)), DAY[0])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table._commit(frame("k int", (2,)), "x", None, set(), frame("k int", (2,)).schema, DAY[1])


def test_new_columns_and_changed_types(spark, tmp_path, frame, bag):
    log = SnapshotTable(spark, str(tmp_path / "log"))
    log.append(frame("a int", (1,)), DAY[0])
    log.append(frame("a int, b string", (2, "x")), DAY[1])
    log.append(frame("b string", ("y",)), DAY[2])
    assert bag(log.read()) == sorted([(1, None), (2, "x"), (None, "y")], key=repr)
    assert log.read(version=0).columns == ["a"]
    with pytest.raises(TypeError, match="column a"):
        log.append(frame("a string", ("1",)), DAY[3])
    assert widen(frame("a int", (1,)).schema, frame("c int, a int", (1, 2)).schema).names == ["a", "c"]


def test_source_key_of_another_integer_type_meets_its_bucket(table, frame, bag):
    table.overwrite(frame("k int, v string", *[(n, "a") for n in range(10)]), DAY[0])
    table.merge(frame("k bigint, v string", *[(n, "b") for n in range(10)]), replace, DAY[1])
    assert set(bag(table.read(), "v")) == {("b",)} and table.read().count() == 10


def test_closed_history_is_only_added_to(spark, tmp_path, frame, bag):
    table = SnapshotTable(spark, str(tmp_path / "h"), ["k"], 4, append_only=~F.col("is_current"))
    table.overwrite(open_versions(frame("k int, a string", *[(n, "x") for n in range(12)]), DAY[0]), DAY[0])
    for n in (1, 2):
        source = frame("k int, a string", (3, f"v{n}"))
        table.merge(source, lambda t, s, n=n: apply_scd2(t, s, ["k"], ["a"], DAY[n]), DAY[n])
    rows = table.read()
    assert rows.count() == 14 and rows.where("is_current").count() == 12
    assert bag(rows.where("k = 3"), "a", "is_current") == [("v1", False), ("v2", True), ("x", False)]
    assert all(-1 not in r["rewritten"] for r in table.history().collect())
    assert [f["version"] for f in table._state().folders if f["bucket"] == -1] == [1, 2]
    assert table.read(version=1).count() == 13


def test_overwrite_drops_old_rows_and_keeps_old_versions(table, frame, bag):
    table.overwrite(frame("k int, v string", *[(n, "a") for n in range(30)]), DAY[0])
    table.overwrite(frame("k int, v string", (1, "only")), DAY[1])
    assert bag(table.read()) == [(1, "only")] and table.read(version=0).count() == 30


def test_sql_over_a_version(table, frame, spark):
    table.overwrite(frame("k int, v string", (1, "a")), DAY[0])
    table.append(frame("k int, v string", (2, "a")), DAY[1])
    table.register("before_append", version=0)
    assert spark.sql("SELECT count(*) FROM before_append").first()[0] == 1


def test_watermark_and_folder_skipping_from_the_history(spark, tmp_path, frame, bag):
    schema = "k int, v string, _is_deleted boolean, _ingestion_timestamp timestamp"
    table = SnapshotTable(spark, str(tmp_path / "w"), ["k"], buckets=8)
    table.overwrite(frame(schema, *[(n, "a", False, DAY[0]) for n in range(30)]), DAY[0])
    table.merge(frame(schema, (5, "b", False, DAY[3])), lambda t, s: merge_upsert(t, s, ["k"]), DAY[3])
    assert table.watermark() == DAY[3]
    newer = table.read(newer_than=DAY[0])
    assert len(newer.inputFiles()) < len(table.read().inputFiles())
    assert bag(newer.where(F.col("_ingestion_timestamp") > DAY[0]), "k") == [(5,)]
    assert table.read(newer_than=DAY[3]).isEmpty()
    table.merge(frame(schema, (5, None, True, DAY[4])), lambda t, s: merge_upsert(t, s, ["k"]), DAY[4])
    assert table.watermark() == table.read().agg(F.max("_ingestion_timestamp")).first()[0] == DAY[0]
    log = SnapshotTable(spark, str(tmp_path / "untimed"))
    log.append(frame("a int", (1,)), DAY[0])
    assert log.watermark() is None and log.read(newer_than=DAY[5]).count() == 1
