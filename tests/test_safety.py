"""Rows that must not be lost or doubled, and values at the edges."""

from datetime import datetime

import pytest

from stratalake.functions.enrich import vectorised_pick
from stratalake.functions.numeric import Fixed
from stratalake.operators import scd2
from stratalake.operators.merge import merge_upsert
from stratalake.sources.readers import file_stream
from stratalake.sources.snapshots import LayoutError, SnapshotTable
from stratalake.streaming import flows

DAY = [datetime(2024, 1, n) for n in range(1, 6)]
CHANGE = "k int, s int, a int"


@pytest.fixture
def stream(spark, tmp_path):
    def read(name, *rows):
        path = str(tmp_path / name)
        made = spark.createDataFrame(list(rows), CHANGE)
        made.coalesce(1).write.mode("append").parquet(path)
        return file_stream(spark, path, made.schema).drop("_source_file")

    return read


def test_new_checkpoint_with_new_rows(spark, tmp_path, stream, bag):
    table = SnapshotTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    flows.fold_into(stream("one", (1, 1, 1), (2, 1, 1)), table, "s", str(tmp_path / "p1"), "changes")
    flows.fold_into(stream("two", (3, 1, 1), (1, 2, 9)), table, "s", str(tmp_path / "p2"), "changes")
    assert bag(flows.current_rows(table), "k", "s", "a") == [(1, 2, 9), (2, 1, 1), (3, 1, 1)]
    newest = table.version()
    flows.fold_into(stream("two"), table, "s", str(tmp_path / "p3"), "changes")
    assert table.version() == newest


def test_split_keeps_every_run(spark, tmp_path, stream):
    from pyspark.sql import functions as F

    for n in range(2):
        staged = stream("in", (n, 1, 1), (n, 2, 2)).withColumns({"is_quarantined": F.col("s") == 1, "_dq_checked_at": F.lit("x")})
        flows.split_to_files(staged, str(tmp_path / "clean"), str(tmp_path / "bad"), str(tmp_path / f"p{n}"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 3
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 3


def test_layout_is_kept(spark, tmp_path, frame, bag):
    path = str(tmp_path / "t")
    SnapshotTable(spark, path, ["k"], buckets=4).overwrite(frame("k int, _is_deleted boolean, v string", *[(n, False, "a") for n in range(20)]))
    change = frame("k int, _is_deleted boolean, v string", (3, False, "b"))
    for other in (SnapshotTable(spark, path, ["k"], buckets=8), SnapshotTable(spark, path, ["v"], buckets=4)):
        with pytest.raises(LayoutError):
            other.merge(change, lambda t, s: merge_upsert(t, s, ["k"]))
    SnapshotTable(spark, path).append(frame("k int, _is_deleted boolean, v string", (99, False, "new")))
    table = SnapshotTable(spark, path, ["k"], buckets=4)
    table.merge(frame("k int, _is_deleted boolean, v string", (99, False, "newer")), lambda t, s: merge_upsert(t, s, ["k"]))
    assert table.read().count() == 21 and bag(table.read().where("k = 99"), "v") == [("newer",)]


def test_broken_history_write_is_overwritten(spark, tmp_path, frame):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(frame("k int", (1,)))
    (tmp_path / "t" / "history" / "snap_version=1" / "_temporary").mkdir(parents=True)
    table.append(frame("k int", (2,)))
    assert table.version() == 1 and table.read().count() == 2


def test_intervals_of_a_null_key(frame):
    log = frame("k int, at timestamp", *[(None, d) for d in DAY[:3]], (1, DAY[0]))
    found = scd2.intervals(log, ["k"], "at").where("is_current").collect()
    assert sorted((r.k is None, r.effective_from) for r in found) == [(False, DAY[0]), (True, DAY[2])]


def test_one_join_for_a_history(frame):
    history = scd2.open_versions(frame("k int, a string", (1, "x")), DAY[0])
    plan = scd2.apply_scd2(history, frame("k int, a string", (1, "y")), ["k"], ["a"], DAY[1])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_halves_go_away_from_zero(frame):
    from pyspark.sql import functions as F

    row = frame("x double", (-1.5,), (1.5,), (-0.25,)).select(Fixed(2).round(F.col("x"), 0).alias("r")).collect()
    assert [r.r for r in row] == [-2.0, 2.0, 0.0]


def test_pick_of_large_keys_beside_null(frame):
    rows = frame("k bigint", (9007199254740993,), (None,), (4,)).select(vectorised_pick("abc", "k").alias("v")).collect()
    assert [r.v for r in rows] == ["abc"[9007199254740993 % 3], None, "b"]
