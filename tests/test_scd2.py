import pytest

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators import scd2
from stratalake.operators.incremental import inject_change

ROW = "k int, a string, b string"
HISTORY = ROW + ", effective_from timestamp, effective_to timestamp, is_current boolean"
DAY = [datetime(2024, 1, n) for n in range(1, 9)]


def start(frame, *rows):
    return scd2.open_versions(frame(ROW, *rows), DAY[0])


def test_changed_new_and_untouched_keys(frame, bag):
    history = start(frame, (1, "x", "p"), (2, "y", "q"))
    after = scd2.apply_scd2(history, frame(ROW, (1, "X", "p"), (2, "y", "q"), (3, "z", "r")), ["k"], ["a", "b"], DAY[1])
    assert bag(after) == sorted(
        [
            (1, "x", "p", DAY[0], DAY[1], False),
            (1, "X", "p", DAY[1], None, True),
            (2, "y", "q", DAY[0], None, True),
            (3, "z", "r", DAY[1], None, True),
        ],
        key=repr,
    )


def test_same_delivery_again_changes_nothing(frame, bag):
    source = frame(ROW, (1, "X", None), (3, "z", "r"))
    once = scd2.apply_scd2(start(frame, (1, "x", "p")), source, ["k"], ["a", "b"], DAY[1])
    assert bag(scd2.apply_scd2(once, source, ["k"], ["a", "b"], DAY[2])) == bag(once)


def test_change_from_and_to_null(frame):
    history, source = start(frame, (1, None, "p"), (2, "y", "q")), frame(ROW, (1, "x", "p"), (2, None, "q"))
    assert scd2.apply_scd2(history, source, ["k"], ["a"], DAY[1]).count() == 4
    assert scd2.apply_scd2(history, source, ["k"], ["a"], DAY[1], null_safe=False).count() == 2


def test_closed_key_opens_again(frame, bag):
    closed = frame(HISTORY, (1, "x", "p", DAY[0], DAY[1], False))
    after = scd2.apply_scd2(closed, frame(ROW, (1, "x", "p")), ["k"], ["a"], DAY[3])
    assert bag(after, "effective_from", "is_current") == [(DAY[0], False), (DAY[3], True)]


def test_rows_without_a_key_are_not_stored(frame):
    assert scd2.apply_scd2(start(frame, (1, "x", "p")), frame(ROW, (None, "n", "n")), ["k"], ["a"], DAY[1]).count() == 1


deliveries = st.lists(st.dictionaries(st.integers(0, 3), st.sampled_from(["x", "y", None]), max_size=4), min_size=1, max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(deliveries=deliveries)
def test_laws_over_several_deliveries(spark, deliveries):
    history = spark.createDataFrame([], "k int, a string, effective_from timestamp, effective_to timestamp, is_current boolean")
    expected = {}
    for n, delivery in enumerate(deliveries):
        source = spark.createDataFrame(list(delivery.items()), "k int, a string")
        rows = scd2.apply_scd2(history, source, ["k"], ["a"], DAY[n]).collect()
        history = spark.createDataFrame(rows, history.schema)
        for k, a in delivery.items():
            versions = expected.setdefault(k, [])
            if not versions or versions[-1][0] != a:
                versions.append((a, DAY[n]))
    stored = {}
    for row in sorted(history.collect(), key=lambda r: (r["k"], r["effective_from"])):
        stored.setdefault(row["k"], []).append(row)
    assert {k: [(r["a"], r["effective_from"]) for r in v] for k, v in stored.items()} == expected
    for versions in stored.values():
        assert [r["is_current"] for r in versions] == [False] * (len(versions) - 1) + [True]
        for earlier, later in zip(versions, versions[1:]):
            assert earlier["effective_to"] == later["effective_from"]


def test_sql_form_finds_the_same_changes(frame, bag):
    current = start(frame, (1, "x", "p"), (2, "y", None))
    source = frame(ROW, (1, "X", "p"), (2, "y", "q"), (4, "n", "n"))
    for null_safe in (True, False):
        changed = scd2.changed_rows(current, source, ["k"], ["a", "b"], null_safe).unionByName(scd2.new_rows(current, source, ["k"]))
        assert bag(scd2.changes_sql(current, source, ["k"], ["a", "b"], null_safe)) == bag(changed)


def test_intervals_cross_periods(frame, bag):
    times = [datetime(2024, 1, 5), datetime(2024, 1, 9), datetime(2024, 3, 1), datetime(2025, 7, 1)]
    log = frame("k int, at timestamp", *[(1, t) for t in times], (2, times[1]))
    result = scd2.intervals(log, ["k"], "at")
    expected = [(1, a, b) for a, b in zip(times, times[1:] + [None])] + [(2, times[1], None)]
    assert bag(result, "k", "effective_from", "effective_to") == sorted(expected, key=repr)
    assert result.where("is_current").count() == 2


def test_state_at_a_time(frame, bag):
    history = scd2.apply_scd2(start(frame, (1, "x", "p")), frame(ROW, (1, "y", "p")), ["k"], ["a"], DAY[3])
    assert bag(scd2.valid_at(history, DAY[2]), "a") == [("x",)]
    assert bag(scd2.valid_at(history, DAY[3]), "a") == [("y",)]


def test_injected_change_copies_the_oldest_row(frame, bag):
    source = frame("k int, a string, _ingestion_timestamp timestamp", (1, "old", DAY[0]), (1, "new", DAY[1]), (2, "z", DAY[0]))
    change = inject_change(source, F.col("k") == 1, {"a": "BEST"}, DAY[5])
    assert bag(change) == [(1, "BEST", DAY[5])]


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_intervals_by_range_equal_the_window_and_spread_a_hot_key(spark, tmp_path, bag, batch):
    import random
    from datetime import datetime, timedelta

    rng = random.Random(batch)
    keys = [("hot", 1)] * 5 + [("a", 1), ("a", None), (None, 1), (None, None), ("", 2)]
    rows = {(*rng.choice(keys), datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, 4000))) for _ in range(900)}
    log = spark.createDataFrame(sorted(rows, key=repr), "k string, j int, at timestamp").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        path = str(tmp_path / "ranged")
        found = scd2.intervals_by_range(log, ["k", "j"], "at", path, tasks=6)
        assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
        assert bag(found) == bag(scd2.intervals(log, ["k", "j"], "at").select(*found.columns))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert spark.read.parquet(path).where("k = 'hot'").select("_task").distinct().count() >= 3
    empty = scd2.intervals_by_range(log.limit(0), ["k", "j"], "at", str(tmp_path / "none"))
    assert empty.count() == 0
