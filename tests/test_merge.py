import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators.dedup import latest_per_key, latest_per_key_sql
from stratalake.operators.merge import DuplicateKeyError, append_evolving, merge_replace, merge_upsert, require_unique_keys, update_matched

SCHEMA = "k int, v string, _is_deleted boolean"


def test_upsert_updates_inserts_deletes_and_ignores_unknown_flags(frame, bag):
    target = frame(SCHEMA, (1, "a", False), (2, "b", False), (3, "c", False), (None, "n", False))
    source = frame(SCHEMA, (1, "A", False), (2, "B", True), (3, "C", None), (4, "D", False), (5, "E", True), (None, "N", False))
    assert bag(merge_upsert(target, source, ["k"]), "k", "v") == sorted(
        [(1, "A"), (3, "c"), (4, "D"), (None, "n"), (None, "N")], key=repr
    )


def test_merging_twice_is_merging_once(frame, bag):
    target = frame(SCHEMA, (1, "a", False), (2, "b", False))
    source = frame(SCHEMA, (1, "A", False), (2, "B", True), (9, "Z", False))
    once = merge_upsert(target, source, ["k"])
    assert bag(merge_upsert(once, source, ["k"])) == bag(once)


def test_replace_never_deletes(frame, bag):
    target = frame("k int, v string", (1, "a"), (2, "b"))
    assert bag(merge_replace(target, frame("k int, v string", (2, "B"), (3, "C")), ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


def test_update_matched_keeps_the_number_of_rows(frame, bag):
    target = frame("k int, v string, open boolean", (1, "a", True), (1, "b", False), (2, "c", True))
    updates = frame("k int", (1,), (1,), (3,))
    result = update_matched(target, updates, ["k"], F.col("open"), {"open": F.lit(False), "v": F.lit("x")})
    assert bag(result) == [(1, "b", False), (1, "x", False), (2, "c", True)]


def test_append_fills_missing_columns(frame, bag):
    both = append_evolving(frame("a int, b string", (1, "x")), frame("a int, c int", (2, 5)))
    assert bag(both, "a", "b", "c") == [(1, "x", None), (2, None, 5)]


def test_keys_that_collide_after_the_cast_are_reported(frame):
    with pytest.raises(DuplicateKeyError):
        require_unique_keys(frame("k int", (1,), (1,)), ["k"])
    require_unique_keys(frame("k int", (1,), (None,), (None,)), ["k"])


rows = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3))), max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows)
def test_latest_row_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int").repartition(3)
    best = {}
    for k, t, v in rows:
        rank = (t, v is not None, v or 0)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v))
    expected = sorted((row for _, row in best.values()), key=repr)
    for form in (latest_per_key, latest_per_key_sql):
        assert sorted(map(tuple, form(df, ["k"], "t").collect()), key=repr) == expected
