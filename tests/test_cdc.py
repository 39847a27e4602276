from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratalake.operators.cdc import fold_cells, fold_changes, from_cells, merge_cells, to_cells

SCHEMA = "k int, s int, a int, b int"
maybe = st.one_of(st.none(), st.integers(0, 3))
changes = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), maybe, maybe), min_size=1, max_size=24)
relaxed = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def as_bag(df):
    return sorted(map(tuple, df.select("k", "s", "a", "b").collect()), key=repr)


def low_null(values):
    return tuple((v is not None, v or 0) for v in values)


@relaxed
@given(rows=changes)
def test_newest_row_against_brute_force(spark, rows):
    best = {}
    for row in rows:
        if row[0] not in best or low_null(row[1:]) > low_null(best[row[0]][1:]):
            best[row[0]] = row
    assert as_bag(fold_changes(spark.createDataFrame(rows, SCHEMA), ["k"], "s")) == sorted(best.values(), key=repr)


@relaxed
@given(rows=changes)
def test_nulls_keep_older_values_against_brute_force(spark, rows):
    expected = []
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        picked = [max(((r[1], r[c]) for r in mine if r[c] is not None), default=(None, None))[1] for c in (2, 3)]
        expected.append((key, max(r[1] for r in mine), *picked))
    assert as_bag(fold_changes(spark.createDataFrame(rows, SCHEMA), ["k"], "s", True)) == sorted(expected, key=repr)


@relaxed
@given(rows=changes, cut=st.integers(0, 24), ignore=st.booleans())
def test_any_split_in_any_order_and_repeated_gives_the_same(spark, rows, cut, ignore):
    def cells(part):
        return fold_cells(to_cells(spark.createDataFrame(part, SCHEMA), ["k"], "s", ignore), ["k"])

    first, second = cells(rows[:cut]), cells(rows[cut:])
    forward = merge_cells(merge_cells(first, second, ["k"]), first, ["k"])
    backward = merge_cells(second, first, ["k"])
    whole = fold_changes(spark.createDataFrame(rows, SCHEMA), ["k"], "s", ignore)
    assert as_bag(from_cells(forward, ["k"], ignore)) == as_bag(from_cells(backward, ["k"], ignore)) == as_bag(whole)


def test_changes_without_a_sequence_are_left_out(frame):
    rows = frame(SCHEMA, (1, None, 9, 9), (1, 1, 2, None))
    assert as_bag(fold_changes(rows, ["k"], "s")) == [(1, 1, 2, None)]
    assert as_bag(fold_changes(rows, ["k"], "s", True)) == [(1, 1, 2, None)]


def test_new_column_starts_empty_for_older_keys(frame, bag):
    old = fold_cells(to_cells(frame("k int, s int, a int", (1, 1, 5)), ["k"], "s", True), ["k"])
    new = fold_cells(to_cells(frame("k int, s int, a int, c int", (1, 2, None, 7), (2, 2, 1, None)), ["k"], "s", True), ["k"])
    merged = from_cells(merge_cells(old, new, ["k"]), ["k"], True)
    assert bag(merged, "k", "s", "a", "c") == [(1, 2, 5, 7), (2, 2, 1, None)]
