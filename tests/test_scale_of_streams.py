"""What keeps the streams in proportion to their input."""

import numpy as np
import pytest

from checks import q_streaming
from checks.domain import RULES, Domain
from stratalake.operators.cdc import NEWS, fold_cells, fold_folded, merge_cells, merge_news, to_cells
from stratalake.sources.readers import file_stream
from stratalake.sources.snapshots import SnapshotTable
from stratalake.streaming import chain, flows
from stratalake.tuning import settings

SF = "/root/testdata/sf0.001"
CHANGE = "k int, s int, a int, b string"


def test_landing_files_of_a_large_table_are_its_splits(spark, monkeypatch):
    d, rows = Domain(spark, SF), spark.range(1000, numPartitions=7)
    assert len(spark.read.parquet(q_streaming._landed(d, rows, "few")).inputFiles()) == 3
    monkeypatch.setattr(q_streaming, "DEALT", 100)
    many = spark.read.parquet(q_streaming._landed(d, rows, "many"))
    assert len(many.inputFiles()) == 7 and many.count() == 1000


@pytest.mark.parametrize("files", [3, 11])
def test_micro_batches_do_not_grow_with_the_files(spark, files):
    d = Domain(spark, SF)
    path, table = d.scratch("landing"), q_streaming._change_table(d, "t")
    d.changes.repartition(files).write.parquet(path)
    done = flows.fold_into(q_streaming._change_stream(d, path), table, "changed_at", f"{table.path}-progress", "changes")
    assert len([p for p in done.recentProgress if p.numInputRows]) == 3


def test_batches_are_folded_adaptively_in_small_splits(spark, tmp_path, frame, monkeypatch):
    seen = []

    def watched(state, incoming, keys):
        conf = incoming.sparkSession.conf
        seen.append((conf.get("spark.sql.adaptive.enabled"), conf.get("spark.sql.files.maxPartitionBytes")))
        return merge_news(state, incoming, keys)

    monkeypatch.setattr(flows, "merge_news", watched)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows, path = frame(CHANGE, (1, 1, 1, "a")), str(tmp_path / "landing")
    rows.write.parquet(path)
    table = SnapshotTable(spark, str(tmp_path / "t"), ["k"], buckets=3)
    flows.fold_into(file_stream(spark, path, rows.schema).drop("_source_file"), table, "s", str(tmp_path / "progress"), "c")
    assert seen == [("true", str(32 << 20))] and spark.conf.get("spark.sql.files.maxPartitionBytes") == before


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_news_are_the_keys_whose_cells_change(frame, bag, ignore_nulls):
    def cells(*rows):
        return fold_cells(to_cells(frame(CHANGE, *rows), ["k"], "s", ignore_nulls), ["k"])

    state = cells((1, 5, 1, "x"), (2, 5, 1, None), (3, 1, 1, "c"), (None, 1, 1, "n"))
    incoming = cells((1, 4, 9, "late"), (2, 6, None, "new"), (4, 1, 1, "d"), (None, 1, 1, "n"))
    merged = merge_news(state, incoming, ["k"])
    assert bag(merged.drop(NEWS)) == bag(merge_cells(state, incoming, ["k"]))
    assert bag(merged.where(NEWS), "k") == [(2,), (4,), (None,)]  # NULL keys match nothing
    assert merge_news(state, cells((1, 5, 1, "x"), (3, 0, 7, "old")), ["k"]).where(NEWS).isEmpty()


def test_cells_of_several_folds_are_dealt_as_plain_values(spark, frame, bag):
    rng = np.random.default_rng(4)
    pick = lambda values: values[rng.integers(len(values))]
    rows = [(pick([0.0, -0.0, float("nan"), 1.5, None]), pick([1, 2, None]), int(rng.integers(4)), pick([None, 1, 2]), pick([None, "a", "b"])) for _ in range(400)]
    changes = frame("k double, j int, s int, a int, b string", *rows)
    folds = [fold_cells(to_cells(changes.where(f"s % 2 = {n} OR a = 2"), ["k", "j"], "s", True), ["k", "j"]) for n in range(2)]
    cells = folds[0].unionByName(folds[1])
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):  # every key hash in a partition of its own
        for some in (cells, cells.select("k", "j", "s")):
            assert repr(bag(fold_folded(some, ["k", "j"]))) == repr(bag(fold_cells(some, ["k", "j"])))


def test_the_chain_keeps_little_on_disk(spark, monkeypatch):
    """Shuffles of the fold go with its write, and the folded trips are shuffled once, as values and not as cells."""
    d, seen = Domain(spark, SF), []

    def watched(cells, keys):
        seen.append(cells.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        return fold_cells(cells, keys)

    monkeypatch.setattr(chain, "fold_cells", watched)
    landing, trips = d.scratch("landing"), chain.TripChain(spark, d.scratch("chain"), RULES)
    d.view("trips").drop("_ingestion_timestamp").write.parquet(landing)
    trips.run(landing, "2024-03-01 00:00:00", "b", "2024-03-01 00:00:00")
    assert seen == ["true"] and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    plan = trips.trips()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_max") < plan.index("Exchange")
