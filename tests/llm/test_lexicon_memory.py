"""The features that toxicity learns from leave a task in bounded portions."""

from stratalake.llm import store
from stratalake.llm import toxicity as tox


def test_features_are_passed_on_in_portions(spark, monkeypatch):
    rows = [(" ".join(f"w{i}x{j}" for j in range(100)) + (" blockhead" if i % 4 == 0 else " fine"), int(i % 4 == 0)) for i in range(200)]
    labelled = spark.createDataFrame(rows, "text string, toxic int").coalesce(1)
    wanted = tox.learn_lexicon(labelled)
    assert "blockhead" in wanted and "fine" not in wanted
    tidy = store.tidy

    def portions(run):
        def whole(batches):
            for batch in run(batches):
                assert batch.num_rows < 4000
                yield batch

        return tidy(whole)

    monkeypatch.setattr(store, "tidy", portions)
    monkeypatch.setattr(tox, "HELD", 1000, raising=False)
    assert tox.learn_lexicon(labelled) == wanted
    assert not spark.sparkContext._jsc.getPersistentRDDs()
