"""Held-out accuracy on the shared tables and defined results for awkward rows."""

from pyspark.sql import functions as F

from stratalake.llm import language, toxicity
from stratalake.llm.store import held_out, table, training_row

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_texts(spark):
    docs = table(spark, SF, "documents")
    found = language.language(docs, training_row()).where(held_out()).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.98 * n


def test_language_of_awkward_rows(spark, docs):
    df = docs((1, None), (2, ""), (3, "12 34 !"), (None, "the cat"), (5, "the cat"), (5, "the cat"), (6, "the dog sat " * 200_000))
    found = {(r.doc_id, r.lang_pred) for r in language.language(df, F.lit(True)).collect()}
    assert found == {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "en"), (6, "en")}
    unlearned = language.language(df, F.lit(False)).collect()
    assert len(unlearned) == 7 and {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}
    assert language.language(df.limit(0), F.lit(True)).count() == 0


def test_grams_of_letters_only():
    row, code = language.grams(["Ab1c", None, ""])
    spell = ["".join(chr((c >> s) & 0x1FFFFF) for s in (42, 21, 0)) for c in code.tolist()]
    assert [s for r, s in zip(row, spell) if r == 0] == [" ab", "ab ", "b c", " c "] and set(row) == {0}


def test_toxicity_of_held_out_texts(spark):
    labels = table(spark, SF, "labels")
    found = toxicity.toxicity(table(spark, SF, "documents"), labels, training_row()).join(labels, "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert counts[0, 0] >= 0.98 * (counts[0, 0] + counts.get((0, 1), 0))
    assert counts[1, 1] >= 0.6 * (counts[1, 1] + counts.get((1, 0), 0))


def test_clauses_are_scored_not_words():
    s = toxicity.Scorer({"idiot": 4.0, "trash": 4.0})
    assert s.score("you are an idiot") > s.score("an idiot is here") > s.score("he said that an idiot is here") > s.score("not an idiot is here")
    assert s.score("") == s.score("nothing to see") < 0.1
    assert s.score("i will kill you") > 0.3 > s.score("they wrote: never kill you")
    assert s.score("an idiot. you") < s.score("you idiot")
    assert toxicity.Scorer({"lowe*": 5.0}).score("die loweiten da") > 0.3


def test_composition_equals_running_one_after_the_other():
    import random

    whole = toxicity.grammar()
    rng = random.Random(1)
    a, b = toxicity._after("N", "I", -2.0, 2), toxicity._after("R", "I", -1.0, 3)
    both = a.then(b, "ITYNRO")
    for _ in range(50):
        word = rng.choices("ITYNRO", k=8)
        one, two, pair, w1, w2 = a.start, b.start, both.start, 0.0, 0.0
        for x in word:
            one, y, w = a.step(one, x)
            two, _, v = b.step(two, y)
            w1 += w + v
            pair, _, w = both.step(pair, x)
            w2 += w
        assert w1 == w2
    assert len(whole.arcs) < 5000


def test_toxicity_of_awkward_rows(spark, docs):
    df = docs((1, None), (2, ""), (None, "you idiot"), (4, "you idiot"), (4, "you idiot"), (5, "fine words " * 200_000)).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(4, None, 1), (5, 1, 0), (None, 1, 1), (9, 1, None)], "doc_id long, quality int, toxic int")
    found = sorted((r.doc_id or 0, r.predicted) for r in toxicity.toxicity(df, labels, training_row()).collect())
    assert found == [(0, 1), (1, 0), (2, 0), (4, 1), (4, 1), (5, 0)]
    assert toxicity.toxicity(df.limit(0), labels.limit(0), training_row()).count() == 0


def test_bundles_are_plain_sums_of_bound_letters(monkeypatch):
    """Also when the table of remembered n-grams is far too small."""
    import numpy as np

    from stratalake.llm import language

    texts = ["hello wörld this is", "", "zz", "漢字 test " * 50, None]
    row, code = language.grams(texts)
    expected = np.zeros((len(texts), 64))
    for i, c in zip(row.tolist(), code.tolist()):
        bound = np.ones(64)
        for place in range(3):
            letter = np.random.default_rng((c >> (21 * place)) & 0x1FFFFF).integers(0, 2, 64) * 2 - 1
            bound *= np.roll(letter, place)
        expected[i] += bound
    assert (language.Vectors(64).bundle(row, code, len(texts)) == expected).all()
    monkeypatch.setattr(language, "REMEMBERED", 50)
    monkeypatch.setattr(language, "BLOCK", 20)
    small = language.Vectors(64)
    assert (small.bundle(row, code, len(texts)) == expected).all() and len(small.codes) <= 50
    assert (small.bundle(row, code, len(texts)) == expected).all()
