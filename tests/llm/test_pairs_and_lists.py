"""URL filter, top-k, Jaccard groups and decontamination against brute force on small fixtures."""

import re
from datetime import date  # noqa: F401
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import decontaminate as dc
from stratalake.llm import jaccard_groups as jg
from stratalake.llm import topk, url_filter


# -- url filter ----------------------------------------------------------------------------------


def test_intervals_decide_by_day_and_place(spark):
    entries = spark.createDataFrame(
        [
            ("example.org", 10, "block"), ("example.org", 50, "remove"), ("www.example.org/a", 20, "allow"), ("example.org", 60, "block"),
            ("example.org", 60, "remove"), (None, 5, "block"), ("x.net", None, "block"), ("x.net", 3, None), ("x.net", 3, "odd"),
        ],
        "key string, day int, operation string",
    )
    rows = [
        (1, "http://www.example.org/a/b?c", 5), (2, "http://www.example.org/a/b", 15), (3, "HTTPS://user@WWW.Example.org:80/a/b", 30), (4, "http://example.org", 49),
        (5, "http://example.org", 50), (6, "http://notexample.org", 20), (7, None, 20), (8, "no url", 20), (9, "http://x.net/", 400), (10, "http://example.org/", 400),
        (None, "http://example.org", 12), (11, "http://example.org", None), (2, "http://www.example.org/a/b", 15),
    ]
    captures = spark.createDataFrame(rows, "page_id long, url string, day int").withColumn("key", F.lit("clash"))
    got = sorted(((r.page_id, r.n_active, r.verdict) for r in url_filter.judge(captures, entries).collect()), key=repr)
    wanted = [(1, 0, "none"), (2, 1, "block"), (2, 1, "block"), (3, 2, "allow"), (4, 1, "block"), (5, 0, "none"), (6, 0, "none"), (7, 0, "none"), (8, 0, "none"),
              (9, 0, "none"), (10, 1, "block"), (None, 1, "block"), (11, 0, "none")]
    assert got == sorted(wanted, key=repr)
    assert url_filter.judge(captures.limit(0), entries).count() == 0
    assert {r.verdict for r in url_filter.judge(captures, entries.limit(0)).collect()} == {"none"}


# -- top k ---------------------------------------------------------------------------------------


def test_top_k_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(150)]
    rows += [(i, [0.5] * 6) for i in range(200, 260)]  # one vector many rows have
    rows += [(300, None), (320, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (340, [float("nan")] * 6), (360, [float("inf")] * 6), (None, [1.0] * 6), (380, [1.0, 2.0]), (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=7).collect())
    good = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    wanted = []
    for q, v in good:
        if q % 20 == 0:
            scored = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:7]
            wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert got == sorted(wanted)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# -- Jaccard groups ------------------------------------------------------------------------------


def family(seed: int) -> list[tuple]:
    """Exact and near copies, a passage that many texts share, short, empty and long texts."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))
    text = lambda n: [word() for _ in range(n)]
    base, passage, rows = text(60), text(40), []
    for _ in range(60):
        copy = list(base)
        for at in rng.integers(0, 60, rng.integers(0, 4)):
            copy[at] = word()
        rows.append(" ".join(copy))
    rows += [" ".join(text(int(rng.integers(5, 40))) + passage) for _ in range(40)]
    rows += [" ".join(base).upper()] * 5 + ["a b", "a b", "A  b", "a b c", "", " \n", None] + [" ".join(text(30)) for _ in range(40)]
    chain = text(50)
    for n in range(12):
        chain[4 * n : 4 * n + 2] = [word(), word()]
        rows.append(" ".join(chain))
    ids = rng.permutation(len(rows)).tolist()
    return [*zip(ids, rows), (None, rows[0]), (None, rows[-3]), (ids[0], rows[0])]


def brute_force(rows: list[tuple]) -> list[tuple]:
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        same = [d for j, (d, _) in enumerate(rows) if d is not None and find(j) == find(i)]
        out.append((doc, len(sets[i]), min(same) if same else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(docs, seed):
    rows = family(seed)
    found = jg.jaccard_join(docs(*rows).withColumn("node", F.lit("clash"))).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute_force(rows)
    stays = [r for r in found if r["first"]]
    alone = sum(r.n_shingles == 0 for r in found)
    assert len(stays) == alone + len({r.component_id for r in found if r.n_shingles})


def test_least_need_over_all_member_sizes(spark):
    n = spark.range(1, 121).select(F.col("id").alias("n"))
    sizes = n.select("n", F.explode(F.sequence(F.ceil(F.col("n") * 3 / F.lit(4.0)), F.floor(F.col("n") * 4 / F.lit(3.0)))).alias("high"))
    sizes = sizes.select("n", "high", F.explode(F.sequence(F.ceil(F.col("n") * 3 / F.lit(4.0)), "high")).alias("low"))
    need = lambda n, m: -(-3 * (n + m) // 7) - (-(-3 * m // 4) - 1)
    for r in sizes.select("n", "low", "high", jg._least_by_member(F.col("n"), F.col("low"), F.col("high")).alias("least")).collect():
        assert r.least == min(need(r.n, m) for m in range(r.low, r.high + 1)), r


def test_pairs_at_the_threshold_open_their_group(spark):
    rng = np.random.default_rng(11)
    cases = [({2, 3, 4, 5, 6, 7, 8}, [{1, 2, 4, 5, 6, 7, 8}, {0, 1, 2, 4, 5, 6, 7, 8}])]
    for _ in range(40):  # a query and a group of two, of which the first links at exactly 3/4
        k, far = int(rng.integers(1, 8)), rng.permutation(200).tolist()
        common, spare = far[: 3 * k], far[3 * k :]
        cut = int(rng.integers(0, k + 1))
        query, member = {*common, *spare[:cut]}, {*common, *spare[cut:k]}
        cases.append((query, [member, member | {spare[k]}]))
    facts, shared, groups, wanted = [], [], [], set()
    for c, (query, members) in enumerate(cases):
        for node, tokens in enumerate([query, *members]):
            name, n = 10 * c + node, len(tokens)
            prefix = sorted(1000 * c + t for t in tokens)[: jg.prefix_length(n)]
            facts.append((name, n, prefix[-1]))
            shared += [(t, name, place < n - -(-6 * n // 7) + 1) for place, t in enumerate(prefix)]
            if node:
                groups.append((name, 10 * c + 1))
                if 4 * len(query & tokens) >= 3 * len(query | tokens):
                    wanted.add((10 * c, name))
    matrix = jg.Matrix.of(
        spark.createDataFrame(facts, "node long, n long, last long"), spark.createDataFrame(shared, "token long, node long, short boolean"), spark.createDataFrame(groups, "node long, label long")
    )
    assert wanted and wanted <= {(r.a, r.b) for r in matrix.all_members().collect()}


def test_no_documents(docs):
    assert jg.jaccard_join(docs((1, "x")).limit(0)).count() == 0


# -- decontamination -----------------------------------------------------------------------------


def hits(rows: list[tuple], items: list[tuple], window: int) -> list[tuple]:
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for doc, text in rows:
        w, marked, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(window, len(v))
            for s in range(max(len(v) - window, 0) + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[s : s + n]:
                        marked.update(range(p, p + n))
                        found.add(str(item))
        out.append((doc, len(w), len(marked), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination_equals_brute_force(spark, docs, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(dc, "BROADCAST_WORDS", 3)
        monkeypatch.setattr(dc, "BROADCAST_ROWS", 3)
    rng = np.random.default_rng(9)
    some = lambda n: " ".join(rng.choice(list("abcdefghijkl"), n))
    items = [(i, some(9)) for i in range(4)] + [(10, "x y"), (2, "X, y!"), (11, ""), (12, None), (13, "a a a a a a"), (14, "a a a a a a"), (None, some(8))]
    rows = [(i, some(20) + " " + items[i % 4][1][: 2 * (i % 9)] + " " + some(5)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x y"), (None, "q x. Y q"), (103, "a " * 30), (104, "b " + items[0][1]), (104, "b " + items[0][1]), (105, "zz " * 400_000 + "x y")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("terms", F.lit(1))
    found = dc.decontaminate(docs(*rows).withColumn("terms", F.lit(1)), benchmark, window=4).collect()
    items = [(i, t) for i, t in items if i is not None]
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found if not (r.contaminated and not r["items"])), key=repr)
    wanted = [x for x in hits(rows, items, 4)]
    assert [g for g in got if g[3]] == [w for w in wanted if w[3]]
    assert len(found) == len(rows)


@pytest.mark.parametrize("rows", [dc.BROADCAST_ROWS, 1])
def test_items_that_share_a_window_are_all_found(spark, docs, monkeypatch, rows):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", rows)
    passage = "read the text and choose one answer"
    items = [(1, f"red green {passage} blue"), (2, f"{passage} black white"), (3, f"gold {passage}"), (4, "choose one answer alone"), (5, "read the"), (6, f"gold {passage}"), (7, "no part of it")]
    texts = [(1, f"x {passage} y"), (2, f"{passage} black white"), (3, f"{passage} {passage}"), (4, "please choose one answer alone"), (5, "read the"), (None, f"z {passage}"), (6, "text and choose")]
    found = dc.decontaminate(docs(*texts), spark.createDataFrame(items, "item_id long, text string"), window=4).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=repr) == hits(texts, items, 4)
    assert [r["items"] for r in found if r.doc_id == 1] == [["1", "2", "3", "5", "6"]]


def test_proximity_finds_every_item_of_a_window(spark, docs):
    items = spark.createDataFrame([(1, "red green blue"), (2, "black red green blue")], "item_id long, text string")
    index = dc.Index(docs((1, "blue x red y green"), (2, "red")), items, window=3)
    assert len({r.uid for r in index.proximity_matches(slack=3).collect()}) == 2


def test_decontamination_of_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.decontaminate(docs((1, "a b")).limit(0), items).count() == 0
    assert [(r.n_hit, r.contaminated) for r in dc.decontaminate(docs((1, "a b")), items.limit(0)).collect()] == [(0, False)]


def test_proximity_finds_words_in_any_order(spark, docs):
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    index = dc.Index(docs((1, "blue x red y green"), (2, "blue " + "x " * 50 + "red green"), (3, "red green")), items, window=3)
    assert [r.doc_id for r in index.proximity_matches(slack=3).collect()] == [1]


def test_top_k_of_very_long_vectors(spark):
    """Up to the limit scores are exact; beyond it a vector takes no part."""
    from stratalake.llm import topk

    rows = [(0, [1e7, 0.0]), (1, [1.0, 1.0]), (2, [-1e7, 3.0]), (3, [1e9, 1.0]), (4, [1e17, -1e17]), (5, [1.7e308, 1.7e308]), (6, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, F.col("vec_id").isin(0, 2, 4), k=3)
    whole = {i: [int(64 * x // 1) for x in v] for i, v in rows if i in (0, 1, 2, 6)}
    want = []
    for q in (0, 2):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)
