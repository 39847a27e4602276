"""Large groups of near copies are met through the centres of their cells."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_pairs_and_lists import brute_force

from stratalake.llm import jaccard_groups as jg
from stratalake.llm import store
from stratalake.llm import text as tx


def test_queries_near_a_large_group_do_not_list_its_members(docs, monkeypatch):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))

    def edited(words, *places):
        return [word() if at in places else w for at, w in enumerate(words)]

    base = [word() for _ in range(120)]
    copies = [edited(base, int(rng.integers(5, 115))) for _ in range(150)]
    near = [edited(base, *(int(at) for at in 15 + 25 * np.arange(4) + rng.integers(0, 15, 4))) for _ in range(16)]  # J of about 0.7
    far = [edited(base, 20, 50, 80) for _ in range(3)]
    beyond = [edited(words, 10, 100) for words in far]  # link with one of far only
    rows = [(i, " ".join(words)) for i, words in enumerate([base, *copies, *near, *far, *beyond])]
    monkeypatch.setattr(jg, "FREQUENT", 10**6)  # tokens in the order of hashes, so that the bound opens the group
    middle = jg.node_of(next(jg.shingle_sets(next(tx.words(pa.array([rows[0][1]]), tx.SPACED)))))
    others = lambda nodes: nodes.select("node").distinct().where(F.col("node") != middle)
    monkeypatch.setattr(jg, "leader_pairs", lambda nodes: others(nodes).select(F.least("node", F.lit(middle)).alias("a"), F.greatest("node", F.lit(middle)).alias("b")))
    listed, keep = [], store.keep
    monkeypatch.setattr(store, "keep", lambda df, label: (kept := keep(df, label), label == "pairs" and listed.append(kept.count()))[0])
    found = jg.jaccard_join(docs(*rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute_force(rows)
    assert sum(listed[1:]) < 900  # after those with leaders; 16 x 150 pairs and more if members are listed


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_cell_shows_a_link_if_a_member_links(spark, seed):
    rng = np.random.default_rng(seed)
    fresh = lambda: int(rng.integers(1, 1 << 62))
    links = lambda x, y: 4 * len(x & y) >= 3 * len(x | y)

    def changed(tokens, out, more, pool):
        kept = rng.permutation(sorted(tokens))[out:].tolist()
        return {*kept, *(int(rng.choice(pool)) if rng.random() < 0.5 else fresh() for _ in range(more))}

    sets, asked, members, cells = {}, [], [], {}
    for c in range(0, 4000, 100):
        pool = [fresh() for _ in range(8)]
        sets[c] = {fresh() for _ in range(int(rng.integers(4, 40)))}
        cells[c] = [c]
        members.append((c, len(sets[c]), c, len(sets[c])))
        for node in range(c + 1, c + 15):
            n = len(sets[c])
            tokens = changed(sets[c], int(rng.integers(0, n // 5 + 1)), int(rng.integers(0, n // 4 + 1)), pool)
            if links(tokens, sets[c]):
                sets[node] = tokens
                cells[c].append(node)
                members.append((node, len(tokens), c, len(tokens & sets[c])))
        for q in range(c + 50, c + 70):
            some = sets[int(rng.choice(cells[c]))]
            sets[q] = changed(some, int(rng.integers(0, len(some) // 3 + 1)), int(rng.integers(0, len(some) // 3 + 1)), pool)
            asked.append((q, c))
    packed = [(node, bytearray(np.array(sorted(tokens), np.uint64).tobytes())) for node, tokens in sets.items()]
    frame = spark.createDataFrame(packed, "node long, tokens binary")
    order = jg.Order(np.empty(0, np.uint64), np.empty(0, np.int64))
    rows = jg.through_centres(spark.createDataFrame(asked, "q long, c long"), spark.createDataFrame(members, "node long, n long, c long, y long"), frame, order).collect()
    wanted = {q for q, c in asked if any(links(sets[q], sets[s]) for s in cells[c])}
    aside = {q for q in wanted if not links(sets[q], sets[q - q % 100])}
    assert aside and {r.a for r in rows} == wanted
    assert all(links(sets[r.a], sets[r.b]) for r in rows if r.b % 100)


def test_nodes_meet_small_groups_by_lists_of_tokens(spark, monkeypatch):
    rng = np.random.default_rng(5)
    sets = {node: np.sort(rng.choice(60, int(rng.integers(8, 25)), replace=False)).tolist() for node in range(80)}
    prefix = {node: s[: jg.prefix_length(len(s))] for node, s in sets.items()}
    facts = [(node, len(s), prefix[node][-1]) for node, s in sets.items()]
    shared = [(t, node, place < len(sets[node]) - -(-6 * len(sets[node]) // 7) + 1) for node, tokens in prefix.items() for place, t in enumerate(tokens)]
    groups = [(node, node - node % (2 if node < 40 else 10)) for node in range(70)]
    matrix = jg.Matrix.of(
        spark.createDataFrame(facts, "node long, n long, last long"), spark.createDataFrame(shared, "token long, node long, short boolean"), spark.createDataFrame(groups, "node long, label long")
    )
    rows = lambda: sorted((r.q, r.g, r.size) for r in matrix.opened().collect())
    found = rows()
    assert found and {size for *_, size in found} >= {2, 10}
    assert "array_intersect" in matrix.opened()._jdf.queryExecution().analyzed().toString()
    for few in (0, 100):
        monkeypatch.setattr(jg, "FEW", few)
        assert rows() == found
