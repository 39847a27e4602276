"""The prefix trie against a plain one, with long, equal, empty and awkward conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stratalake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def expected(rows):
    own = defaultdict(list)
    for conv_id, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv_id].append((role or "", text or ""))
    shared = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    rebuilt = {c: own.get(c - (c % 100), [])[: shared[c]] + t[shared[c] :] for c, t in own.items()}
    members, children = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        key = hashlib.sha256(b"root").digest()
        members[(0, key)].append((c, len(rebuilt[c]) == 0, 0, None))
        for d, turn in enumerate(rebuilt[c], 1):
            above, key = (d - 1, key), hashlib.sha256(key + repr(turn).encode()).digest()
            if (d, key) not in members:
                children[above].append((d, key))
            members[(d, key)].append((c, len(rebuilt[c]) == d, len(turn[1]), above))
    leaves, saved, out = {}, {}, []
    for node in sorted(members, reverse=True):
        found = members[node]
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(found) - 1) * found[0][2]
        ends = ",".join(str(c) for c, ended, *_ in found if ended)
        parent = members[found[0][3]][0][0] if node[0] else None
        out.append((node[0], found[0][0], parent, len(found), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def talk(conv_id, texts):
    return [(conv_id, i, "user" if i % 2 else "bot", t) for i, t in enumerate(texts)]


def families(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 320), 150):
        rows += talk(c, rng.choices(["a", "b", "é😀", "", "long text"], k=rng.randint(1, 9)))
    return rows


LONG = [f"t{i}" for i in range(60)]
CASES = {
    "empty": [],
    "random": families(1),
    "copies": [r for c in range(1000, 1090) for r in talk(c, ["x", "yy", "z", "z", "z", "z", "z"])] + talk(1005, ["x"]),
    "long": talk(1, [f"t{i}" for i in range(2500)]) + talk(2, LONG) + talk(3, LONG) + talk(4, [*LONG[:-1], "other"]) + talk(5, LONG[:40]) + talk(10_007, [f"t{i}" for i in range(2500)]),
    "awkward": [(None, 0, "a", "b"), (7, None, None, None), (7, 0, "user", ""), (7, 1, None, "x" * 100_000), (8, 5, "user", "a"), (8, -2, "user", "b"), (100, 0, "user", "base"), (101, 0, "q", "own")],
}


@pytest.mark.parametrize("name", CASES)
def test_nodes_are_those_of_the_plain_trie(spark, name):
    rows = CASES[name]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "2 AS size", "'c' AS chain")
    found = sorted((tuple(r) for r in trie.trie(df).select(*COLUMNS).collect()), key=repr)
    assert found == expected(rows)


def test_packed_ends_do_not_depend_on_batches(spark):
    ids = list(range(30_000))
    df = spark.createDataFrame([(1, 2, i) for i in ids], "ka long, kb long, conv_id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        found = trie._ends(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.ends_sha256 for r in found] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]
