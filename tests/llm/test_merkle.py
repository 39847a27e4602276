"""The manifest against a plain tree, appended batches, and awkward rows."""

import hashlib
import zlib

import pytest

from stratalake.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def leaf(doc_id, text, lang, source, n_chars):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
        out.append((run[: i % 8], run[i % 8 + 1 :]))
        i //= 8
    return out


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0), leaf(*row), row))
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: levels([x[1] for x in sorted(groups[lang], key=lambda x: x[:2])]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (_, node, (doc_id, text, *rest)) in enumerate(sorted(groups[lang], key=lambda x: x[:2])):
            way = path(trees[lang], i) + path(top, k)
            now = leaf(doc_id, lower(text), *rest) if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 else node
            for before, behind in way:
                now = h("".join([*before, now, *behind]))
            proof = h("".join("".join(b + a) for b, a in way))
            out.append((doc_id, node, trees[lang][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*merkle.RESULT).collect()), key=repr)


def rows_of(n, langs):
    return [(i, f"Text {i} É" if i % 3 else f"text {i}", langs[i % len(langs)], "s", 6) for i in range(n)]


AWKWARD = [
    (None, None, None, None, None),
    (7, "", "en", "s", 0),
    (7, "", "en", "s", 0),
    (7, "Other", "en", "s", 5),
    (9, "A" * 200_000, "ü", "s", None),
    (-5, "ABC", "-", "", 3),
]


@pytest.mark.parametrize("rows", [[], AWKWARD, rows_of(1, ["en"]), rows_of(9, ["en"]), rows_of(1200, ["en", "en", "en", None, "de"]), rows_of(600, [f"l{i}" for i in range(600)])])
def test_manifest_is_the_plain_tree(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "'y' AS tree", "1 AS place")
    assert found(merkle.verify(df)) == expected(rows)


@pytest.mark.parametrize("cuts", [(0, 3), (513,), (40, 520, 530)])
def test_appended_batches_give_the_same_manifest(spark, cuts):
    rows = rows_of(1100, ["en"]) + [(2000 + i, "x", "de", "s", 1) for i in range(10)]
    edges = [0, *cuts, len(rows)]
    parts = [merkle.leaves(spark.createDataFrame(rows[a:b], SCHEMA), merkle.sampled_for_tampering()) for a, b in zip(edges, edges[1:])]
    made = merkle.manifest(parts[0])
    for part in parts[1:]:
        made = made.append(part)
    assert found(made.verify()) == expected(rows)


def test_append_opens_only_blocks_that_get_nodes(spark):
    rows = rows_of(1100, ["en"])
    one = merkle.manifest(merkle.leaves(spark.createDataFrame(rows[:1050], SCHEMA), merkle.sampled_for_tampering()))
    two = one.append(merkle.leaves(spark.createDataFrame(rows[1050:], SCHEMA), merkle.sampled_for_tampering()))
    before = {r.place: bytes(r.node) for r in one.rounds[1].collect()}
    after = {r.place: bytes(r.node) for r in two.rounds[1].collect()}
    assert [p for p in after if after[p] != before.get(p)] == [2]


def test_witness_parts_hang_on_subtrees():
    frontier = merkle.Frontier()
    for i in range(64):
        frontier.append(bytes([i]) * 32)
    spans = [len(span) for span, _ in frontier.parts]
    assert spans.count(1) == 64 and spans.count(8) == 8 and len(spans) == 72
    root, witness = frontier.finish(2)
    assert all(merkle.fold(bytes([i]) * 32, w) == root for i, w in enumerate(witness))
