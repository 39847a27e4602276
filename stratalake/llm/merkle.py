"""Manifest of a data set: a tree of digests with a witness for every row, kept while rows are appended.

Rows of a group are leaves in a fixed order. While more than one node remains, every 8 consecutive ones
become the digest of their hex digests. A witness of a leaf holds, level by level, the siblings of its path.

Leaves are dealt in aligned blocks of 8^3. A `Frontier` takes the nodes of one block as a stream: a node is
appended to the open run of its level; when a run is complete, the others of the run are the next part of
the witness of each member's subtree, and the run's digest is appended one level up. Witness parts hang on
subtrees, not on leaves, until the block ends. Block roots are then the nodes of the next round, appended in
the same way, until each group has one root; the group roots are nodes of one last tree. On the way
down every block gets the witness of its root once, not once per leaf, and its leaves finish theirs.

A block belongs to one task, whatever the size of its group, so a hot group is spread over tasks. Only the
number of rounds is decided by the driver, from one number per round.

`append` adds rows behind those of a manifest. Full blocks keep their digests and their inner witnesses; only
the open block at the end of each group is opened again, at every level.

Nulls in any column count as ``-``; a null group is a group of its own; the null id comes first. Rows that
repeat an id are ordered by their digests, equal rows take neighbouring places. An empty table has no rows.
Other columns of the input are left out, clashing ones do no harm.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import store
from stratalake.llm.order import placed

ARITY, LEVELS = 8, 3
BLOCK = ARITY**LEVELS

NODES = "tree string, place long, node binary, group_size long"
WITNESSES = "tree string, place long, slots array<int>, others array<binary>, subroot binary"
#: A part of a witness: place in the run, and the 32-byte digests of the others.
Part = tuple[int, bytes]


def digest(nodes: list[bytes]) -> bytes:
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


class Frontier:
    """Open runs of one block, lowest level first; every subtree in them carries the leaves it spans."""

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, range]]] = []
        self.parts: list[tuple[range, list[Part]]] = []
        self.size = 0

    def append(self, node: bytes) -> None:
        self._add(0, node, range(self.size, self.size + 1))
        self.size += 1

    def _add(self, level: int, node: bytes, span: range) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        run.append((node, span))
        if len(run) == ARITY:
            self._close(level)

    def _close(self, level: int) -> None:
        """The run becomes a node one level up; each member's subtree gets its part of the witness."""
        run, self.open[level] = self.open[level], []
        nodes = [n for n, _ in run]
        for slot, (_, span) in enumerate(run):
            self.parts.append((span, [(slot, b"".join(nodes[:slot] + nodes[slot + 1 :]))]))
        self._add(level + 1, digest(nodes), range(run[0][1].start, run[-1][1].stop))

    def finish(self, levels: int) -> tuple[bytes, list[list[Part]]]:
        """Root after exactly ``levels`` levels (runs that stay short are closed), and the witness of every leaf."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._close(level)
        ((root, _),) = self.open[levels]
        witness: list[list[Part]] = [[] for _ in range(self.size)]
        for span, part in self.parts:  # lower levels of a leaf always come before higher ones
            for leaf in span:
                witness[leaf] += part
        return root, witness


def levels_of(size: int) -> int:
    """Levels above the leaves of a tree: none for a lone leaf."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def fold(leaf: bytes, witness: list[Part]) -> bytes:
    """The root that a leaf and a witness lead to."""
    for slot, others in witness:
        nodes = [others[i : i + 32] for i in range(0, len(others), 32)]
        leaf = digest([*nodes[:slot], leaf, *nodes[slot:]])
    return leaf


def _block(nodes: list[bytes], group_size: int) -> tuple[bytes, list[list[Part]]]:
    """Root and witnesses of an aligned block; a group of several blocks fills all levels of each."""
    frontier = Frontier()
    for node in nodes:
        frontier.append(node)
    return frontier.finish(LEVELS if group_size > BLOCK else levels_of(group_size))


def _block_of() -> Column:
    return F.expr(f"place div {BLOCK}").alias("block")


def _roots(nodes: DataFrame) -> DataFrame:
    """The nodes one round up: (tree, place, node, group_size) from the same columns."""

    def roots(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        size = int(rows["group_size"].iloc[0])
        root, _ = _block(rows.sort_values("place")["node"].tolist(), size)
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "node": [root], "group_size": [-(-size // BLOCK)]})

    blocks = nodes.select("tree", "place", "node", "group_size", _block_of())
    return blocks.groupBy("tree", "block").applyInPandas(roots, NODES)


def _witnesses(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The witness of every node, from that of its block's root."""

    def extend(key: tuple, rows: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        made = _extended(rows, up)
        slots, others = [[s for s, _ in w] for w in made], [[o for _, o in w] for w in made]
        return pd.DataFrame({"tree": rows["tree"], "place": rows["place"], "slots": slots, "others": others, "subroot": [up["subroot"].iloc[0]] * len(rows)})

    return _with_block_roots(nodes, above).applyInPandas(extend, WITNESSES)


def _extended(rows: pd.DataFrame, up: pd.DataFrame) -> list[list[Part]]:
    """Witnesses of the rows of one block in their order: those within the block, then that of its root."""
    _, inner = _block(rows["node"].tolist(), int(rows["group_size"].iloc[0]))
    outer = list(zip(map(int, up["slots"].iloc[0]), up["others"].iloc[0]))
    return [parts + outer for parts in inner]


def _with_block_roots(nodes: DataFrame, above: DataFrame):
    """Each block of nodes beside the one row of its root."""
    blocks = nodes.withColumn("block", _block_of()).groupBy("tree", "block")
    return blocks.cogroup(above.withColumnRenamed("place", "block").groupBy("tree", "block"))


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Nodes of every round, from ``nodes`` to one node per tree."""
    rounds = [nodes, store.keep(_roots(nodes), "merkle-blocks")]
    while (rounds[-1].agg(F.max("group_size")).first()[0] or 0) > 1:
        rounds.append(store.keep(_roots(rounds[-1]), "merkle-blocks"))
    return rounds


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Witnesses of the block roots of round 1, from those of the roots of the trees."""
    for nodes in rounds[-2:0:-1]:
        above = store.keep(_witnesses(nodes, above), "merkle-witnesses")
    return above


def field(name: str, value: Column) -> Column:
    """A value with its number of UTF-8 bytes in front; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")).alias(name)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(tree, doc_id, node, other): digest of each row, and that of the row with its text in lower case where ``tampered``."""
    first = [field(c, F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]

    def leaf(text: Column) -> Column:
        return F.unhex(F.sha2(F.concat(*first, field("text", text)).cast("binary"), 256))

    other = F.when(F.coalesce(tampered, F.lit(False)), leaf(F.translate("text", UPPER, LOWER)))
    return docs.select(field("tree", F.col("lang")), "doc_id", leaf(F.col("text")).alias("node"), other.alias("other"))


@dataclass
class Manifest:
    """Leaves with their places, and the nodes of every round above them, as tables in the shared folder."""

    leaves: DataFrame
    rounds: list[DataFrame]

    def subroots(self) -> DataFrame:
        """(tree, subroot), one row per group."""
        return self.rounds[-1].select("tree", F.col("node").alias("subroot"))

    def append(self, more: DataFrame) -> Manifest:
        """The manifest with ``more`` (as of `leaves`) behind the leaves of their groups.

        A block is opened again only when it gets a new node; all others keep theirs.
        """
        news = placed(more, "tree", ["doc_id", "node"], "merkle-added").withColumnRenamed("group_size", "new")
        was = self.leaves.groupBy("tree").agg(F.max("group_size").alias("was"))
        shift = F.coalesce("was", F.lit(0))
        news = news.join(was, "tree", "left").select("tree", "doc_id", "node", "other", (F.col("place") + shift).alias("place"), (F.col("new") + shift).alias("group_size"))
        news = store.keep(news, "merkle-leaves")
        sizes = store.keep(news.groupBy("tree").agg(F.max("group_size").alias("now")), "merkle-sizes")

        def resized(nodes: DataFrame, unit: int) -> DataFrame:
            size = F.coalesce(F.expr(f"(now + {unit - 1}) div {unit}"), "group_size")
            return nodes.join(sizes, "tree", "left").withColumn("group_size", size).drop("now")

        whole = store.keep(resized(self.leaves, 1).unionByName(news), "merkle-leaves")
        rounds, changed, unit = [whole.select("tree", "place", "node", "group_size")], news, 1
        while len(rounds) == 1 or (rounds[-1].agg(F.max("group_size")).first()[0] or 0) > 1:
            opened = changed.select("tree", _block_of()).distinct()
            blocks = rounds[-1].withColumn("block", _block_of())
            unit *= BLOCK
            if len(rounds) < len(self.rounds):
                changed = store.keep(_roots(blocks.join(opened, ["tree", "block"], "left_semi")), "merkle-blocks")
                stay = self.rounds[len(rounds)].join(changed.select("tree", "place"), ["tree", "place"], "left_anti")
                rounds.append(store.keep(resized(stay, unit).unionByName(changed), "merkle-blocks"))
            else:
                changed = store.keep(_roots(blocks), "merkle-blocks")
                rounds.append(changed)
        return Manifest(whole, rounds)

    def verify(self) -> DataFrame:
        """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""

        def check(key: tuple, rows: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("place")
            made = []
            subroot = up["subroot"].iloc[0].hex()
            for doc_id, node, other, witness in zip(rows["doc_id"], rows["node"], rows["other"], _extended(rows, up)):
                root = fold(node, witness)
                folded = root if other is None else fold(other, witness)
                proof = hashlib.sha256("".join(o.hex() for _, o in witness).encode()).hexdigest()
                made.append((doc_id, node.hex(), subroot, root.hex(), proof, folded.hex(), folded == root))
            return pd.DataFrame(made, columns=RESULT)

        top = self.subroots().withColumn("lang", F.expr("CASE WHEN tree <> '-' THEN substr(tree, instr(tree, ':') + 1) END"))
        top = placed(top.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "lang", F.col("subroot").alias("node")), "tree", ["lang"], "merkle-top")
        nodes = top.select("tree", "place", "node", "group_size")
        rounds = _climb(nodes)
        start = rounds[-1].select("tree", "place", F.array().cast("array<int>").alias("slots"), F.array().cast("array<binary>").alias("others"), F.col("node").alias("subroot"))
        over = _witnesses(nodes, _descend(rounds, start)).drop("tree", "subroot")
        over = over.join(top.select("place", F.col("group").alias("tree"), F.col("node").alias("subroot")), "place")
        over = store.keep(over.withColumn("place", F.lit(0).cast("long")), "merkle-over")
        above = _descend(self.rounds, over.select("tree", "place", "slots", "others", "subroot"))
        types = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return _with_block_roots(self.leaves, above).applyInPandas(check, types)


RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest(rows: DataFrame) -> Manifest:
    """The manifest of ``rows`` as of `leaves`."""
    kept = placed(store.keep(rows, "merkle-rows"), "tree", ["doc_id", "node"], "merkle-placed")
    kept = store.keep(kept, "merkle-leaves")
    return Manifest(kept, _climb(kept.select("tree", "place", "node", "group_size")))


def sampled_for_tampering(column: str = "doc_id") -> Column:
    """3 divides the crc32 of the decimal id; not so for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 0, F.lit(False))


def verify(docs: DataFrame) -> DataFrame:
    """Digests, proofs and checks of every row of ``docs``, some of them tampered with after the manifest was made."""
    return manifest(leaves(docs, sampled_for_tampering())).verify()
