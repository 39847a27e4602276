"""Jaccard join of word n-gram sets by a token-group matrix.

1. Every text becomes its set of 5-word shingles (fewer words: the whole sequence as one). Texts with the
   same set are one node.
2. Similar nodes are partitioned into groups: nodes that agree in a band of min-hashes are compared with
   one leader, and those that link with it form a group. A group of thousands of near copies costs one
   comparison per node and band, not one per pair.
3. The token-group matrix: the union of the tokens of each group, one row per token and group, over the
   first tokens of every set in a common order. Two sets that link must share a token among their first
   ``n - ceil(t n) + 1``; frequent tokens come last in the order, so that a passage many texts share
   hardly enters the matrix.
4. A query node meets the groups that hold some of its tokens; the number of its tokens in a group's union bounds
   its overlap with every member. Groups whose bound does not reach what the sizes demand stay closed.
5. Only the members of open groups are compared, on whole sets, and only across groups: inside a group
   the nodes are connected already. The nodes of the smaller of two groups ask.
6. A group of more than ``FEW`` is not listed member by member. It falls into cells, each of nodes that link with one
   centre, and a query node is compared with the centres of the cells that its bound allows. What two sets
   share is what each shares with the centre, less the centre, plus where they differ from it alike. So the
   centre's comparison either shows a link, or says how many differences a member must have in common with
   the query to link; only members with one of their first differences in common are compared.

Every pair that links lies in one group or across two of which one is opened to a node of the other, so
no connection between different texts is lost. Tokens and sets are 64-bit hashes. What
reaches the driver is bounded: counts, at most ``LAST`` sampled frequent tokens (they decide the order,
never the result) and, while there are at most ``ASKED``, the names of the nodes to be compared.

Null, empty and blank texts have no shingles: size 0, linked with nothing, a component of their own.
Null ids take part: the component is named by the smallest id in it that is not null. Repeated rows are
copies. An empty table gives no rows. Other columns do not matter, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import store
from stratalake.llm import text as tx
from stratalake.llm.graph import components

SHINGLE = 5
#: Similarity as a ratio of whole numbers.
NUM, DEN = 3, 4
#: One document of so many is looked at for frequent tokens (of small tables every one), and in how many of them a token must be.
ONE_OF, FREQUENT = 20, 2
SMALL = 5_000
#: Frequent tokens that are put last (8 bytes each, sent to every task), the most frequent first.
LAST = 1_000_000
#: Min-hashes of the bands: texts are compared with a leader when they agree in all of one band.
BANDS = ((0,), (1,), (2, 3), (4, 5), (6, 7), (8, 9, 10), (11, 12, 13), (14, 15, 16))
#: Members of an open group that are listed for each query; a larger group is met through the centres of its cells.
FEW = 8
#: Nodes whose sets are asked for by a list sent to the tasks (8 bytes each); beyond, all sets are joined.
ASKED = 2_000_000

_ODD = (np.random.default_rng(8).integers(1, 1 << 62, 17, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def shingle_sets(w: tx.Words, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted different shingle hashes of each row."""
    bounds = w.bounds()
    h = w.hash
    whole = h * np.uint64(0x9FB21C651E98DF25)
    full = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for i in range(size):
        full = full * np.uint64(0xD6E8FEB86659FD93) + h[i : len(h) - size + 1 + i]
    full = tx.mix(full)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= size:
            yield np.unique(full[a : b - size + 1])
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                short = short * np.uint64(0xA0761D6478BD642F) + whole[i : i + 1]
            yield tx.mix(short)
        else:
            yield h[:0]


@dataclass
class Order:
    """The common order of tokens: by hash, frequent tokens after all others by how frequent they are."""

    token: np.ndarray  # sorted
    rank: np.ndarray

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """Tokens as signed numbers, sorted."""
        key = tx.signed(tokens >> np.uint64(1)) | np.int64(-(1 << 63))
        if len(self.token):
            at = np.minimum(np.searchsorted(self.token, tokens), len(self.token) - 1)
            key = np.where(self.token[at] == tokens, self.rank[at], key)
        return np.sort(key)


def prefix_length(n: int) -> int:
    """First tokens among which a set of n shares one with every set that it links with."""
    return n - -(-NUM * n // DEN) + 1


def node_of(tokens: np.ndarray) -> int:
    """Name of a set: 64 bits of a sum of mixed tokens."""
    return int(tx.signed(tx.mix(np.array([np.sum(tx.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64) + np.uint64(len(tokens))])))[0])


def frequent_tokens(docs: DataFrame) -> Order:
    """Tokens that many of the sampled documents hold; they only decide the order of tokens."""
    one_of = min(ONE_OF, max(1, docs.count() // SMALL))
    sampled = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_of)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in tx.words(batch.column(0), tx.SPACED):
                sets = list(shingle_sets(w))
                token, n = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tx.signed(token)), pa.array(n)], ["token", "n"])

    counted = sampled.select("text").mapInArrow(store.tidy(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    chosen = counted.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(LAST).collect()
    token = np.array([r["token"] for r in chosen], np.int64).view(np.uint64)
    order = np.argsort(token)
    return Order(token[order], (len(token) - 1 - np.arange(len(token)))[order])


def sketch(docs: DataFrame, order: Order) -> DataFrame:
    """(row, doc_id, text_key, n, node, bands, prefix) per document; bands and prefix once per node and task, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, seen = TaskContext.get().partitionId() << 36, set()
        for batch in batches:
            for w in tx.words(batch.column(2), tx.SPACED):
                n, node, bands, prefix = [], [], [], []
                for tokens in shingle_sets(w):
                    name = node_of(tokens) if len(tokens) else 0
                    n.append(len(tokens))
                    node.append(name)
                    if not len(tokens) or name in seen:
                        bands.append(None)
                        prefix.append(None)
                        continue
                    seen.add(name)
                    low = np.array([(tokens * odd).min() for odd in _ODD]) * _ODD
                    bands.append(tx.signed(tx.mix(np.array([low[list(band)].sum() for band in BANDS]))))
                    prefix.append(order.of(tokens)[: prefix_length(len(tokens))])
                rows = np.arange(row, row + w.rows)
                row += w.rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows), batch.column(0).slice(w.first, w.rows), batch.column(1).slice(w.first, w.rows),
                        pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64())),
                    ],
                    ["row", "doc_id", "text_key", "n", "node", "bands", "prefix"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), store.text_key().alias("text_key"), "text")
    return chosen.mapInArrow(store.tidy(run), "row long, doc_id long, text_key long, n long, node long, bands array<long>, prefix array<long>")


def whole_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, tokens): the sets of the given nodes, read again from the documents."""
    few = nodes.select("node").distinct()
    asked = None
    if few.limit(ASKED + 1).count() <= ASKED:
        asked = np.sort(np.array([r["node"] for r in few.toLocalIterator()], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for w in tx.words(batch.column(0), tx.SPACED):
                names, sets = [], []
                for tokens in shingle_sets(w):
                    name = node_of(tokens) if len(tokens) else 0
                    if len(tokens) and name not in seen and (asked is None or tx.contains(asked, np.array([name]))[0]):
                        seen.add(name)
                        names.append(name)
                        sets.append(tokens.tobytes())
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], ["node", "tokens"])

    made = docs.select("text").mapInArrow(store.tidy(run), "node long, tokens binary")
    if asked is None:
        made = made.join(few, "node", "left_semi")
    return made.groupBy("node").agg(F.first("tokens").alias("tokens"))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, common): the sizes of the whole sets of the pairs (a, b) and how many tokens they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, x_raw, x = [], None, None
            for one, other in zip(batch.column(2), batch.column(3)):
                if x_raw is None or one.as_buffer() != x_raw:
                    x_raw = one.as_buffer()
                    x = np.frombuffer(x_raw, np.uint64)
                y = np.frombuffer(other.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) < len(y) else (y, x)
                sizes.append((len(x), len(y), int(tx.contains(large, small).sum())))
            found = np.array(sizes, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x) for x in found.T)], ["a", "b", "n_a", "n_b", "common"])

    first = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    second = first.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return second.select("a", "b", "x", "y").mapInArrow(store.tidy(run), "a long, b long, n_a long, n_b long, common long")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common) of the pairs whose whole sets link."""
    return compared(pairs, sets).where((NUM + DEN) * F.col("common") >= NUM * (F.col("n_a") + F.col("n_b"))).select("a", "b", "common")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, common) of the pairs (a, b) whose whole sets, read from the documents, link."""
    pairs = store.keep(pairs, "pairs")
    sets = store.keep(whole_sets(docs, pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))), "sets")
    return store.keep(linked(pairs, sets), "links")


def centred(links: DataFrame) -> DataFrame:
    """(node, c, y): the centre of every linked node, of itself and the nodes it links with the one with the most links, and
    the tokens it shares with it (null: itself)."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("c"), "common").unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("c"), "common"))
    degree = both.groupBy("c").agg(F.count("*").alias("links"))
    best = both.join(degree, "c").groupBy("node").agg(F.max(F.struct("links", "c", "common")).alias("best"))
    own = degree.select(F.col("c").alias("node"), F.struct("links", "c").alias("own"))
    other = F.struct(F.col("best.links"), F.col("best.c")) > F.col("own")
    return best.join(own, "node").select("node", F.when(other, F.col("best.c")).otherwise(F.col("node")).alias("c"), F.when(other, F.col("best.common")).alias("y"))


def leader_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): every node of a band of more than one with the band's leader.

    The leader is the most typical node: its rarest token is the least rare. Near copies of one text are
    nearer to that text than to each other.
    """
    banded = nodes.select("node", "n", F.element_at("prefix", 1).alias("rarest"), F.posexplode("bands").alias("band", "key"))
    led = banded.groupBy("band", "key").agg(F.max(F.struct("rarest", "node", "n")).alias("leader"), F.min("node").alias("low"), F.max("node").alias("high"))
    met = banded.join(led.where("low < high").select("band", "key", F.col("leader.node").alias("leader"), F.col("leader.n").alias("size")), ["band", "key"])
    near = F.least("n", "size") * DEN >= F.greatest("n", "size") * NUM
    return met.where((F.col("node") != F.col("leader")) & near).select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def shared_tokens(nodes: DataFrame) -> DataFrame:
    """(token, node, short) of the prefix tokens that more than one node has; short: among those that
    suffice to meet sets that are no smaller, ``n - ceil(2 t / (1 + t) n) + 1``.


    Rows are dealt and sorted by token and read as a stream: a token with very many nodes is a long run, never a group in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        told = False  # whether the held row was given out
        for batch in batches:
            token, node, short = (np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns))
            if not len(token):
                continue
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            token, node, short = token[new], node[new], short[new]
            same = token[1:] == token[:-1]
            more = np.zeros(len(token), bool)
            more[1:] |= same
            more[:-1] |= same
            out = more.copy()
            out[0] &= not told
            yield pa.RecordBatch.from_arrays([pa.array(token[out]), pa.array(node[out]), pa.array(short[out])], ["token", "node", "short"])
            told = bool(more[-1]) or (told and len(token) == 1)
            held = (token[-1:], node[-1:], short[-1:])

    short = F.col("place") < F.col("n") - F.ceil(F.col("n") * 2 * NUM / F.lit(float(NUM + DEN)) - F.lit(1e-9)) + 1
    rows = nodes.select(F.posexplode("prefix").alias("place", "token"), "node", "n").select("token", "node", short.alias("short"))
    return rows.repartition("token").sortWithinPartitions("token", "node").mapInArrow(store.tidy(run), "token long, node long, short boolean")


def _overlap(n: Column, m: Column) -> Column:
    """Tokens that sets of sizes n and m must share to link."""
    return F.ceil((n + m) * NUM / F.lit(float(NUM + DEN)) - F.lit(1e-9))


def _left(n: Column) -> Column:
    """Tokens of a set of size n that are not in its prefix."""
    return F.ceil(n * NUM / F.lit(float(DEN)) - F.lit(1e-9)) - 1


def _least_by_member(n: Column, low: Column, high: Column) -> Column:
    """Least number of tokens that a member of a size from low to high shares with a set of size n if its prefix ends first.

    The need falls with the member's size, save that it may rise by one from 4 k + 3 to 4 k + 4, where `_left` stands still.
    """
    turn = high - F.pmod(high + 1, F.lit(DEN))
    at = lambda m: _overlap(n, m) - _left(m)
    return F.when(turn >= low, F.least(at(high), at(turn))).otherwise(at(high))


@dataclass
class Matrix:
    """Shared tokens of the nodes placed in groups: ``placed`` (token, node, short, g), ``members`` (node, n, last, g), ``cells`` (token, g, short)."""

    placed: DataFrame
    members: DataFrame
    cells: DataFrame

    @classmethod
    def of(cls, facts: DataFrame, shared: DataFrame, groups: DataFrame) -> Matrix:
        members = store.keep(facts.join(groups, "node", "left").withColumn("g", F.coalesce("label", "node")).drop("label"), "members")
        placed = store.keep(shared.join(members.select("node", "g"), "node"), "placed")
        cells = placed.groupBy("token", "g").agg(F.max("short").alias("short"))
        several = cells.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low < high").select("token")
        return cls(placed, members, store.keep(cells.join(several, "token", "left_semi"), "matrix"))

    def opened(self) -> DataFrame:
        """(q, g, size, n, last): queries and groups that the overlap bound does not rule out; n and last are the query's.

        Of two groups the nodes of the one with fewer members ask. Some shared token must be among the
        first of the smaller set, so of the query or of a member.
        """
        count = self.members.groupBy("g").agg(F.count("*").alias("size"), F.min("n").alias("small"), F.max("n").alias("large"))
        asking = self.placed.join(count.select("g", F.col("size").alias("own_size")), "g").join(self.members.select("node", "n"), "node")
        asking = asking.select("token", F.col("node").alias("q"), F.col("g").alias("own"), F.col("short").alias("early"), "own_size", "n")
        cells = self.cells.join(count.select("g", "size", "small", "large"), "g")
        # by size, some member can link; and the token is among the first of whichever set is the smaller
        fits = (F.col("small") * NUM <= F.col("n") * DEN) & (F.col("large") * DEN >= F.col("n") * NUM) & (F.struct("own_size", "own") < F.struct("size", "g"))
        member_smaller = F.col("short") & (F.col("small") <= F.col("n"))
        found = asking.where("early").join(cells, "token").where(fits & ((F.col("large") >= F.col("n")) | member_smaller)).select("q", "g", "size")
        found = found.union(asking.where("NOT early").join(cells.where("short"), "token").where(fits & member_smaller).select("q", "g", "size")).distinct()
        # the tokens of a small group go with it as one list, as do those of a node; those of a large group are met one by one
        few = F.col("size") <= FEW
        asks = self.placed.groupBy(F.col("node").alias("q")).agg(F.collect_list("token").alias("x")).join(self.sizes(), "q")
        holds = cells.where(few).groupBy("g").agg(F.collect_list("token").alias("y"))
        met = found.where(few).select("q", "g").join(asks, "q").join(holds, "g").select("q", "g", F.size(F.array_intersect("x", "y")).cast("long").alias("common"), "n", "last")
        listed = found.where(~few).select("q", "g").join(self.placed.select(F.col("node").alias("q"), "token"), "q").join(self.cells, ["g", "token"])
        met = met.unionByName(listed.groupBy("q", "g").agg(F.count("*").alias("common")).join(self.sizes(), "q"))
        return self._reached(met, self.members, "g")

    def sizes(self) -> DataFrame:
        """(q, n, last) of every node."""
        return self.members.select(F.col("node").alias("q"), "n", "last")

    def _reached(self, met: DataFrame, members: DataFrame, part: str) -> DataFrame:
        """(q, part, size, n, last) of ``met`` (q, part, common, n, last) where the query's tokens in the part's union suffice for a member of the part."""
        count = members.groupBy(part).agg(
            F.count("*").alias("size"), F.min("n").alias("small"), F.max("n").alias("large"), F.min("last").alias("first_end"), F.max("last").alias("last_end")
        )
        met = met.join(count, part)
        low = F.greatest("small", F.ceil(F.col("n") * NUM / F.lit(float(DEN)) - F.lit(1e-9)))
        high = F.least("large", F.floor(F.col("n") * DEN / F.lit(float(NUM)) + F.lit(1e-9)))
        by_query = _overlap(F.col("n"), low) - _left(F.col("n"))
        by_member = _least_by_member(F.col("n"), low, high)
        need = F.when(F.col("last") <= F.col("first_end"), by_query).when(F.col("last") > F.col("last_end"), by_member).otherwise(F.least(by_query, by_member))
        return met.where((low <= high) & (F.col("common") >= need)).select("q", part, "size", "n", "last")

    def all_members(self, opened: DataFrame | None = None) -> DataFrame:
        """(a, b): the members of opened groups that share enough of the query's tokens."""
        opened = self.opened() if opened is None else opened
        asks = opened.select("q", "g", F.col("n").alias("n_q"), F.col("last").alias("last_q"))
        tokens = asks.join(self.placed.select(F.col("node").alias("q"), "token"), "q")
        common = tokens.join(self.placed.select("token", "g", F.col("node").alias("s")), ["g", "token"])
        pair = common.groupBy("q", "n_q", "last_q", "s").agg(F.count("*").alias("common"))
        pair = pair.join(self.members.select(F.col("node").alias("s"), F.col("n").alias("n_s"), F.col("last").alias("last_s")), "s")
        fits = F.least("n_q", "n_s") * DEN >= F.greatest("n_q", "n_s") * NUM
        ends_first = F.when(F.col("last_q") <= F.col("last_s"), F.col("n_q")).otherwise(F.col("n_s"))
        enough = F.col("common") >= _overlap(F.col("n_q"), F.col("n_s")) - _left(ends_first)
        return pair.where(fits & enough).select(F.least("q", "s").alias("a"), F.greatest("q", "s").alias("b"))


    def reached_cells(self, opened: DataFrame, members: DataFrame) -> DataFrame:
        """(q, c): the cells of opened groups that the overlap bound does not rule out. ``members``: node, n, last, g, c."""
        cells = self.placed.join(members.select("node", "c"), "node").select("token", "g", "c").distinct()
        met = opened.select("q", "g").join(self.placed.select(F.col("node").alias("q"), "token"), "q").join(cells, ["g", "token"])
        return self._reached(met.groupBy("q", "c").agg(F.count("*").alias("common")).join(self.sizes(), "q"), members, "c").select("q", "c")


def first_differences(rows: DataFrame, sets: DataFrame, order: Order) -> DataFrame:
    """(c, node, asks, token): of the tokens that only one of node and c has, all but ``need - 1`` of ``rows`` (node, c, need, asks).

    Tokens that the centre lacks come first, then those that the node lacks, each in the common order. Two nodes that
    differ from their centre alike in ``need`` tokens meet in one of these.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                node, c, need, asks, x, y = (column[at] for column in batch.columns)
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                token = np.concatenate([order.of(x[~tx.contains(y, x)]), order.of(y[~tx.contains(x, y)])])
                token = token[: max(len(token) - need.as_py() + 1, 0)]
                same = [pa.array(np.full(len(token), v.as_py())) for v in (c, node, asks)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(token)], ["c", "node", "asks", "token"])

    whole = rows.join(sets.select("node", F.col("tokens").alias("x")), "node").join(sets.select(F.col("node").alias("c"), F.col("tokens").alias("y")), "c")
    return whole.select("node", "c", "need", "asks", "x", "y").mapInArrow(store.tidy(run), "c long, node long, asks boolean, token long")


def through_centres(asked: DataFrame, members: DataFrame, sets: DataFrame, order: Order) -> DataFrame:
    """(a, b): for every (q, c) of ``asked`` a link of the query with the centre, where it links with some member by what both share
    with the centre, else its links with members of the cell.

    With x and y tokens of q and s in c and d tokens in which both differ from c alike, q and s share x + y - n_c + d.
    They link when ``(t + 1) d >= gap`` for ``gap = t (n_q + n_s) - (t + 1) (x + y - n_c)``, t in whole numbers as NUM to DEN.
    """
    total = NUM + DEN
    rest = members.where("node <> c").withColumn("part", NUM * F.col("n") - total * F.col("y"))
    met = compared(asked.select(F.col("q").alias("a"), F.col("c").alias("b")), sets).withColumnsRenamed({"a": "q", "b": "c"})
    met = met.join(rest.groupBy("c").agg(F.min("part").alias("least")), "c", "left").withColumn("own", NUM * F.col("n_a") - total * F.col("common") + total * F.col("n_b"))
    met = store.keep(met.withColumn("gap", F.col("own") + F.least(-DEN * F.col("n_b"), "least")), "centres")
    shows = met.where("gap <= 0").select(F.col("q").alias("a"), F.col("c").alias("b"))
    need = F.ceil(F.col("gap") / F.lit(float(total)) - F.lit(1e-9))
    can = F.col("gap") <= total * F.col("differ")
    asks = met.where("gap > 0 AND least IS NOT NULL").withColumn("differ", F.col("n_a") + F.col("n_b") - 2 * F.col("common")).where(can)
    open_cells = asks.groupBy("c").agg(F.min("own").alias("own"), F.max("n_b").alias("n_c"))
    answers = rest.join(open_cells, "c").withColumn("gap", F.col("own") + F.col("part")).withColumn("differ", F.col("n") + F.col("n_c") - 2 * F.col("y")).where(can)
    rows = asks.select(F.col("q").alias("node"), "c", need.alias("need"), F.lit(True).alias("asks")).unionByName(answers.select("node", "c", need.alias("need"), F.lit(False).alias("asks")))
    told = store.keep(first_differences(rows, sets, order), "differences")
    pairs = told.where("asks").select("c", "token", F.col("node").alias("a")).join(told.where("NOT asks").select("c", "token", F.col("node").alias("b")), ["c", "token"])
    return shows.unionByName(linked(store.keep(pairs.select("a", "b").distinct(), "pairs"), sets).select("a", "b"))


def links_across(matrix: Matrix, links: DataFrame, docs: DataFrame, order: Order) -> DataFrame:
    """(a, b): links between the groups that ``links`` made, enough to connect every two groups that link."""
    opened = store.keep(matrix.opened(), "opened")
    pairs = matrix.all_members(opened.where(F.col("size") <= FEW))
    large = opened.where(F.col("size") > FEW)
    if large.isEmpty():
        return verified(pairs, docs).select("a", "b")
    pairs = store.keep(pairs, "pairs")
    members = matrix.members.join(large.select("g").distinct(), "g", "left_semi").join(centred(links), "node")
    members = store.keep(members.withColumn("y", F.coalesce("y", "n")), "cells")
    asked = store.keep(matrix.reached_cells(large, members), "asked")
    cell = members.join(asked.select("c").distinct(), "c", "left_semi").select("node")
    named = [pairs.select(F.col("a").alias("node")), pairs.select(F.col("b").alias("node")), asked.select(F.col("q").alias("node")), asked.select(F.col("c").alias("node")), cell]
    sets = store.keep(whole_sets(docs, reduce(DataFrame.unionByName, named)), "sets")
    return store.keep(linked(pairs, sets).select("a", "b").unionByName(through_centres(asked, members, sets, order)), "links")


def regrouped(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) of the groups after links (a, b) between nodes of different groups."""
    named = lambda side: links.select("a", "b").join(groups.select(F.col("node").alias(side), F.col("label").alias("g")), side, "left").select(F.coalesce("g", side).alias(f"g{side}"), "a", "b")
    ends = named("a").join(named("b").select("a", "b", "gb"), ["a", "b"]).select(F.col("ga").alias("a"), F.col("gb").alias("b")).distinct()
    merged = components(ends)
    top = merged.select(F.col("node").alias("g"), F.col("label").alias("top"))
    label = groups.select("node", F.col("label").alias("g")).join(top, "g", "left").select("node", F.coalesce("top", "g").alias("label"))
    return store.keep(label.unionByName(merged.join(groups, "node", "left_anti").select("node", "label")), "groups")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """Per document row: row, doc_id, text_key, n_shingles, component_id, and first (it is the one of its component to stay)."""
    order = frequent_tokens(docs)
    table = store.keep(sketch(docs, order), "sketch")
    nodes = table.where("prefix IS NOT NULL")
    links = verified(leader_pairs(nodes), docs)
    groups = components(links)
    facts = nodes.select("node", "n", F.element_at("prefix", -1).alias("last")).dropDuplicates(["node"])
    shared = store.keep(shared_tokens(nodes), "shared-tokens")
    facts = store.keep(facts.join(shared.select("node").distinct(), "node", "left_semi"), "facts")
    label = regrouped(groups, links_across(Matrix.of(facts, shared, groups), links, docs, order))
    # smallest id, and the row that stays, per set and then per component
    best = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("best")
    per_node = table.where("n > 0").groupBy("node").agg(best)
    per_node = per_node.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per_part = per_node.groupBy("label").agg(F.min("best").alias("best"))
    found = per_node.select("node", "label").join(per_part, "label").select("node", F.col("best.doc_id").alias("smallest"), F.col("best.row").alias("stays"))
    out = table.select("row", "doc_id", "text_key", F.col("n").alias("n_shingles"), "node").join(store.keep(found, "components"), "node", "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "row", "doc_id", "text_key", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"), (alone | (F.col("row") == F.col("stays"))).alias("first")
    )
