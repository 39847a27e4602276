"""The prefix trie of conversations, peeled from its deepest turns.

A node is a distinct sequence of first turns; the root has none. Turns are told apart by two 64-bit hashes
of role, text and place, a sequence by the exclusive or of those of its turns, so keys of 128 bits run along a
conversation without anything being collected.

Peeling starts at the greatest depth. In every round the conversations that end at this depth join the
surviving nodes; equal sequences merge, which discovers the nodes of the depth with their counts and sums; then the
last turn is stripped and the rest regrouped one level up. Rounds of a band of depths are one plan whose
shuffles are reused; a written table cuts the lineage after each band.

Before that, equal conversations are one sequence with a number of members. A conversation that no other
sequence joins below a depth of 8, 16, 32 ... is alone from there on: its nodes there are told by its own turns,
in as many tasks as they lie in, and it enters the peeling at that depth. So the number of rounds is at
most twice the longest beginning that two different sequences share, not the longest conversation, and
a surviving node carries keys of so many turns only.

Ids of conversations that end at a node are put in order over all tasks and packed into texts of one Arrow batch;
a task hashes a node's texts one after the other, so no list of a node's members is ever held.

Rows without ``conv_id`` belong to no conversation. Null roles and texts are empty, null turns come first,
turns with equal numbers are ordered by hashes of role and text; repeated rows are turns of their own. An empty table has
no nodes, not even a root. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm import store
from stratalake.llm.order import placed

#: Conversations take their first turns from one whose id is a multiple of this.
FAMILY = 100
#: Turns of a conversation that a task numbers at once.
RUN = 1024
#: Least depth at which a conversation may be taken for alone.
SHALLOW = 8
#: Depths whose rounds are one plan.
BAND = 8


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, a, b, size, group_size): place from 0, hashes and code points of each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    hashed = [F.xxhash64(F.lit(salt), role, text).alias(name) for salt, name in ((1, "a"), (2, "b"))]
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *hashed, F.length(text).cast("long").alias("size"))
    return placed(store.keep(rows, "turn-hashes"), "conv_id", ["turn", "a", "b"], "turns").drop("turn")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turn rows (conv_id, pos from 1, a, b, size, length), and (conv_id, length) of every conversation.

    Each conversation begins with the first turns of the first one of its family, in place of as many of its own.
    """
    rows = turns(conversations)
    family, shared = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), shared_turns(F.col("conv_id"))
    bases = rows.where(F.col("conv_id") % FAMILY == 0)
    sizes = bases.where("place = 0").select(F.col("conv_id").alias("family"), F.col("group_size").alias("base"))
    taken = F.least("h", F.coalesce("base", F.lit(0)))
    length = (taken + F.greatest(F.col("group_size") - F.col("h"), F.lit(0))).alias("length")
    own = rows.withColumns({"family": family, "h": shared}).join(sizes, "family", "left")
    convs = own.where("place = 0").select("conv_id", "family", "h", length)
    begins = bases.where("place < 5").select(F.col("conv_id").alias("family"), "place", "a", "b", "size")
    begins = convs.join(begins, "family").where("place < h").select("conv_id", (F.col("place") + 1).alias("pos"), "a", "b", "size", "length")
    own = own.where("place >= h").select("conv_id", (F.col("place") + 1 - F.col("h") + taken).alias("pos"), "a", "b", "size", length)
    return begins.unionByName(own), convs.select("conv_id", "length")


def keyed(rows: DataFrame) -> DataFrame:
    """Turn rows with the key of the sequence up to them (ka, kb), that of its parent (pa, pb) and the code points so far.

    Runs of `RUN` turns are summed up each on its own; totals of earlier runs are added to later ones.
    """
    rows = rows.withColumns({"a": F.xxhash64("a", "pos"), "b": F.xxhash64("b", "pos", F.lit(2)), "run": F.expr(f"(pos - 1) div {RUN}")})
    within = Window.partitionBy("conv_id", "run").orderBy("pos")
    rows = rows.withColumns({"ka": F.bit_xor("a").over(within), "kb": F.bit_xor("b").over(within), "cum": F.sum("size").over(within)})
    ends = rows.where(f"pos % {RUN} = 0").select("conv_id", (F.col("run") + 1).alias("run"), "ka", "kb", "cum")
    earlier = Window.partitionBy("conv_id").orderBy("run")
    carried = ends.select("conv_id", "run", F.bit_xor("ka").over(earlier).alias("xa"), F.bit_xor("kb").over(earlier).alias("xb"), F.sum("cum").over(earlier).alias("more"))
    zero = F.lit(0).cast("long")
    rows = rows.join(carried, ["conv_id", "run"], "left").withColumns(
        {"ka": F.col("ka").bitwiseXOR(F.coalesce("xa", zero)), "kb": F.col("kb").bitwiseXOR(F.coalesce("xb", zero)), "cum": F.col("cum") + F.coalesce("more", zero)}
    )
    return rows.select("conv_id", "pos", "length", "size", "cum", "ka", "kb", F.col("ka").bitwiseXOR(F.col("a")).alias("pa"), F.col("kb").bitwiseXOR(F.col("b")).alias("pb"))


STATE = ["conv_id", "n_convs", "kid", "n_leaves", "saved", "chain"]
NODE = ["depth", "ka", "kb", "pa", "pb", "conv_id", "n_convs", "n_children", "n_leaves", "saved"]


def _alone(reps: DataFrame) -> DataFrame:
    """(conv_id, alone): the least of the depths 8, 16, 32 ... at which a sequence meets no other one."""
    probes = reps.where(f"pos >= {SHALLOW} AND (pos & (pos - 1)) = 0")
    counted = probes.groupBy("ka", "kb").agg(F.min("conv_id").alias("conv_id"), F.min("pos").alias("pos"), F.count("*").alias("n"))
    return counted.where("n = 1").groupBy("conv_id").agg(F.min("pos").alias("alone"))


def _regrouped(state: DataFrame, depth: int) -> DataFrame:
    """The nodes of a depth from what ends there and what came up from below."""
    sums = [F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "kid", "n_leaves", "saved"))]
    own = F.element_at("chain", -1)["size"] if depth else F.lit(0)
    nodes = state.groupBy("chain").agg(*sums)
    return nodes.select(
        "conv_id", "n_convs", F.col("kid").alias("n_children"), F.when(F.col("kid") == 0, 1).otherwise(F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * own).alias("saved"), "chain",
    )


def _stripped(nodes: DataFrame) -> DataFrame:
    """Nodes as children of their parents: the last turn goes."""
    return nodes.select("conv_id", "n_convs", F.lit(1).cast("long").alias("kid"), "n_leaves", "saved", F.expr("slice(chain, 1, size(chain) - 1)").alias("chain"))


def _peeled(entering: DataFrame) -> DataFrame:
    """Nodes of all depths from the sequences that enter at each ``depth``."""
    top = entering.agg(F.max("depth")).first()[0]
    if top is None:
        top = -1
    state, bands = None, []
    for deepest in range(top, -1, -BAND):
        found = []
        last = max(deepest - BAND + 1, 0)
        for depth in range(deepest, last - 1, -1):
            ended = entering.where(F.col("depth") == depth).select(*STATE)
            nodes = _regrouped(ended if state is None else ended.unionByName(state), depth)
            key = [F.element_at("chain", -1)[k].alias(k) if depth else F.lit(0).cast("long").alias(k) for k in ("ka", "kb")]
            up = [F.element_at("chain", -2)[k] if depth > 1 else F.lit(0 if depth else None).cast("long") for k in ("ka", "kb")]
            found.append(nodes.select(
                F.lit(depth).cast("long").alias("depth"), *key, up[0].alias("pa"), up[1].alias("pb"), "conv_id", "n_convs", "n_children", "n_leaves", "saved",
                "chain" if depth == last else F.lit(None).cast(nodes.schema["chain"].dataType).alias("chain"),
            ))
            state = _stripped(nodes)
        band = found[0]
        for more in found[1:]:
            band = band.unionByName(more)
        band = store.keep(band, "trie-band")
        bands.append(band.select(*NODE))
        state = _stripped(band.where(F.col("depth") == last))
    if not bands:
        return entering.sparkSession.createDataFrame([], ", ".join(f"{c} long" for c in NODE))
    out = bands[0]
    for more in bands[1:]:
        out = out.unionByName(more)
    return out


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (ka, kb, conv_id) to (ka, kb, first, ids): the ids of a key within a batch, comma-joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ka, kb, ids = (c.to_numpy() for c in batch.columns)
        cut = [0, *((ka[1:] != ka[:-1]) | (kb[1:] != kb[:-1])).nonzero()[0] + 1]
        joined = [",".join(map(str, ids[x:y].tolist())) for x, y in zip(cut, [*cut[1:], len(ids)])]
        yield pa.RecordBatch.from_arrays([pa.array(ka[cut]), pa.array(kb[cut]), pa.array(ids[cut]), pa.array(joined)], ["ka", "kb", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (ka, kb, first, ids) to (ka, kb, ends_sha256): the texts of a key are hashed as one."""
    key, running = None, None

    def row(key: tuple[int, int], text: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([text])], ["ka", "kb", "ends_sha256"])

    for batch in batches:
        done = []
        for ka, kb, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
            if (ka, kb) != key:
                if running is not None:
                    done.append((*key, running.hexdigest()))
                key, running = (ka, kb), hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.as_buffer())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["ka", "kb", "ends_sha256"])
    if running is not None:
        yield row(key, running.hexdigest())


def _ends(convs: DataFrame) -> DataFrame:
    """(ka, kb, ends_sha256) of the sequences of (ka, kb, conv_id)."""
    order = ["ka", "kb", "conv_id"]
    packed = convs.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed, "ka long, kb long, first long, ids string")
    keys = ["ka", "kb", "first"]
    return packed.repartition("ka", "kb").sortWithinPartitions(*keys).mapInArrow(_hashed, "ka long, kb long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = rebuilt(conversations)
    rows = store.keep(keyed(rows), "turn-keys")
    zero = F.lit(0).cast("long")
    lasts = rows.where("pos = length").select("conv_id", "length", "ka", "kb", "cum")
    bare = convs.where("length = 0").select("conv_id", "length", zero.alias("ka"), zero.alias("kb"), zero.alias("cum"))
    lasts = store.keep(lasts.unionByName(bare), "conversations")
    sequences = lasts.groupBy("ka", "kb").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("cum").alias("total"), F.max("length").alias("length"))
    sequences = store.keep(sequences, "sequences")
    reps = rows.join(sequences.select("conv_id", "n", "total"), "conv_id")
    reps = reps.join(_alone(reps), "conv_id", "left").withColumn("enter", F.coalesce("alone", "length"))
    reps = store.keep(reps, "sequence-turns")

    others = F.col("n") - 1
    tails = reps.where("pos > enter").select(
        F.col("pos").alias("depth"), "ka", "kb", "pa", "pb", "conv_id", F.col("n").alias("n_convs"), (F.col("pos") < F.col("length")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), (others * (F.col("total") - F.col("cum") + F.col("size"))).alias("saved"), F.col("conv_id").alias("parent_conv_id"),
    )
    link = F.struct("pos", "ka", "kb", "size")
    entering = reps.where("pos <= enter").groupBy("conv_id").agg(
        F.max("enter").alias("depth"), F.max("n").alias("n_convs"), F.max("total").alias("total"), F.max("length").alias("length"), F.max("cum").alias("cum"),
        F.sort_array(F.collect_list(link)).alias("chain"),
    )
    goes_on = F.col("length") > F.col("depth")
    entering = entering.select(
        "depth", "conv_id", "n_convs", goes_on.cast("long").alias("kid"), goes_on.cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * (F.col("total") - F.col("cum"))).alias("saved"), "chain",
    )
    empty = sequences.where("length = 0").select(zero.alias("depth"), "conv_id", F.col("n").alias("n_convs"), zero.alias("kid"), zero.alias("n_leaves"), zero.alias("saved"))
    entering = store.keep(entering.unionByName(empty.withColumn("chain", F.array().cast(entering.schema["chain"].dataType))), "entering")

    peeled = _peeled(entering)
    parents = peeled.where("n_children > 0").select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    nodes = peeled.join(parents, ["pa", "pb"], "left").unionByName(tails)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(_ends(lasts), ["ka", "kb"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
