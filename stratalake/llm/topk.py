"""Exact top-k search by distributed histogram selection.

Vectors are packed in blocks of whole-number matrices, queries apart from candidates, and every query
block meets every candidate block as matrix products. Scores are never stored: a pass counts, per query,
how many scores fall into each of ``BINS`` parts of the interval that holds the k-th best; the counts
are summed over all blocks and the part that holds the k-th best becomes the next interval, until it is
one value wide. A last pass keeps the scores above that value and, at the value itself, as many of the
smallest ids as are still needed. A block reports no part below its own k-th best, and no more tied ids
than are needed, so a vector that a third of all rows has costs a block no more than any other.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without an
id, nor finite vectors so long (beyond 2^30.5 in whole units) that a score might leave a long. Vectors are compared with those of the same dimension. Rows with the id of a query are its own;
repeated query rows give repeated results. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm import store

BINS = 1024
QUERY_ROWS, CANDIDATE_ROWS = 256, 2048
#: Squared length, in whole units, from which on a vector takes no part.
MOST = 1 << 61
#: Query blocks that meet a candidate block in one task.
TOGETHER = 8


def whole_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component of the vectors that take part."""
    x = "transform(embedding, x -> cast(x as double))"
    good = f"vec_id is not null and size(embedding) > 0 and forall({x}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    # by Cauchy and Schwarz no score of two such vectors leaves 61 bits; flooring adds at most one to a component
    fits = f"pow(sqrt(aggregate({x}, 0D, (s, x) -> s + pow({scale}D * x, 2))) + sqrt(size(embedding)), 2) < {float(MOST)!r}D"
    return vectors.where(good).where(fits).select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"transform({x}, x -> floor({scale}D * x))").alias("v"))


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """(block, dim, ids, matrix): up to ``rows`` vectors of one dimension and task, as little-endian 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def emit(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, matrix = (np.concatenate(x) for x in zip(*held.pop(dim)))
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([task + made]), pa.array([dim]), pa.array([ids.tobytes()]), pa.array([matrix.astype("<i8").tobytes()])], ["block", "dim", "ids", "matrix"])

        for batch in batches:
            ids, column = np.asarray(batch.column(0)), batch.column(1)
            cut = np.asarray(column.offsets)
            values = np.asarray(column.values)
            dims = np.diff(cut)
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                while len(mine):
                    room = rows - sum(len(a) for a, _ in held.get(dim, []))
                    now, mine = mine[:room], mine[room:]
                    held.setdefault(dim, []).append((ids[now], values[cut[now][:, None] + np.arange(dim)]))
                    if len(now) == room:
                        yield emit(dim)
        for dim in list(held):
            yield emit(dim)

    return vectors.mapInArrow(run, "block long, dim long, ids binary, matrix binary")


def _scores(ids: bytes, matrix: bytes, own: bytes, queries: bytes, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids, scores; a query's own rows get the smallest integer."""
    q_ids, c_ids = np.frombuffer(own, "<i8"), np.frombuffer(ids, "<i8")
    q, c = np.frombuffer(queries, "<i8").reshape(-1, dim), np.frombuffer(matrix, "<i8").reshape(-1, dim)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * dim
    if most < 2**24:
        s = (q.astype(np.float32) @ c.astype(np.float32).T).astype(np.int64)
    elif most < 2**53:
        s = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        s = q @ c.T
    s[q_ids[:, None] == c_ids[None, :]] = np.iinfo(np.int64).min
    return q_ids, c_ids, s


def _counter(shift: int, parts: int):
    """Counts scores in ``parts`` parts of width 2^shift from each query's lower end on, leaving out parts below the block's own k-th best."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        for c in left.to_pylist():
            for r in right.to_pylist():
                _, _, s = _scores(c["ids"], c["matrix"], r["own"], r["queries"], c["dim"])
                lows, need = np.array(r["low"]), np.array(r["need"])
                part = np.where(s > np.iinfo(np.int64).min, s - lows[:, None], -1) >> shift
                inside = (part >= 0) & (part < parts)
                flat = (part + np.arange(len(lows))[:, None] * parts)[inside]
                counts = np.bincount(flat, minlength=len(lows) * parts).reshape(-1, parts)
                above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
                row, bin_ = np.nonzero((counts > 0) & (above < need[:, None]))
                out.append((np.full(len(row), r["block"]), row, bin_, counts[row, bin_]))
        columns = [np.concatenate(x).astype(np.int64) for x in zip(*out)] or [np.empty(0, np.int64)] * 4
        return pa.table(columns, ["block", "q", "bin", "n"])

    return count


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of largest inner product of every query row, ties to smaller ids."""
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, scale)
    candidates = store.keep(_blocks(whole, CANDIDATE_ROWS), "candidate-blocks")
    queries = store.keep(_blocks(whole.where(is_query), QUERY_ROWS), "query-blocks")
    # numbers of the blocks of a dimension: one row per block
    number = F.row_number().over(Window.partitionBy("dim").orderBy("block")) - 1
    numbered = candidates.select("block", "dim", number.alias("no"))
    pairs = (
        queries.select("block", "dim", F.floor((F.row_number().over(Window.partitionBy("dim").orderBy("block")) - 1) / TOGETHER).alias("together"))
        .join(numbered.groupBy("dim").agg(F.max("no").alias("last")), "dim").select("block", "together", F.col("dim").alias("d"), F.explode(F.sequence(F.lit(0), "last")).alias("no"))
        .join(numbered.select("no", F.col("dim").alias("d"), F.col("block").alias("candidate")), ["d", "no"]).select("block", "together", "candidate")
    )
    pairs = store.keep(pairs, "block-pairs")
    sides = candidates.withColumnRenamed("block", "candidate").join(pairs.select("candidate", "together").distinct(), "candidate")
    longest = whole.select(F.max(F.expr("aggregate(v, 0D, (s, x) -> s + pow(cast(x as double), 2))"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    reach = int(longest * (1 + 1e-9)) + 1  # no score lies further from 0 than the longest vector's own
    low, bits = -reach, max(1, (2 * reach + 1).bit_length())

    def meet(state: DataFrame, run, schema: str) -> DataFrame:
        """Every query block with its state beside every candidate block."""
        own = queries.select("block", F.col("ids").alias("own"), F.col("matrix").alias("queries")).join(state, "block").join(pairs, "block")
        own = own.withColumnsRenamed({"candidate": "with", "together": "part"})
        own = own.select(*(F.col(c).alias(f"{c}_") for c in own.columns)).toDF(*own.columns)
        return sides.groupBy("candidate", "together").cogroup(own.groupBy("with", "part")).applyInArrow(run, schema)

    # per query: lower end of its interval, and how many of the k are to be found from there on up
    state = queries.select("block", F.expr(f"array_repeat({low}L, cast(length(ids) / 8 as int))").alias("low"), F.expr(f"array_repeat({k}L, cast(length(ids) / 8 as int))").alias("need"))
    step = int(math.log2(BINS))
    while bits > 0:
        shift = max(bits - step, 0)

        counted = meet(state, _counter(shift, 1 << (bits - shift)), "block long, q long, bin long, n long").groupBy("block", "q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("block", "q").orderBy(F.desc("bin"))
        want = state.select("block", F.posexplode(F.arrays_zip("low", "need")).alias("q", "s")).select("block", F.col("q").cast("long").alias("q"), "s.low", "s.need")
        summed = counted.withColumn("upto", F.sum("n").over(down)).join(want, ["block", "q"], "right")
        # the first part from above that reaches the need; with fewer candidates than needed, all are taken
        reached = F.min_by(F.struct("bin", (F.col("upto") - F.col("n")).alias("above")), F.struct((F.col("upto") < F.col("need")).alias("short"), F.col("upto")))
        found = summed.groupBy("block", "q").agg(reached.alias("at"), F.max(F.coalesce("upto", F.lit(0))).alias("total"), F.first("low").alias("low"), F.first("need").alias("need"))
        enough = F.col("total") >= F.col("need")
        new_low = F.when(enough, F.col("low") + F.col("at.bin") * (1 << shift)).otherwise(F.col("low"))
        new_need = F.when(enough, F.col("need") - F.col("at.above")).otherwise(F.col("need"))
        listed = found.select("block", F.struct("q", new_low.alias("low"), new_need.alias("need")).alias("s")).groupBy("block").agg(F.sort_array(F.collect_list("s")).alias("s"))
        state = store.keep(listed.select("block", F.col("s.low").alias("low"), F.col("s.need").alias("need")), "selection")
        bits = shift

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        for c in left.to_pylist():
            for r in right.to_pylist():
                q_ids, c_ids, s = _scores(c["ids"], c["matrix"], r["own"], r["queries"], c["dim"])
                lows, need = np.array(r["low"]), np.array(r["need"])
                short = lows == low  # everything that is left above the smallest possible score
                row, at = np.nonzero(s > lows[:, None])
                tied, where = np.nonzero((s == lows[:, None]) & (need > 0)[:, None])
                order = np.lexsort((c_ids[where], tied))
                tied, where = tied[order], where[order]
                place = np.arange(len(tied)) - np.searchsorted(tied, tied)
                kept = (place < need[tied]) | short[tied]
                row, at = np.concatenate([row, tied[kept]]), np.concatenate([at, where[kept]])
                out.append((np.full(len(row), r["block"]), row, q_ids[row], c_ids[at], s[row, at]))
        columns = [np.concatenate(x).astype(np.int64) for x in zip(*out)] or [np.empty(0, np.int64)] * 5
        return pa.table(columns, ["block", "q", "query_id", "vec_id", "score"])

    chosen = meet(state, choose, "block long, q long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("block", "q").orderBy(F.desc("score"), "vec_id"))
    return chosen.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
