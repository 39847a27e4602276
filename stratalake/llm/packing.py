"""Packing of tokenized documents into as few sequences of a fixed capacity as possible.

1. Every document becomes its ids and an end id; longer ones are cut so that all pieces but the first
   are full. Each task numbers the pieces of one length in the order in which it meets them.
2. The histogram of piece lengths has at most ``capacity`` entries whatever the corpus holds; only it
   reaches the driver. The configuration linear program over it (how often is each multiset of lengths
   that fits one sequence used) is solved by multiplicative weights: each length has a price, a
   knapsack dynamic program finds the configuration of the highest price, which is used as often as the
   scarcest of its lengths allows within one step, and prices of lengths that are covered fall.
3. Half of the fractional use of every configuration is rounded down and taken. What stays uncovered is packed twice, by
   further knapsack solutions over the remaining counts and by best fit, and the better one is taken.
4. The rank of a piece among those of its length (task offset plus number within the task) falls in one
   range of the plan, which gives sequence and offset. A length that a third of the corpus has is
   ranked by its tasks, never in one of them.

Null text is the empty document: its end id alone. Nulls elsewhere, ties and repeated rows are kept as
rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm import store
from stratalake.llm.text import ranges
from stratalake.llm.tokens import ByteBpe

#: Part of the fractional use of a configuration that is rounded down and taken; the rest is packed anew.
SHARE = 0.5
_encoders: dict[str, ByteBpe] = store.remembered({})


def encode_pieces(docs: DataFrame, path: str, pattern: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with ids if asked; task and number rank pieces of a length."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = ByteBpe(path, pattern)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids_of = batch.column(0)
            for first, ids, bounds in _encoders[path].encode(batch.column(1)):
                rows = len(bounds) - 1
                tokens = np.diff(bounds) + 1
                all_ids = np.full(int(tokens.sum()), end_id, "<u4")
                at = np.concatenate([[0], np.cumsum(tokens)])
                all_ids[ranges(at[:-1], tokens - 1)] = ids
                pieces = -(-tokens // capacity)
                head = tokens - (pieces - 1) * capacity
                row = np.repeat(np.arange(rows), pieces)
                piece = ranges(np.zeros(rows, np.int64), pieces)
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                blob, lo = memoryview(all_ids).cast("B"), (at[row] + start) * 4
                crc = [zlib.crc32(blob[a:b]) for a, b in zip(lo.tolist(), (lo + length * 4).tolist())]
                order = np.argsort(length, kind="stable")
                run_start = np.searchsorted(length[order], length[order])
                number = np.empty(len(length), np.int64)
                number[order] = np.arange(len(length)) - run_start + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                out = [ids_of.take(pa.array(row + first)), piece.astype(np.int32), start, length, np.array(crc, np.int64), np.full(len(row), task, np.int32), number]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
                if with_ids:
                    flat = pa.array(all_ids.astype(np.int32))
                    cuts = np.append(at[row] + start, at[-1]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(cuts), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out], names)

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return chosen.mapInArrow(store.tidy(run), schema + (", ids array<int>" if with_ids else ""))


def _knapsack(weight: np.ndarray, count: np.ndarray, capacity: int) -> np.ndarray:
    """How often each length is taken in a multiset of most weight with lengths summing to at most ``capacity``.

    Lengths are 1 to capacity; no more of a length than ``count`` has. Dynamic program over capacities,
    with counts split in powers of two.
    """
    best = np.zeros(capacity + 1)
    taken: list[tuple[int, int, np.ndarray]] = []
    for length in np.flatnonzero((count > 0) & (weight > 0)).tolist()[::-1]:
        left, times = int(min(count[length], capacity // length)), 1
        while left > 0:
            n = min(times, left)
            size = n * length
            other = best[:-size] + n * weight[length]
            better = other > best[size:] + 1e-12
            if better.any():
                best[size:] = np.where(better, other, best[size:])
            taken.append((length, n, better))
            left -= n
            times *= 2
    use, room = np.zeros(capacity + 1, np.int64), int(np.argmax(best))
    for length, n, better in reversed(taken):
        size = n * length
        if room >= size and better[room - size]:
            use[length] += n
            room -= size
    return use


def solve_configurations(histogram: np.ndarray, capacity: int, rounds: int = 600, eta: float = 20.0) -> tuple[list[tuple[np.ndarray, float]], float]:
    """Configurations with their fractional use, and a lower bound on the number of sequences.

    Multiplicative weights for the covering program min sum x, A x >= histogram: the price of a length is
    its share of the capacity times exp(-eta * covered part). A round uses the configuration of the
    highest price as often as covers at most ``step`` of its scarcest length. Prices scaled so that no
    configuration costs more than 1 are dual feasible, which bounds the optimum from below.
    """
    lengths = np.flatnonzero(histogram)
    start = np.arange(capacity + 1) / capacity
    step = min(1.0, max(0.02, len(lengths) / rounds))
    covered = np.zeros(capacity + 1)
    wanted = np.maximum(histogram, 1)
    used: dict[bytes, tuple[np.ndarray, float]] = {}
    bound = float((histogram * start).sum())
    for _ in range(rounds):
        part = covered / wanted
        if not len(lengths) or part[lengths].min() >= 1:
            break
        price = np.where(histogram > 0, start * np.exp(-eta * (part - part[lengths].min())), 0)
        config = _knapsack(price, histogram, capacity)
        on = np.flatnonzero(config)
        bound = max(bound, float((price * histogram).sum() / (price * config).sum()))
        amount = step * float((histogram[on] / config[on]).min())
        key = config[on].tobytes() + on.tobytes()
        used[key] = (config, used.get(key, (config, 0.0))[1] + amount)
        covered[on] += amount * config[on]
    return list(used.values()), bound


@dataclass
class Plan:
    """Ranges of ranks of each length: from which rank on, first sequence, offset in the sequence."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    bound: float

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.searchsorted(self.length, np.stack([length, length + 1]))
        out = np.empty((2, len(length)), np.int64)
        for value in np.unique(length):
            mine = np.flatnonzero(length == value)
            lo, hi = cut[0][mine[0]], cut[1][mine[0]]
            at = lo + np.searchsorted(self.rank[lo:hi], rank[mine], "right") - 1
            out[0, mine] = self.sequence[at] + rank[mine] - self.rank[at]
            out[1, mine] = self.offset[at]
        return out[0], out[1]


def _fill(left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Residual: the longest length, and the knapsack solution that fills its room best, as often as both last."""
    chosen = []
    a = np.arange(capacity + 1)
    price = a * (1 + a / capacity**2)  # of equal fillings the one with the longer lengths
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        room, rest = capacity - longest, left.copy()
        rest[longest] -= 1
        config = np.zeros(capacity + 1, np.int64)
        if room:
            config[: room + 1] = _knapsack(price[: room + 1], rest[: room + 1], room)
        config[longest] += 1
        on = np.flatnonzero(config)
        times = int((left[on] // config[on]).min())
        chosen.append((config, times))
        left[on] -= times * config[on]
    return chosen


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Residual: longest lengths first, each into the fullest open sequences that hold it."""
    open_: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]  # by room: contents and how often
    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            room = next((r for r in range(length, capacity) if open_[r]), capacity)
            if room < capacity:
                inside, n = open_[room].popitem()
            else:
                inside, n = (), max(1, count // (capacity // length))
            used, fits = min(n, count), 1
            if not inside:
                fits = min(capacity // length, count // used)
            if used < n and inside:
                open_[room][inside] = n - used
            full = (*inside, *([length] * fits))
            into = open_[room - fits * length]
            into[full] = into.get(full, 0) + used
            count -= used * fits
    chosen = []
    for groups in open_:
        for inside, n in groups.items():
            config = np.zeros(capacity + 1, np.int64)
            np.add.at(config, list(inside), 1)
            chosen.append((config, n))
    return chosen


def plan_packing(histogram: np.ndarray, capacity: int, rounds: int = 600) -> Plan:
    """Whole uses of configurations that cover the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    fractional, bound = solve_configurations(left.copy(), capacity, rounds)
    chosen: list[tuple[np.ndarray, int]] = []
    for config, amount in sorted(fractional, key=lambda x: -x[1]):
        on = np.flatnonzero(config)
        times = int(min(np.floor(SHARE * amount + 1e-9), (left[on] // config[on]).min()))
        if times:
            chosen.append((config, times))
            left[on] -= times * config[on]
    chosen += min(_fill(left.copy(), capacity), _best_fit(left, capacity), key=lambda c: sum(n for _, n in c))
    rows, next_rank, next_sequence = [], np.zeros(capacity + 1, np.int64), 0
    for config, times in chosen:
        offset = 0
        for length in np.flatnonzero(config).tolist()[::-1]:
            for _ in range(int(config[length])):
                rows.append((length, int(next_rank[length]), next_sequence, offset))
                next_rank[length] += times
                offset += length
        next_sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], next_sequence, bound)


def histogram_of(pieces: DataFrame, capacity: int) -> np.ndarray:
    """Number of pieces of each length: at most ``capacity`` rows reach the driver."""
    out = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        out[row["length"]] = row["count"]
    return out


def pack(docs: DataFrame, path: str, pattern: str, end_id: int = 2, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    pieces = store.keep(encode_pieces(docs, path, pattern, end_id, capacity, with_ids), "pieces")
    plan = plan_packing(histogram_of(pieces, capacity), capacity)
    order = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("number"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, " + ("ids array<int>, " if with_ids else "") + "sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            sequence, offset = plan.place(length, rank)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "rank").mapInArrow(store.tidy(place), schema)
