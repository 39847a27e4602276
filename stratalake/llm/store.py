"""Intermediate tables in the shared folder of the session.

A table that several later steps read is written once below ``spark.checkpoint.dir`` and read back.
That cuts the lineage: when an executor is lost, later steps read the files again instead of
recomputing what led to them.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; only a local session may go without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "stratalake-llm")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:16]}"


#: Arrow batches sent to Python tasks, so that long texts and large sets do not add up.
BATCH_BYTES = 8 << 20


def bounded(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches bounded in bytes, not only in rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for `mapInArrow`; when a task has ended, its worker gives freed memory back to the system.

    Workers serve one stage after the other; without this each keeps the most that any of them has needed. What a worker
    remembers (`remembered`) stays from task to task of one operator and goes when another operator's task begins.
    """
    owner = run.__module__

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(owner)
        yield from run(batches)
        give_back()

    return whole


_remembered: list[dict] = []
_owner = ""


def remembered(memory: dict) -> dict:
    """``memory``, emptied in a worker whenever it goes over to another operator."""
    _remembered.append(memory)
    return memory


def enter(owner: str) -> None:
    """Forget what other operators than ``owner`` (a module) have left in this process."""
    global _owner
    if owner != _owner:
        for memory in _remembered:
            memory.clear()
        give_back()
        _owner = owner


def give_back() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def keep(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back."""
    path = folder(bounded(df.sparkSession), label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast when it was counted to hold at most ``rows`` rows.

    Give it only narrow tables of fixed-width columns, so that the row bound is a byte bound; a
    larger table stays unmarked and the join shuffles.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_key():
    """Hash of the text; null and the empty text are alike."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def training_row(column: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is not 2; a row without id is not used for training."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(column: str = "doc_id"):
    """The remainder is 2; a row without id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
