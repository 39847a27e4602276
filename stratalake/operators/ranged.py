"""Rows that look at the next row of their key, in tasks that do not follow keys.

Rows are dealt by ranges of (key, order), so a key with most of all rows lies in many tasks and none is larger than
the others. Each task passes its rows on in order and gives every one the value of the next row of its key; only the
first row of each task, one row per task, goes through the driver to the task before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_TASK, _KEY = "_task", "_key"


def _same_key(keys: Sequence[str]) -> Column:
    """One text per key; NULL differs from every value and equals itself."""
    return F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})


def with_next(rows: DataFrame, keys: Sequence[str], order: str, name: str, path: str, tasks: int | None = None) -> DataFrame:
    """``rows`` with ``name``: the value of ``order`` in the next row of the same key, NULL for the last one.

    ``path`` is a fresh folder that all executors can reach; the ranged rows are stored there, so that a task that
    is run again meets the same borders. ``order`` holds no NULL and is distinct per key.
    """
    by = [F.col(c).asc_nulls_first() for c in (*keys, order)]
    ranged = rows.repartitionByRange(tasks, *by) if tasks else rows.repartitionByRange(*by)
    ranged.withColumns({_TASK: F.spark_partition_id(), _KEY: _same_key(keys)}).write.parquet(path)
    stored = rows.sparkSession.read.parquet(path)

    first = F.min_by(F.struct(_KEY, F.col(order).alias("_next")), F.struct(*[F.col(c) for c in (*keys, order)]))
    heads = stored.groupBy(_TASK).agg(first.alias("head")).select(_TASK, "head.*").orderBy(_TASK).toArrow()  # one row per task
    following = dict(zip(heads.column(_TASK).to_pylist(), range(1, heads.num_rows)))
    columns = [*rows.columns, _TASK, _KEY]
    schema = StructType([*rows.schema.fields, StructField(name, rows.schema[order].dataType)])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def across(task: int, key: str, kind: pa.DataType) -> pa.Array:
            """What follows the last row of a task: the first row of the next one, if it has the key."""
            at = following.get(task)
            same = at is not None and heads.column(_KEY)[at].as_py() == key
            return pa.array([heads.column("_next")[at].as_py() if same else None], kind)

        def emit(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
            """All rows but the last one with their next values, or the last one too."""
            task, key = (batch.column(c).to_pylist() for c in (_TASK, _KEY))
            value, parts, begun = batch.column(order), [], 0
            for i in range(batch.num_rows - 1):
                if task[i] != task[i + 1] or key[i] != key[i + 1]:
                    end = across(task[i], key[i], value.type) if task[i] != task[i + 1] else pa.nulls(1, value.type)
                    parts += [value.slice(begun + 1, i - begun), end]
                    begun = i + 1
            parts.append(value.slice(begun + 1))
            if last:
                parts.append(across(task[-1], key[-1], value.type))
            rows_out = batch.slice(0, batch.num_rows - (not last))
            return pa.RecordBatch.from_arrays([*rows_out.columns[: len(columns) - 2], pa.concat_arrays(parts)], schema.names)

        held = None  # the last row waits for the one behind it
        for batch in batches:
            if batch.num_rows:
                joined = batch if held is None else pa.concat_batches([held, batch])
                yield emit(joined, False)
                held = joined.slice(joined.num_rows - 1)
        if held is not None:
            yield emit(held, True)

    dealt = stored.repartition(tasks, _TASK) if tasks else stored.repartition(_TASK)
    return dealt.select(*columns).sortWithinPartitions(_TASK, *by).mapInArrow(close, schema)
