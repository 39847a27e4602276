"""Token counts of whole texts, returning lengths only.

Every Arrow batch is worked on in slices balanced by bytes, long texts in pieces cut at places that no
token can cross; new segments of a slice are encoded in batches of bounded bytes. Nothing is shuffled,
and no task holds more than its Arrow batch, one slice and the memo of `tokens`.

Nulls in the text count as the empty text (0 bytes, 0 tokens); nulls elsewhere are carried through.
Repeated rows stay. An empty table gives no rows. Columns of the input called like the results are
replaced by them; others are kept only when named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from stratalake.llm import store
from stratalake.llm.tokens import PieceCounts

_models: dict[str, PieceCounts] = store.remembered({})


def token_counts(docs: DataFrame, model_path: str, limit: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``)."""
    made = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    kept = [c for c in keep if c not in {f.name for f in made}]
    fields = [docs.schema[c] for c in kept]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        if model_path not in _models:
            _models[model_path] = PieceCounts(model_path)
        for batch in batches:
            column = batch.column(len(kept))
            n = pa.array(_models[model_path].count(column))
            size = pc.fill_null(pc.cast(pc.binary_length(column), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], size, n, pc.greater(n, limit)], [*kept, "n_bytes", "n_tokens", "over_limit"]
            )

    return docs.select(*kept, docs[text].alias("__text")).mapInArrow(store.tidy(count), StructType([*fields, *made]))
