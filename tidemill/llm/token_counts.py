"""Token counts: texts are encoded in batches inside an Arrow function that returns lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.tokens import encode

BATCH_BYTES = 1 << 20


def balanced(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[list[str | None]]:
    """Runs of texts of at most ``limit`` bytes together; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    first = held = 0
    for i, size in enumerate(sizes):
        if i > first and held + size > limit:
            yield texts.slice(first, i - first).to_pylist()
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield texts.slice(first).to_pylist()


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to each row.

    Counts are those of the library of the vocabulary file at ``path`` (``.json``: tokenizers, ``.model``:
    sentencepiece), without added tokens, truncation or padding. No shuffle; a row's result depends on its
    text alone. A null or empty text has 0 bytes and 0 tokens; repeated rows stay; an empty table gives an
    empty one. Columns that have the new names are replaced; all others stay, whatever they are called.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    schema = T.StructType([*docs.schema, T.StructField("n_tokens", T.LongType())])

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for texts in balanced(batch.column(text)):
                counts += [sum(map(len, parts)) for parts in encode(texts, path)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64())], names=[*batch.schema.names, "n_tokens"]
            )

    return (
        docs.mapInArrow(lengths, schema)
        .withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long")))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
