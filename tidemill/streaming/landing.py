"""Streams over a landing folder.

Each run with ``available_now`` takes up the files that came since the last one, remembered in the
checkpoint folder, and stops; without it the stream keeps polling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.sinks.buckets import upsert_buckets
from tidemill.sinks.versioned import upsert_table


def landing_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", files_per_batch: int | None = None, **options: Any
) -> DataFrame:
    """New files of a landing folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start(
    stream: DataFrame,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None],
    available_now: bool = True,
    interval: str = "60 seconds",
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def append_new_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything new to a Parquet folder, exactly once, and wait for the end."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_new_files(
    stream: DataFrame,
    table: str,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int | None = None,
) -> None:
    """Upsert everything new into a table by key, and wait for the end.

    Every batch becomes the table version named after checkpoint and batch, so a batch that runs
    again after a failure is recognised and leaves the same table. With ``buckets`` the table lies in hash buckets of
    its keys and a batch rewrites only those it has keys for (read it by ``read_buckets``); a batch that runs again
    leaves the same rows.
    """
    stream_name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        if buckets:
            upsert_buckets(rows, table, root, keys, buckets, order)
            return
        upsert_table(rows, table, root, keys, order, version=f"{stream_name}-{batch_id:09d}")

    start(stream, checkpoint, on_batch).awaitTermination()
    # Batches run in a session of their own; let this one see where the table points now.
    if stream.sparkSession.catalog.tableExists(table):
        stream.sparkSession.catalog.refreshTable(table)
