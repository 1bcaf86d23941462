"""Upserts that rewrite only the hash buckets of a batch's keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.errors import ConfigError
from tidemill.operators.upsert import newest, upsert
from tidemill.sinks.layers import discard, store
from tidemill.sinks.versioned import dynamic_overwrite, in_partitions, kept

BUCKET = "_bucket"
_COUNT = "tidemill.buckets"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's keys; rows without keys share one."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _create(batch: DataFrame, table: str, root: str, buckets: int) -> None:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
    batch.sparkSession.sql(
        f"CREATE TABLE {table} ({fields}) USING parquet PARTITIONED BY (`{BUCKET}`) LOCATION '{root}' TBLPROPERTIES ('{_COUNT}' = '{buckets}')"
    )


def upsert_buckets(batch: DataFrame, table: str, root: str, keys: Sequence[str], buckets: int, order: Sequence[str] | None = None) -> int:
    """Upsert a batch by key into a table of hash buckets, which the first batch creates; returns the rows put in.

    Only the buckets that the batch has keys for are read and written, by one dynamic partition overwrite, so the bytes
    written follow the batch. A key never moves to another bucket. The same batch put in again leaves the same
    rows, so a batch that failed halfway is repaired by running it again. The number of buckets is kept with the table;
    another one is an error. Choose it so that a bucket is a few hundred MB.
    """
    spark = batch.sparkSession
    incoming = newest(batch, keys, order).withColumn(BUCKET, bucket_of(keys, buckets))
    if not spark.catalog.tableExists(table):
        _create(incoming, table, root, buckets)
    known = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == _COUNT).first()
    if known is None or int(known["value"]) != buckets:
        raise ConfigError(f"{table} has {known['value'] if known else 'no'} buckets, not {buckets}")
    stored, seen = spark.table(table), Observation()
    with kept(incoming) as rows:
        touched = store(rows.select(BUCKET).distinct(), "touched")
        changed = upsert(in_partitions(stored, touched, BUCKET), rows, keys, order=(), seen=seen)
        changed = store(changed.select(*stored.columns), "upsert")
    put_in = seen.get["rows"]
    with dynamic_overwrite(spark):
        changed.repartition(BUCKET).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
    discard(touched, changed)
    return put_in


def read_buckets(spark: SparkSession, table: str) -> DataFrame:
    """The rows of such a table."""
    return spark.table(table).drop(BUCKET)
