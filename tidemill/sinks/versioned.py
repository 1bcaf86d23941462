"""Upserts into Parquet tables: write a new version folder, then point the table at it.

Readers see the old version until the switch, and a lost executor or a failed job leaves it as it
was. Old version folders are kept until the owner removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.rows import SEQ
from tidemill.operators.upsert import newest, single, upsert, upsert_columns
from tidemill.sinks.layers import store
from tidemill.sinks.tables import counted


def remove_versions(spark: SparkSession, table: str, root: str, keep: int = 1) -> int:
    """Delete the version folders under ``root`` that the table does not point at, but for the newest ``keep`` of them.

    Call it when no reader needs the old versions; returns how many were removed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    live = table_location(spark, table).rsplit("/", 1)[-1]
    old = [f for f in system.listStatus(path) if f.isDirectory() and f.getPath().getName() != live]
    old.sort(key=lambda f: f.getModificationTime(), reverse=True)
    return sum(bool(system.delete(f.getPath(), True)) for f in old[keep:])


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a batch that is read several times, in memory or on disk, until the load is done."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").select("data_type")
    return rows.first()[0].rstrip("/")


def publish(df: DataFrame, table: str, root: str, version: str | None = None) -> int:
    """Write ``df`` as a new version under ``root`` and switch ``table`` to it."""
    location = f"{root.rstrip('/')}/{version or uuid.uuid4().hex}"
    rows, seen = counted(df)
    rows.write.mode("overwrite").parquet(location)
    _switch(df, table, location)
    return seen.get["rows"]


def _switch(df: DataFrame, table: str, location: str) -> None:
    """Point a table at a folder with the columns of ``df``."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and spark.table(table).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def upsert_table(
    batch: DataFrame,
    table: str,
    root: str,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    version: str | None = None,
) -> int:
    """Upsert a batch by key into a table, which the first batch creates; returns the rows put in.

    With a ``version`` name a repeated call for a version that is already live changes nothing.
    The batch is computed once, straight into the new version; its keys are read back from there.
    """
    spark = batch.sparkSession
    old = spark.table(table) if spark.catalog.tableExists(table) else None
    if old is not None and version and table_location(spark, table).endswith(f"/{version}"):
        return 0
    unordered = order is None and SEQ not in batch.columns
    incoming = batch if unordered else newest(batch, keys, order)
    if old is not None:
        incoming = old.filter(F.lit(False)).unionByName(incoming, allowMissingColumns=True).select(*old.columns)
    location = f"{root.rstrip('/')}/{version or uuid.uuid4().hex}"
    rows, seen = counted(incoming)
    rows.write.mode("overwrite").parquet(location)
    stored = spark.read.schema(incoming.schema).parquet(location).select(*keys)
    if unordered:
        single(stored, keys)
    if old is not None:
        others = old.join(stored, list(keys), "left_anti").unionByName(incoming.filter(F.lit(False)))
        others.select(*old.columns).write.mode("append").parquet(location)
    _switch(incoming, table, location)
    return seen.get["rows"]


def upsert_table_columns(
    batch: DataFrame,
    table: str,
    root: str,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[str] | None = None,
) -> None:
    """Partial upsert by key: a clash changes only the ``update`` columns. ``order`` says which row of a key is last."""
    spark = batch.sparkSession
    if spark.catalog.tableExists(table):
        publish(upsert_columns(spark.table(table), batch, keys, update, order), table, root)
    else:
        publish(newest(batch, keys, order), table, root)


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts replace only the partitions that they have rows for. Tables take this from the session alone."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _homes(stored: DataFrame, batch: DataFrame, keys: Sequence[str], partition: str, stable: bool) -> DataFrame:
    """Partitions that a batch changes: those of its rows, and those where its keys are stored now."""
    values = batch.select(partition)
    if not stable:
        values = values.unionByName(stored.select(*keys, partition).join(batch.select(*keys), list(keys), "left_semi").select(partition))
    return values.distinct()


def in_partitions(stored: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """Stored rows of the touched partitions; other partitions are pruned while the query runs."""
    is_null, one = F.col(partition).isNull(), F.lit(1).alias("_one")
    named = stored.join(touched.filter(~is_null), partition, "left_semi")
    unnamed = stored.filter(is_null).select("*", one).join(touched.filter(is_null).select(one), "_one", "left_semi")
    return named.select(*stored.columns).unionByName(unnamed.select(*stored.columns))


def _partition_spec(partition: str, value: str | None) -> str:
    text = "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"PARTITION (`{partition}` = {text})"


def upsert_partitions(
    batch: DataFrame,
    table: str,
    root: str,
    keys: Sequence[str],
    partition: str,
    order: Sequence[str] | None = None,
    stable: bool = False,
) -> int:
    """Upsert into a table that is partitioned by one column, rewriting only the partitions concerned.

    The new rows of those partitions are stored first and then put in by one dynamic partition overwrite,
    with Spark's own commit. Partition values may be null or hold any character. Partitions that the batch
    leaves empty are dropped after it; only their values reach the driver. The other partitions are looked at
    for their keys alone, to find rows that move; ``stable`` says that a key never moves and skips that.
    """
    spark = batch.sparkSession
    incoming = newest(batch, keys, order)
    incoming = incoming.select(*[c for c in incoming.columns if c != partition], partition)
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in incoming.schema)
        spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{root}'")
    stored = spark.table(table)
    seen = Observation()
    with kept(incoming) as rows:
        touched = store(_homes(stored, rows, keys, partition, stable), "touched")
        changed = upsert(in_partitions(stored, touched, partition), rows, keys, order=(), seen=seen)
        changed = store(changed.select(*stored.columns), "upsert")
    counted_rows = seen.get["rows"]
    with dynamic_overwrite(spark):
        changed.write.mode("overwrite").insertInto(table)
    left = changed.select(F.col(partition).alias("_left")).distinct()
    emptied = touched.join(left, F.col(partition).eqNullSafe(F.col("_left")), "left_anti")
    known = spark.table(table).select(F.col(partition).alias("_known")).distinct()
    emptied = emptied.join(known, F.col(partition).eqNullSafe(F.col("_known")), "left_semi")
    for (value,) in emptied.select(F.col(partition).cast("string")).collect():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_partition_spec(partition, value)}")
    spark.catalog.refreshTable(table)
    return counted_rows
