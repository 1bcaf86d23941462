"""The dataset registry and partition statistics."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.dates import instant
from tidemill.operators.joins import orphans
from tidemill.operators.upsert import upsert_columns
from tidemill.sinks.versioned import publish, upsert_table

REGISTRY = "warehouse.dataset_registry"
DATASETS = "warehouse.datasets"
PARTITIONS = "warehouse.partitions"
# What changes when a dataset is registered again.
UPDATED = ["description", "updated_at", "source_type", "location", "schema_json", "row_count", "metadata_json"]


def registry_row(
    df: DataFrame,
    name: str,
    location: str,
    source_type: str = "parquet",
    description: str | None = None,
    metadata: dict[str, Any] | None = None,
    as_of: Any = None,
) -> DataFrame:
    """One row that describes a dataset; the id is a hash of the unique name."""
    now = instant(as_of)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.xxhash64(F.lit(name)).alias("id"),
        F.lit(name).alias("name"),
        F.lit(description).cast("string").alias("description"),
        now.alias("created_at"),
        now.alias("updated_at"),
        F.lit(source_type).alias("source_type"),
        F.lit(location).alias("location"),
        F.lit(df.schema.json()).alias("schema_json"),
        "row_count",
        F.lit(json.dumps(metadata or {}, sort_keys=True)).alias("metadata_json"),
    )


def register(row: DataFrame, root: str) -> None:
    """Add or update a dataset in the registry table, and (re)build the view with parsed JSON."""
    spark = row.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {REGISTRY.split('.')[0]}")
    if spark.catalog.tableExists(REGISTRY):
        row = upsert_columns(spark.table(REGISTRY), row, ["id"], UPDATED)
    publish(row, REGISTRY, root)
    create_datasets_view(spark)


def create_datasets_view(spark: SparkSession) -> None:
    spark.sql(
        f"CREATE OR REPLACE VIEW {DATASETS} AS SELECT id, name, description, created_at, updated_at, source_type, "
        f"location, try_parse_json(schema_json) AS schema, row_count, try_parse_json(metadata_json) AS metadata "
        f"FROM {REGISTRY}"
    )


def _folder_of(key: Column) -> Column:
    """A partition value as Spark names its folder."""
    for character in "%\"#'*/:=?\\\x7f{[]^":
        key = F.replace(key, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return F.when((key == "") | key.isNull(), "__HIVE_DEFAULT_PARTITION__").otherwise(key)


def partition_stats(
    df: DataFrame, dataset: str, partition: str, value: str, location: str, storage_type: str = "parquet"
) -> DataFrame:
    """Per partition of a dataset: range of a value column, row count and location."""
    key = F.col(partition).cast("string")
    return (
        df.groupBy(key.alias("partition_key"))
        .agg(
            F.min(value).cast("string").alias("min_value"),
            F.max(value).cast("string").alias("max_value"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .select(
            F.lit(dataset).alias("dataset"),
            "partition_key",
            "min_value",
            "max_value",
            "row_count",
            F.concat(F.lit(f"{location}/{partition}="), _folder_of(F.col("partition_key"))).alias("storage_location"),
            F.lit(storage_type).alias("storage_type"),
        )
    )


def partition_rows(stats: DataFrame, as_of: Any = None, metadata: Mapping[str, Any] | None = None) -> DataFrame:
    """Statistics as rows of the partition table: with an id made of dataset and key, the time, and ``metadata`` as JSON."""
    number = F.xxhash64("dataset", F.coalesce("partition_key", F.lit("")), F.col("partition_key").isNull())
    return stats.select(
        number.alias("id"), "*", instant(as_of).alias("created_at"),
        F.lit(json.dumps(metadata) if metadata is not None else None).cast("string").alias("metadata"),
    )


def record_partitions(stats: DataFrame, root: str, as_of: Any = None, metadata: Mapping[str, Any] | None = None) -> int:
    """Add or update the statistics of partitions in their table; returns how many."""
    stats = partition_rows(stats, as_of, metadata)
    stats.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {PARTITIONS.split('.')[0]}")
    return upsert_table(stats, PARTITIONS, root, ["dataset", "partition_key"])


def unregistered_partitions(spark: SparkSession) -> DataFrame:
    """Partition rows whose dataset is not in the registry."""
    return orphans(spark.table(PARTITIONS), "dataset", spark.table(REGISTRY), "name")
