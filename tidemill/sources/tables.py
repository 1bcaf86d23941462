"""Catalog and database tables, and the choice of a source by kind."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemill.errors import ConfigError
from tidemill.sources import files, landed


def read_table(spark: SparkSession, path: list[str] | str, default_schema: str = "default") -> DataFrame:
    """A whole table named by the last two parts of an asset path."""
    parts = path.split(".") if isinstance(path, str) else path
    schema = parts[-2] if len(parts) > 1 else default_schema
    return spark.table(f"`{schema}`.`{parts[-1]}`")


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int = 1,
    **options: Any,
) -> DataFrame:
    """A database table over JDBC; give a partition column and its bounds to read it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


SOURCE_KINDS = {"csv": "file", "json": "file", "parquet": "file", "postgres": "table", "api": "endpoint"}


def read_source(spark: SparkSession, kind: str, **config: Any) -> DataFrame:
    """Read by kind: csv, json and parquet need ``file``; postgres ``table``; api ``endpoint``.

    ``api`` reads the landed responses of the endpoint from ``<landing>/<endpoint>``. ``postgres``
    reads over JDBC when ``url`` is given, else the table of that name in the catalog. JSON files hold
    one document each, or with ``lines=True`` one record per line.
    """
    if kind not in SOURCE_KINDS:
        raise ConfigError(f"unknown source kind {kind!r}, expected one of {', '.join(SOURCE_KINDS)}")
    needed = SOURCE_KINDS[kind]
    target = config.pop(needed, None)
    if not target:
        raise ConfigError(f"a {kind} source needs {needed}")
    if kind == "csv":
        return files.read_csv(spark, target, **config)
    if kind == "json":
        read = files.read_json_lines if config.pop("lines", False) else files.read_json_documents
        return read(spark, target, **config)
    if kind == "parquet":
        return files.read_parquet(spark, target, **config)
    if kind == "api":
        path = f"{config.pop('landing', '.').rstrip('/')}/{target}"
        if target in landed.ENVELOPES:
            return landed.read_envelope(spark, path, target, **config)
        return files.read_json_documents(spark, path, **config)
    url = config.pop("url", None)
    return read_database(spark, url, target, **config) if url else read_table(spark, target)
