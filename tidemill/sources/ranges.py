"""Scans of a value range that open only the files whose recorded range meets it."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.errors import ConfigError


def file_ranges(df: DataFrame, column: str) -> DataFrame:
    """An index row per file of a file scan: ``file``, ``low``, ``high`` (of ``column``, null if it has no value) and ``n_rows``.

    Keep it as a table beside the data, and add the rows of new files as they land.
    """
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count(F.lit(1)).alias("n_rows")
    )


def files_within(ranges: DataFrame, low: Any = None, high: Any = None) -> list[str]:
    """The files that may hold a value from ``low`` to ``high`` (both included; null: open). Only their names reach the driver."""
    kind = ranges.schema["low"].dataType
    chosen = ranges.filter(F.col("low").isNotNull())
    if low is not None:
        chosen = chosen.filter(F.col("high") >= F.lit(low).cast(kind))
    if high is not None:
        chosen = chosen.filter(F.col("low") <= F.lit(high).cast(kind))
    return sorted(r["file"] for r in chosen.select("file").collect())


def range_scan(spark: SparkSession, ranges: DataFrame, column: str, schema: str, low: Any = None, high: Any = None) -> DataFrame:
    """Rows with ``column`` from ``low`` to ``high``, from the matching Parquet files alone; the filter goes down to row groups."""
    if low is None and high is None:
        raise ConfigError("give a bound, or read the folder")
    paths = files_within(ranges, low, high)
    if not paths:
        return spark.createDataFrame([], schema)
    rows, kind = spark.read.schema(schema).parquet(*paths), ranges.schema["low"].dataType
    if low is not None:
        rows = rows.filter(F.col(column) >= F.lit(low).cast(kind))
    return rows if high is None else rows.filter(F.col(column) <= F.lit(high).cast(kind))
