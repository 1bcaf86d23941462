"""High-water-mark scans."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sinks.versioned import upsert_table


def new_rows(df: DataFrame, last: Any = None, column: str = "id") -> DataFrame:
    """All rows at first, later only those strictly above the mark (pushed to Parquet and JDBC)."""
    return df if last is None else df.filter(F.col(column) > F.lit(last))


def next_mark(df: DataFrame, last: Any = None, column: str = "id") -> DataFrame:
    """One row with the new mark: the maximum over all rows, or the old mark of an empty table."""
    old = F.lit(last).cast(df.schema[column].dataType)
    return df.agg(F.coalesce(F.max(column), old).alias("state"))


def read_mark(df: DataFrame, last: Any = None, column: str = "id") -> Any:
    """The new mark as a value, for the caller to keep."""
    return next_mark(df, last, column).first()["state"]


def stored_mark(spark: SparkSession, table: str, source: str) -> Any:
    """The mark that the last finished load of a source left in the state table, or None."""
    if not spark.catalog.tableExists(table):
        return None
    row = spark.table(table).filter(F.col("source") == source).first()
    return json.loads(row["mark"]) if row else None


def load_new_rows(df: DataFrame, source: str, load: Callable[[DataFrame], Any], table: str, root: str, column: str = "id") -> Any:
    """Load the rows above the stored mark of a source; returns the mark after it.

    The mark advances only when ``load`` has come back: rows of a failed load are read again by the next call, those of
    a finished one are not. The new mark is taken first and bounds the rows, so that rows that arrive meanwhile wait
    for the next call. Marks are whole numbers or texts and are kept as JSON, one row per source. ``load`` should be an
    upsert, because a stop between load and mark makes the next call load the same rows.
    """
    spark = df.sparkSession
    last = stored_mark(spark, table, source)
    rows = new_rows(df, last, column)
    mark = rows.agg(F.max(column)).first()[0]
    if mark is None:
        return last
    load(rows.filter(F.col(column) <= F.lit(mark)))
    upsert_table(spark.createDataFrame([(source, json.dumps(mark))], "source string, mark string"), table, root, ["source"])
    return mark
