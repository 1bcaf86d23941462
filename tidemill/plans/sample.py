"""The small raw -> staging -> warehouse example and the two example models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.dates import parse_timestamp_strict
from tidemill.operators.rows import where_equals

# The example's literal rows.
SAMPLE_ROWS = [
    (1, "Item 1", 10.5, "A", "2023-01-01"),
    (2, "Item 2", 20.3, "B", "2023-01-02"),
    (3, "Item 3", 30.1, "A", "2023-01-03"),
    (4, "Item 4", 40.9, "C", "2023-01-04"),
    (5, "Item 5", 50.7, "B", "2023-01-05"),
]


def sample_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SAMPLE_ROWS, "id int, name string, value double, category string, date string")


def staging(raw: DataFrame) -> DataFrame:
    """Dates parsed (a bad one fails the job), upper-case category, text of value and category."""
    return raw.withColumns({"date": parse_timestamp_strict(F.col("date")), "category": F.upper("category")}).withColumn(
        "value_category", F.concat(F.col("value").cast("string"), F.lit("-"), F.col("category"))
    )


def warehouse(staged: DataFrame) -> DataFrame:
    """Per category: row count, value statistics and date range."""
    return (
        staged.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.count("id").alias("count"),
            F.avg("value").alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.min("date").alias("earliest_date"),
            F.max("date").alias("latest_date"),
        )
    )


def first_model(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT 1 AS id UNION ALL SELECT CAST(NULL AS INT) AS id")


def second_model(first: DataFrame) -> DataFrame:
    return where_equals(first, "id", 1)
