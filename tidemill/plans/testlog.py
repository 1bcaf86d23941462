"""Test results: flatten run reports, keep their history, report failures."""

from __future__ import annotations

import logging
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.dates import parse_timestamp
from tidemill.functions.jsons import parse_records
from tidemill.functions.text import dotted_part
from tidemill.operators.upsert import upsert_columns
from tidemill.sinks.versioned import upsert_table_columns
from tidemill.sources.files import read_json_documents

log = logging.getLogger(__name__)

REPORT = (
    "metadata struct<invocation_id:string, generated_at:string>, results array<struct<unique_id:string, "
    "status:string, column_name:string, adapter_response:struct<test_type:string>, "
    "timing:array<struct<elapsed:double>>, message:string, failures:int>>"
)
LOG_TABLE = "monitoring.dbt_test_results"
# The columns that a newer result of the same test replaces, and what counts as failed.
UPDATED = ["status", "execution_time", "failure_details", "rows_affected", "run_timestamp"]
FAILED = ["fail", "error"]


def read_reports(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Run reports, one JSON document per file; unreadable or missing files give no rows."""
    try:
        return read_json_documents(spark, path, REPORT)
    except FileNotFoundError:
        log.error("Results file not found: %s", path)
        return spark.createDataFrame([], REPORT)


def flatten(reports: DataFrame) -> DataFrame:
    """One row per test result: tests, and anything that ended in an error."""
    rows = reports.select("metadata", F.explode("results").alias("r"))
    test_id = F.coalesce("r.unique_id", F.lit(""))
    wanted = (F.col("r.status") == "error") | test_id.startswith("test.")
    return rows.filter(wanted).select(
        F.col("r.unique_id").alias("result_id"),
        F.col("metadata.invocation_id").alias("invocation_id"),
        F.col("r.unique_id").alias("test_unique_id"),
        dotted_part(test_id, 2).alias("test_name"),
        F.col("r.adapter_response.test_type").alias("test_type"),
        dotted_part(test_id, 3, more_than=3).alias("model_name"),
        F.col("r.column_name").alias("column_name"),
        F.col("r.status").alias("status"),
        F.get("r.timing", F.lit(0))["elapsed"].alias("execution_time"),
        F.col("r.message").alias("failure_details"),
        F.col("r.failures").alias("rows_affected"),
        parse_timestamp(F.col("metadata.generated_at")).alias("run_timestamp"),
    )


def flatten_text(df: DataFrame, raw: str = "raw") -> DataFrame:
    """``flatten`` for reports in a JSON text column."""
    return flatten(parse_records(df, raw, REPORT))


def merge_results(history: DataFrame, results: DataFrame) -> DataFrame:
    """The history with newer outcomes of known tests, and new tests added."""
    return upsert_columns(history, results, ["result_id"], UPDATED, ["run_timestamp"])


def log_results(results: DataFrame, root: str, table: str = LOG_TABLE) -> None:
    """Write results to the history table."""
    results.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {table.split('.')[0]}")
    upsert_table_columns(results, table, root, ["result_id"], UPDATED, ["run_timestamp"])


def failures(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status").isin(FAILED))


def failure_count(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("status").isin(FAILED)).alias("failed"))


def report(results: DataFrame) -> int:
    """Log how many tests failed, and return it."""
    failed = failure_count(results).first()["failed"]
    if failed:
        log.critical("%d tests failed or errored, see %s", failed, LOG_TABLE)
    else:
        log.info("All tests passed or were skipped.")
    return failed


def latest(results: DataFrame, status: Any, limit: int) -> DataFrame:
    """The most recent results, optionally of one status."""
    chosen = results if status in (None, "all") else results.filter(F.col("status") == status)
    return chosen.orderBy(F.desc("run_timestamp"), "result_id").limit(limit)
