"""Catalog tables and views, database tables, and the plain SQL surface."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# How a target treats existing data, and Spark's word for it.
IF_EXISTS = {"replace": "overwrite", "append": "append", "fail": "errorifexists", "ignore": "ignore"}


def write_mode(if_exists: str) -> str:
    if if_exists not in IF_EXISTS:
        raise ValueError(f"if_exists must be one of {', '.join(IF_EXISTS)}")
    return IF_EXISTS[if_exists]


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills while it is written, so counting costs no extra pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def split_name(path: list[str] | str, default_schema: str = "default") -> tuple[str, str]:
    parts = path.split(".") if isinstance(path, str) else list(path)
    return (parts[-2] if len(parts) > 1 else default_schema), parts[-1]


def save_table(
    df: DataFrame, path: list[str] | str, if_exists: str = "replace", partition_by: list[str] | None = None
) -> int:
    """Write a Parquet table named by an asset path, creating its schema; returns the rows written."""
    mode = write_mode(if_exists)
    schema, table = split_name(path)
    df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    if mode == "ignore" and df.sparkSession.catalog.tableExists(f"`{schema}`.`{table}`"):
        return 0
    rows, seen = counted(df)
    writer = rows.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"`{schema}`.`{table}`")
    return seen.get["rows"]


def save_bucketed(df: DataFrame, path: list[str] | str, keys: list[str], buckets: int, if_exists: str = "replace") -> int:
    """Write a Parquet table in hash buckets of its keys, sorted within; returns the rows written.

    Upserts, keep-last and joins on the keys then read it without a shuffle of its rows. Rows are dealt out by the keys
    first, so a bucket is one file. A key that holds a large part of the rows makes one large bucket: bucket by ids.
    """
    mode = write_mode(if_exists)
    schema, table = split_name(path)
    df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    if mode == "ignore" and df.sparkSession.catalog.tableExists(f"`{schema}`.`{table}`"):
        return 0
    rows, seen = counted(df)
    dealt = rows.repartition(buckets, *keys)
    dealt.write.format("parquet").mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"`{schema}`.`{table}`")
    return seen.get["rows"]


def save_database(df: DataFrame, url: str, table: str, if_exists: str = "replace", **options: Any) -> int:
    """Write a database table over JDBC."""
    rows, seen = counted(df)
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode(write_mode(if_exists)).save()
    return seen.get["rows"]


def run_sql(spark: SparkSession, query: str, parameters: dict[str, Any] | None = None) -> DataFrame:
    """Any SQL over all tables and views, with named parameters."""
    return spark.sql(query, args=parameters) if parameters else spark.sql(query)


def create_table_from_query(spark: SparkSession, name: str, query: str, replace: bool = False) -> None:
    save_table(spark.sql(query), name, "replace" if replace else "ignore")


def create_view(spark: SparkSession, name: str, query: str, replace: bool = False) -> None:
    create = "CREATE OR REPLACE VIEW" if replace else "CREATE VIEW IF NOT EXISTS"
    spark.sql(f"{create} {name} AS {query}")


def materialize(spark: SparkSession, name: str, query: str, materialized: str = "view", full_refresh: bool = True):
    """Build a model as a view (the default) or a table."""
    if materialized == "view":
        create_view(spark, name, query, replace=True)
    elif materialized == "table":
        create_table_from_query(spark, name, query, replace=full_refresh)
    else:
        raise ValueError("materialized must be view or table")


def load_csv(
    spark: SparkSession,
    table: str,
    path: str,
    auto_detect: bool = True,
    delimiter: str = ",",
    header: bool = True,
    sample_ratio: float | None = None,
    replace: bool = False,
) -> None:
    """CSV to table. The type sample is a ratio of the rows, not a number of rows."""
    from tidemill.sources.files import read_csv

    df = read_csv(spark, path, infer=auto_detect, sample_ratio=sample_ratio, sep=delimiter, header=header)
    save_table(df, table, "replace" if replace else "ignore")


def export_query_to_csv(spark: SparkSession, query: str, path: str, parameters: dict[str, Any] | None = None) -> None:
    if parameters:
        raise NotImplementedError("an export takes no parameters: put them into a view first")
    from tidemill.sinks.files import save_csv

    save_csv(spark.sql(query), path)
