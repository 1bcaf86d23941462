"""The raw layer: five source-to-table loads without any transform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.sinks.tables import save_table
from tidemill.sources.files import read_csv
from tidemill.sources.landed import read_envelope

JSON_FEEDS = ("customers", "orders", "products")
CSV_FEEDS = ("store_locations", "inventory")
TEXT_COLUMNS = ("phone", "zip_code")


def read_raw(spark: SparkSession, landing: str) -> dict[str, DataFrame]:
    """The five raw feeds of a landing folder, each with its ingest order column."""
    feeds = {f"raw_{name}": read_envelope(spark, f"{landing}/{name}", name) for name in JSON_FEEDS}
    for name in CSV_FEEDS:
        path = f"{landing}/{name}.csv"
        feeds[f"raw_{name}"] = read_csv(spark, path, text_columns=TEXT_COLUMNS, ingest_order=True)
    return feeds


def load_raw(spark: SparkSession, landing: str, schema: str = "raw") -> None:
    for name, df in read_raw(spark, landing).items():
        save_table(df, f"{schema}.{name}")
