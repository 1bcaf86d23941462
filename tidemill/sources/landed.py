"""API responses that were landed as JSON files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.errors import FormatError
from tidemill.functions.dates import instant, parse_timestamp, timestamp_column, to_instant
from tidemill.operators.rows import SEQ, add_if_absent
from tidemill.sources.files import read_json_documents, read_json_lines, with_ingest_order
from tidemill.sources.pages import read_json_pages

ENVELOPES = ("customers", "orders", "products")


def read_envelope(
    spark: SparkSession, path: str | list[str], key: str, schema: str | None = None, lines: bool = False, split: bool = False
) -> DataFrame:
    """Rows of ``{key: [...]}`` documents, one document per response page.

    A file holds one page, or with ``lines`` one page per line, which Spark can split. ``_seq`` keeps
    the position: file, page, then place in the array. A document without the key fails the read, at
    planning time when no file has it and at run time otherwise. With ``split``, which needs a schema, one page
    of any size is read by many tasks (``read_json_pages``).
    """
    if split:
        if schema is None or lines:
            raise ValueError("a split read needs a schema, and a page a file")
        return read_json_pages(spark, path, schema, key)
    read = read_json_lines if lines else read_json_documents
    documents = read(spark, path, f"`{key}` array<struct<{schema}>>" if schema else None)
    if key not in documents.columns or not isinstance(documents.schema[key].dataType, T.ArrayType):
        raise FormatError(f"no array {key!r} in the response pages")
    lacking = F.raise_error(F.lit(f"no array {key!r} in a response page"))
    items = F.coalesce(F.col(key), lacking.cast(documents.schema[key].dataType))
    rows = with_ingest_order(documents, "_page").select("_page", F.posexplode(items).alias("_pos", "_row"))
    return rows.select("_row.*", F.struct("_page", "_pos").alias(SEQ))


def read_orders(spark: SparkSession, path: str, start_date: dt.date | str | None = None, **options) -> DataFrame:
    """Orders envelope, from ``start_date`` (a day) on when given."""
    return since(read_envelope(spark, path, "orders", **options), start_date)


def since(df: DataFrame, start_date: dt.date | str | None, column: str = "order_date") -> DataFrame:
    """Lower date bound; on Parquet and JDBC sources Catalyst moves it into the scan."""
    if start_date is None:
        return df
    bound = start_date if isinstance(start_date, str) else start_date.strftime("%Y-%m-%d")
    dtype = df.schema[column].dataType
    return df.filter(F.col(column) >= F.lit(bound).cast(dtype))


def time_range(
    df: DataFrame,
    column: str,
    as_of: dt.datetime | str | None = None,
    days: int = 1,
    limit: int | None = None,
    tie_breaker: str | None = None,
) -> DataFrame:
    """Rows within the last ``days`` days up to ``as_of`` (both ends included); with ``limit``, only the newest of them.

    The column may hold timestamps, epoch milliseconds or date texts. Bounds are brought to the type of numbers and
    timestamps, so that the comparison can be pushed to the source; texts are compared as points in time.
    """
    end = instant(as_of)
    start = end - F.make_dt_interval(F.lit(days))
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        low, high = F.unix_millis(to_instant(start)), F.unix_millis(to_instant(end))
    else:
        low, high = start, end
    moment = parse_timestamp(F.col(column)) if isinstance(dtype, T.StringType) else F.col(column)
    rows = df.filter(moment.between(low, high))
    if limit is None:
        return rows
    order = [moment.desc()] + ([F.desc(tie_breaker)] if tie_breaker else [])
    return rows.orderBy(*order).limit(limit)


def glucose_readings(df: DataFrame, as_of: dt.datetime | str | None = None, lookback_hours: int = 24) -> DataFrame:
    """Typed readings of the last hours from raw entries, with the range's bounds on every row.

    A reading in the range must have ``sgv``; ``device`` and ``type`` have defaults.
    """
    end = instant(as_of)
    start = end - F.make_dt_interval(F.lit(0), F.lit(lookback_hours))
    for name in ("device", "type", "direction", "noise", "filtered", "unfiltered", "rssi"):
        df = add_if_absent(df, name, F.lit(None).cast("string"))
    bad = F.raise_error(F.lit("a reading lacks sgv")).cast("boolean")
    moment = timestamp_column(df, "dateString")
    return (
        df.filter(moment.between(start, end))
        .filter(F.when(F.col("sgv").isNull(), bad).otherwise(True))
        .select(
            moment.alias("timestamp"),
            F.col("sgv").cast("double").alias("glucose"),
            F.coalesce("device", F.lit("unknown")).alias("device"),
            F.coalesce("type", F.lit("sgv")).alias("type"),
            F.col("direction").cast("string").alias("direction"),
            F.col("noise").cast("int").alias("noise"),
            F.col("filtered").cast("double").alias("filtered"),
            F.col("unfiltered").cast("double").alias("unfiltered"),
            F.col("rssi").cast("int").alias("rssi"),
        )
        .withColumns({"start_time": start, "end_time": end})
    )
