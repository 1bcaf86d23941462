"""CSV, Parquet, JSON and text files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.errors import FormatError
from tidemill.functions.numbers import looks_numeric
from tidemill.operators.rows import SEQ

# Texts that a CSV reader takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _load(reader, fmt: str, path: str | list[str]) -> DataFrame:
    try:
        return reader.format(fmt).load(path)
    except (PySparkException, Py4JJavaError) as error:
        if isinstance(error, PySparkException) and error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"File not found: {path}") from error
        raise FormatError(f"Failed to read {fmt} file: {error}") from error


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    infer: bool = True,
    sample_ratio: float | None = None,
    text_columns: Sequence[str] = (),
    null_tokens: Sequence[str] = NULL_TOKENS,
    schema: str | None = None,
    ingest_order: bool = False,
    multiline: bool = True,
    misfits: str = "fail",
    **options: Any,
) -> DataFrame:
    """CSV with a header row; extra options go to Spark's reader.

    Quoted text may hold line ends. ``multiline=False`` reads big files in splits instead; a record that is cut by a
    line end, or has another number of fields, then fails the job. A text that does not fit its column's type (from
    ``schema`` or a sample) fails the job as well; with ``misfits="null"`` it becomes null.

    All fields are read as text, missing-value tokens become null, and then types are settled by
    one aggregate over the file (or a sample). Columns in ``text_columns``, such as phone numbers
    and zip codes, stay text; so does any column with a number that starts with a zero. With
    ``schema`` no file is read to plan the query. ``ingest_order`` adds the file position (``_seq``).
    """
    if misfits not in ("fail", "null"):
        raise ValueError("misfits must be fail or null")
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multiline)
    reader = reader.options(**({} if multiline else {"mode": "FAILFAST"})).options(**options)
    if schema is not None:
        fields = T.StructType.fromDDL(schema)
        types = {f.name: f.dataType for f in fields}
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in types]))
    raw = _load(reader, "csv", path)
    order = [SEQ] if ingest_order else []
    if ingest_order:
        raw = with_ingest_order(raw)
    names = [c for c in raw.columns if c not in order]
    cleaned = raw.select(*[F.when(~F.col(c).isin(list(null_tokens)), F.col(c)).alias(c) for c in names], *order)
    if schema is None:
        if not infer:
            return cleaned
        sample = cleaned.select(*names) if sample_ratio is None else cleaned.select(*names).sample(sample_ratio, seed=1)
        types = infer_types(sample, text_columns)
    return cleaned.select(*[_typed(c, types[c], misfits).alias(c) for c in names], *order)


def _typed(name: str, dtype: Any, misfits: str) -> Column:
    text = F.col(name)
    value = text.try_cast(dtype)
    if dtype in ("double", "float") or isinstance(dtype, (T.DoubleType, T.FloatType)):
        value = F.when(looks_numeric(text), value)  # a cast alone takes "12d"
    if misfits == "null" or dtype == "string" or isinstance(dtype, T.StringType):
        return value
    bad = F.raise_error(F.concat(F.lit(f"column {name} does not hold: "), text))
    return F.when(text.isNotNull() & value.isNull(), bad).otherwise(value)


def infer_types(df: DataFrame, text_columns: Sequence[str] = ()) -> dict[str, str]:
    """The narrowest of bigint, double, boolean and string for every text column, in one pass."""
    candidates = [c for c in df.columns if c not in text_columns]
    types = {c: "string" for c in df.columns}
    if not candidates:
        return types
    tests: list[Column] = []
    for i, c in enumerate(candidates):
        text = F.col(c)
        fits = {
            "i": text.rlike(r"^\s*[+-]?(0|[1-9]\d*)\s*$") & text.try_cast("bigint").isNotNull(),
            "d": looks_numeric(text) & ~text.rlike(r"^\s*[+-]?0\d"),
            "b": F.lower(text).isin("true", "false"),
        }
        tests += [F.every(F.when(text.isNotNull(), test)).alias(f"{flag}{i}") for flag, test in fits.items()]
    seen = df.agg(*tests).first()
    for i, c in enumerate(candidates):
        for flag, dtype in (("i", "bigint"), ("d", "double"), ("b", "boolean")):
            if seen[f"{flag}{i}"]:
                types[c] = dtype
                break
    return types


def read_parquet(spark: SparkSession, path: str | list[str], **options: Any) -> DataFrame:
    return _load(spark.read.options(**options), "parquet", path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in column ``value``, without the line end."""
    return _load(spark.read, "text", path)


def read_json_documents(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """Files that hold one JSON value each: an object is one row, an array of objects one row per element."""
    reader = spark.read.option("multiLine", True)
    schema = schema or infer_documents(spark, path)
    return _load(reader.schema(schema) if schema else reader, "json", path)


def infer_documents(spark: SparkSession, path: str | list[str]) -> T.StructType | None:
    """The schema of all files that hold one JSON value each, by Spark's own rules; None without any field.

    Spark's multi-line reader would look for it in tasks of 128 MB, however many small files that is. The text
    reader counts what it costs to open a file, so many files are many tasks.
    """
    files = _load(spark.read.option("wholetext", True), "text", path).select(F.col("value").cast("binary"))
    texts = files.rdd.map(lambda file: file[0].decode(json.detect_encoding(file[0]), "replace"))
    schema = spark.read.json(texts).schema
    return schema if schema.fields else None


def read_json_lines(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    return _load(spark.read.schema(schema) if schema else spark.read, "json", path)


def select_files(
    spark: SparkSession,
    root: str,
    fmt: str,
    pattern: str | None = None,
    extension: str | None = None,
    prefix: str | None = None,
    recursive: bool = False,
    schema: str | None = None,
    **options: Any,
) -> DataFrame:
    """Read the files under ``root`` that match a glob, an extension (any case) or a key prefix."""
    reader = spark.read.options(**options)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if pattern and extension:
        raise ValueError("give a pattern or an extension, not both")
    if extension:
        letters = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension.lstrip("."))
        pattern = f"*.{letters}"
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if schema:
        reader = reader.schema(schema)
    return _load(reader, fmt, f"{root.rstrip('/')}/{prefix}*" if prefix else root)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that Spark cannot split over all cores, such as one file with one row group, without regard to keys.

    A scan with at least as many partitions as the session's parallelism is returned as it is, so
    big inputs are never shuffled for this.
    """
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= parallelism:
        return df
    return df.repartition(parallelism)


def with_ingest_order(df: DataFrame, name: str = SEQ) -> DataFrame:
    """Add a sortable ingest position: file time, file, block, then row within the block.

    Use it right on a file reader. A row's position within its block does not depend on how blocks
    are packed into tasks, so the order of two rows of one file is always that of the file.
    """
    meta = F.col("_metadata")
    return df.withColumn(
        name,
        F.struct(
            meta["file_modification_time"].alias("time"),
            meta["file_path"].alias("path"),
            meta["file_block_start"].alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )
