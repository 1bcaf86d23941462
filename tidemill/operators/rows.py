"""Row-level operators: dedup, null handling, rules, projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.dates import instant

SEQ = "_seq"
_RANK = "_rank"


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (SEQ,)) -> DataFrame:
    """Keep the last row of every key; null keys count as one group.

    ``order`` must be unique within a key to make the choice repeatable. Spark turns the filtered
    ``row_number`` into a group limit that runs before the shuffle, so a hot key sends one row per
    map task and no task ever holds the whole group.
    """
    missing = [c for c in (*keys, *order) if c not in df.columns]
    if missing:
        raise ValueError(f"keep_last needs columns {missing}")
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn(_RANK, F.row_number().over(latest)).filter(F.col(_RANK) == 1).drop(_RANK)


def drop_bookkeeping(df: DataFrame, order: Sequence[str] = (SEQ,)) -> DataFrame:
    """Drop order columns that were added at ingest (underscore names), keep business columns."""
    return df.drop(*[c for c in order if c.startswith("_")])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null (or NaN) in any of the columns."""
    return df.na.drop(subset=list(columns))


def fill(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace nulls by constants, column by column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing marker: NaN in float columns becomes null."""
    floats = [c for c, t in df.dtypes if t in ("float", "double")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats}) if floats else df


def last_rule_wins(default: Any, rules: Sequence[tuple[Column, Any]]) -> Column:
    """Ordered assignments where a later matching rule overrides an earlier one."""
    column: Column | None = None
    for condition, value in reversed(rules):
        column = F.when(condition, F.lit(value)) if column is None else column.when(condition, F.lit(value))
    return F.lit(default) if column is None else column.otherwise(F.lit(default))


def add_if_absent(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def stamp(df: DataFrame, as_of: Any = None, name: str = "last_updated") -> DataFrame:
    """Add the audit timestamp."""
    return df.withColumn(name, instant(as_of))


def existing(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def where_equals(df: DataFrame, field: str, value: Any) -> DataFrame:
    """Rows whose field equals the value; null never passes."""
    return df.filter(F.col(field) == F.lit(value))


def rename(df: DataFrame, mappings: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mappings))


def mark_transformed(df: DataFrame) -> DataFrame:
    return df.withColumn("transformed", F.lit(True))


def upper_names(df: DataFrame) -> DataFrame:
    return df.select("id", F.upper("name").alias("name"))


def suffix_text(df: DataFrame, column: str = "data", suffix: str = "_transformed") -> DataFrame:
    return df.withColumn(column, F.concat(F.col(column), F.lit(suffix)))


def kept_and_dropped(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row with the row counts before and after a transform."""
    counts = before.agg(F.count(F.lit(1)).alias("before"), F.lit(0).cast("long").alias("kept")).unionByName(
        after.agg(F.lit(0).cast("long").alias("before"), F.count(F.lit(1)).alias("kept"))
    )
    total = counts.agg(F.sum("before").alias("before"), F.sum("kept").alias("kept"))
    return total.withColumn("dropped", F.col("before") - F.col("kept"))


def union_all(*frames: DataFrame) -> DataFrame:
    """The rows of all frames, repeats kept, by column name; a column that a frame lacks is null there.

    Columns come in the order in which they are first seen. No shuffle.
    """
    if not frames:
        raise ValueError("union_all takes at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
