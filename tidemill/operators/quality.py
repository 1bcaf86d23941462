"""Data quality checks. Each check returns the offending rows; a suite returns one row per check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.errors import QualityError
from tidemill.functions.numbers import parse_number
from tidemill.operators.joins import orphans


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, null included, with their counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Rows with a value outside the list; null passes."""
    return df.filter(~F.col(column).isin(list(values)))


def cross_table(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Rows whose reference is missing; a null reference counts as missing."""
    return orphans(df, column, reference, reference_column)


@dataclass(frozen=True)
class Check:
    """One test of a suite: kind is not_null, unique, accepted_values or cross_table."""

    kind: str
    column: str
    values: Sequence[Any] = ()
    reference: DataFrame | None = field(default=None, compare=False)
    reference_column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"


def _row_test(check: Check) -> Column | None:
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(list(check.values))
    return None


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures per check and pass/fail. All row checks share one pass over the data."""
    parts: list[DataFrame] = []
    row_checks = [(c, test) for c in checks if (test := _row_test(c)) is not None]
    if row_checks:
        totals = df.agg(*[F.count_if(test).alias(f"f{i}") for i, (_, test) in enumerate(row_checks)])
        cells = [
            F.struct(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"), F.col(f"f{i}").alias("failures"))
            for i, (c, _) in enumerate(row_checks)
        ]
        parts.append(totals.select(F.inline(F.array(*cells))))
    for c in checks:
        if c.kind == "unique":
            bad = unique(df, c.column)
        elif c.kind == "cross_table":
            bad = cross_table(df.select(c.column), c.column, c.reference, c.reference_column)
        elif _row_test(c) is None:
            raise ValueError(f"unknown check {c.kind!r}")
        else:
            continue
        parts.append(
            bad.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.name).alias("check"), F.lit(c.column).alias("column"), "failures"
            )
        )
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    return results.withColumn("status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))


def null_percentages(df: DataFrame) -> DataFrame:
    """One row: the row count and the percentage of nulls of every column, from one pass."""
    percent = [(F.count_if(F.col(c).isNull()) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias(c) for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("_rows"), *percent)


def validate(
    df: DataFrame, min_rows: int = 1, required_columns: Sequence[str] = (), max_nulls_percent: float = 10.0
) -> DataFrame:
    """Return the frame unchanged if it passes the gate, else raise with the details.

    Reads the data once. Checks in order: rows, columns, share of nulls (strictly above the limit fails).
    """
    seen = null_percentages(df).first()
    if seen["_rows"] < min_rows:
        raise QualityError(f"{seen['_rows']} rows, fewer than {min_rows}")
    missing = [c for c in required_columns if c not in df.columns]
    if missing:
        raise QualityError(f"columns not there: {missing}")
    over = {c: f"{seen[c]:.2f}%" for c in df.columns if seen[c] is not None and seen[c] > max_nulls_percent}
    if over:
        raise QualityError(f"more than {max_nulls_percent}% nulls: {over}")
    return df


def require_fields(df: DataFrame, columns: Sequence[str] = ("id", "name")) -> DataFrame:
    """Fail at planning time for a missing column, at run time for a record without a value."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"Each item must have fields: {', '.join(missing)}")
    for c in columns:
        bad = F.raise_error(F.lit(f"Each item must have a '{c}' field")).cast("boolean")
        df = df.filter(F.when(F.col(c).isNull(), bad).otherwise(True))
    return df


def split_valid(df: DataFrame, schema: str, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Typed records, and rejected ones as they came: a required field is missing or a value does not fit."""
    fields = T.StructType.fromDDL(schema)
    values = {f.name: F.col(f.name) if f.name in df.columns else F.lit(None).cast("string") for f in fields}
    typed = {
        f.name: parse_number(values[f.name].cast("string")).cast(f.dataType)
        if isinstance(f.dataType, T.FractionalType)
        else values[f.name].try_cast(f.dataType)
        for f in fields
    }
    missing = [values[c].isNull() for c in required]
    misfit = [values[c].isNotNull() & typed[c].isNull() for c in typed]
    bad = F.array_contains(F.array(*missing, *misfit), True)
    return df.filter(~bad).select(*[v.alias(c) for c, v in typed.items()]), df.filter(bad)


def profile(df: DataFrame, step: str | None = None, approximate: bool = False) -> DataFrame:
    """One tidy row per column: kind, range, mean, distinct values, nulls, and the frame's size.

    Numbers have a range and mean, times a range, others a distinct count. The exact distinct counts
    repeat every row once per such column in the shuffle; ``approximate`` counts by sketch instead.
    """
    aggregates, cells = [F.count(F.lit(1)).alias("_rows")], []
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    nothing, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    for i, f in enumerate(df.schema.fields):
        value = F.col(f.name)
        aggregates.append(F.count_if(value.isNull()).alias(f"n{i}"))
        low = high = nothing
        mean, values = no_number, F.lit(None).cast("long")
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            kind = "numeric"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            kind = "datetime"
        else:
            kind = "other"
            aggregates.append(distinct(value).alias(f"v{i}"))
            values = F.col(f"v{i}")
        if kind != "other":
            aggregates += [F.min(value).alias(f"l{i}"), F.max(value).alias(f"h{i}")]
            low, high = F.col(f"l{i}").cast("string"), F.col(f"h{i}").cast("string")
        if kind == "numeric":
            number = value.cast("int") if isinstance(f.dataType, T.BooleanType) else value
            aggregates.append(F.avg(number).alias(f"m{i}"))
            mean = F.col(f"m{i}").cast("double")
        nulls = F.col(f"n{i}")
        percent = F.coalesce(F.try_divide(nulls * 100.0, F.col("_rows")), F.lit(0.0))
        cells.append(
            F.struct(
                F.lit(step).cast("string").alias("step"),
                F.lit(f.name).alias("column"),
                F.lit(kind).alias("kind"),
                F.col("_rows").alias("row_count"),
                F.lit(len(df.columns)).alias("column_count"),
                low.alias("min"),
                high.alias("max"),
                mean.alias("mean"),
                values.alias("distinct_count"),
                nulls.alias("null_count"),
                percent.alias("null_percent"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*cells)))
