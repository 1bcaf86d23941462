"""JSON expressions over typed structs whose uncertain fields are VARIANT.

A VARIANT field keeps apart what a typed field merges: an absent key is SQL null, an explicit JSON
null is a value. One ``from_json`` pass therefore serves both typed access and presence tests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.numbers import looks_numeric


def parse_records(df: DataFrame, raw: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON text column into top-level columns, dropping all others but ``keep``.

    The record goes through a one-element ``inline``. A plain projection would let the optimizer copy
    the parse into every filter and field access above it, and so parse each text many times.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(raw, schema))))


def present(field: Column) -> Column:
    """The key occurs in the document, even with an explicit null."""
    return field.isNotNull()


def filled(field: Column) -> Column:
    """The key occurs with something other than null."""
    return field.isNotNull() & ~F.is_variant_null(field)


def default_if_absent(field: Column, dtype: str, default: Column) -> Column:
    """Default for an absent key only; an explicit null stays null."""
    return F.when(present(field), field.cast(dtype)).otherwise(default.cast(dtype))


def strict_number(field: Column, dtype: str, name: str) -> Column:
    """0 for an absent key, the number for a present one, an error for an explicit null."""
    return (
        F.when(~present(field), F.lit(0).cast(dtype))
        .when(F.is_variant_null(field), F.raise_error(F.lit(f"{name} is null")))
        .when(_odd_text(F.to_json(field)), _not_a(dtype, name, F.to_json(field)).cast(dtype))
        .otherwise(field.cast(dtype))
    )


def _odd_text(shown: Column) -> Column:
    """A JSON text that is no plain number: a cast alone takes ``12d`` and ``NaN``. ``shown`` is a value as JSON."""
    return shown.startswith('"') & ~looks_numeric(F.btrim(shown, F.lit('"')))


def _not_a(dtype: str, name: str, shown: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"{name} is no {dtype}: "), shown))


def checked_number(field: Column, dtype: str, name: str, text: bool = True) -> Column:
    """The number of a JSON value; null when absent or null. Anything that is no such number fails the job.

    A whole number written with a fraction fits an integer type, and so does a number in a text unless ``text`` is false.
    """
    number = F.try_variant_get(field, "$", "double")
    value = number.cast("long").cast(dtype) if dtype == "int" else number
    fits = number.isNotNull()
    if dtype == "int":
        fits = fits & (F.floor(number) == number) & number.between(-(2**31), 2**31 - 1)
    shown, is_text = F.to_json(field), F.try_variant_get(field, "$", "binary").isNotNull()
    # Numbers take the first branch; a boolean would pass as 0 or 1, and a text as more than a number.
    plain = fits & ~is_text & ~(number.isin(0.0, 1.0) & shown.isin("true", "false"))
    empty = field.isNull() | F.is_variant_null(field)
    written = F.lit(text) & is_text & fits & ~_odd_text(shown)
    return F.when(plain, value).when(empty, F.lit(None)).when(written, value).otherwise(_not_a(dtype, name, shown)).cast(dtype)


def missing_keys(fields: Mapping[str, Column]) -> Column:
    """The names of required keys that are absent, as text; null when there are none."""
    names = F.concat_ws(", ", *[F.when(~present(c), F.lit(n)) for n, c in fields.items()])
    return F.when(names != "", names)


def require_keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fail the job at the first record that lacks a required key.

    The check is a filter that is always true or raises, so it runs in the same pass as the
    transform and cannot be pruned away.
    """
    missing = missing_keys({n: F.col(n) for n in names})
    message = F.concat(F.lit("missing required keys: "), missing)
    return df.filter(F.when(missing.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))


def without_keys(raw: Column, names: Sequence[str]) -> Column:
    """All other top-level fields of a JSON object as a map of VARIANT."""
    return F.map_filter(F.from_json(raw, "map<string,variant>"), lambda k, _: ~k.isin(list(names)))


def scalar_or_member(value: Column, member: str, dtype: str) -> Column:
    """A field that holds either a scalar or an object with the scalar under ``member``."""
    return F.when(
        F.schema_of_variant(value).startswith("OBJECT"), F.try_variant_get(value, f"$.{member}", dtype)
    ).otherwise(F.try_variant_get(value, "$", dtype))


def row_as_json(df: DataFrame, column: str = "raw_data") -> DataFrame:
    """Add a JSON copy of the whole row, nulls kept."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.withColumn(column, F.to_json(row, {"ignoreNullFields": "false"}))


def row_as_variant(df: DataFrame, column: str = "raw_data") -> DataFrame:
    """Add a VARIANT copy of the whole row: members keep their types and are read by path; a null member is a JSON null."""
    return df.withColumn(column, F.to_variant_object(F.struct(*[F.col(c) for c in df.columns])))


def variant_columns(df: DataFrame, schema: str, column: str = "raw_data") -> DataFrame:
    """The members of a VARIANT column as columns of ``schema``; absent and null members are null, others must fit."""
    fields = T.StructType.fromDDL(schema)
    paths = [f"$['{f.name}']" for f in fields]
    return df.select(*[F.variant_get(column, p, f.dataType.simpleString()).alias(f.name) for p, f in zip(paths, fields)])
