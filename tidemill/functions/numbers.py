"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def looks_numeric(text: Column) -> Column:
    """Plain number text. Unlike a cast it refuses the Java type suffixes ``d`` and ``f``."""
    return text.rlike(NUMBER)


def parse_number(text: Column) -> Column:
    """Lenient parse to double; bad text becomes null.

    The cast runs on number texts only, because a failing one costs an exception per row.
    """
    return F.when(looks_numeric(text), text.try_cast("double"))


def not_negative(number: Column) -> Column:
    return F.when(number >= 0, number)


def ratio(part: Column, whole: Column, when_zero: float | None = None) -> Column:
    """part / whole; ``when_zero`` decides the result for a zero divisor, whatever the part is."""
    return F.when(whole == 0, F.lit(when_zero)).otherwise(F.try_divide(part, whole))


def mmol_per_litre(mg_per_dl: Column) -> Column:
    """Glucose mg/dL to mmol/L with one decimal (18 mg/dL are taken as 1 mmol/L)."""
    return F.round(mg_per_dl / 18.0, 1)
