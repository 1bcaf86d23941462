"""Distinct counts that can be merged: one sketch per group and period, kept and added up later.

An exact distinct count needs all rows again for each new span. Sketches of months are merged into those of any span, at a
relative standard error of about 1.04 / sqrt(2 ** ``LOG_SIZE``). Exact counts stay the default of marts and profiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 12


def relative_error(log_size: int = LOG_SIZE) -> float:
    """The relative standard error of an estimate."""
    return 1.04 / 2 ** (log_size / 2)


def sketch_distinct(df: DataFrame, groups: Sequence[str], column: str, log_size: int = LOG_SIZE) -> DataFrame:
    """A row per group with the ``sketch`` of a column's distinct values; nulls do not count. Partial sketches are built before the shuffle."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(F.col(column), log_size).alias("sketch"))


def merge_distinct(sketches: DataFrame, groups: Sequence[str], name: str = "distinct_estimate") -> DataFrame:
    """The estimated distinct count over all sketches of a group (any part of the groups they were built for)."""
    merged = F.hll_union_agg("sketch")
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(merged).alias(name))
