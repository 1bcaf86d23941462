"""Upserts as set operations on frames; writing them is in ``tidemill.sinks.versioned``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.errors import QualityError
from tidemill.operators.rows import SEQ, drop_bookkeeping, keep_last


def newest(batch: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The batch with one row per key, the last by ``order`` or by ingest position.

    Without either a repeated key fails the job. An empty order says that the batch is reduced already.
    """
    if order is None and SEQ in batch.columns:
        order = (SEQ,)
    if order is None:
        return single(batch, keys)
    return drop_bookkeeping(keep_last(batch, keys, order), order) if order else batch


def single(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch as it is; a key that comes twice is an error (null keys match nothing and may repeat).

    A job over the keys alone, with partial counts, looks for one.
    """
    counted = batch.select(*keys).dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if not counted.filter("_n > 1").isEmpty():
        raise QualityError(f"a batch without order repeats a key: {', '.join(keys)}")
    return batch


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Existing rows with the batch's rows in place of those with the same key.

    A batch that may repeat a key is reduced to the last row per key by ``order``. Only the keys of
    the batch take part in the join: while they are small Spark broadcasts them and the big table
    is not shuffled. ``seen`` counts the batch rows that go in.
    """
    incoming = newest(batch, keys, order)
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    if seen is not None:
        incoming = incoming.observe(seen, F.count(F.lit(1)).alias("rows"))
    return kept.unionByName(incoming, allowMissingColumns=True).select(*existing.columns)


def upsert_columns(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert where a key clash changes only the ``update`` columns; the others keep their old value.

    A batch that repeats a key is reduced to its last row by ``order``.
    """
    old = existing.withColumn("_there", F.lit(True)).alias("o")
    new = newest(batch, keys, order).withColumn("_there", F.lit(True)).alias("n")
    same = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    in_old, in_new = F.col("o._there").isNotNull(), F.col("n._there").isNotNull()
    columns = []
    for c in existing.columns:
        if c in keys:
            value = F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))
        elif c in update:
            value = F.when(in_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        else:
            value = F.when(in_old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        columns.append(value.alias(c))
    return old.join(new, same, "full").select(*columns)
