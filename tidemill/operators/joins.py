"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_KEYS = 64  # bound on the number of keys that are split, and so on what is broadcast for it
TRACKED = 4096  # size of the frequency sketch
SALTS = 64


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def auto_broadcast_limit(df: DataFrame) -> int:
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str] | str,
    how: str = "left",
    broadcast_limit: int | None = None,
    sketch_from: DataFrame | None = None,
) -> DataFrame:
    """Join facts to a lookup; ``how`` is ``left`` or ``left_anti``.

    A lookup within Spark's own broadcast limit is left to Spark, which then moves no fact row. A
    larger one is joined by shuffle, with the hot fact keys split (see ``salted_join``). The hot keys
    are looked for in ``sketch_from``, by default in the facts: name the stored table they come from
    when the facts are costly to compute. Other columns that both sides have get the suffixes ``_x``
    and ``_y``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how == "left":
        facts, lookup = suffix_clashes(facts, lookup, keys)
    limit = auto_broadcast_limit(facts) if broadcast_limit is None else broadcast_limit
    if 0 <= estimated_bytes(lookup) <= limit:
        return facts.join(lookup, keys, how)
    return salted_join(facts, lookup, keys, how, sketch_from=sketch_from)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(facts: DataFrame, keys: Sequence[str], most: int = HOT_KEYS) -> DataFrame:
    """Hashes of the most frequent keys, at most ``most`` rows.

    A frequency sketch finds them in one pass over the key columns with constant memory. It only
    decides which keys are split, so being approximate cannot change a join result.
    """
    top = facts.select(key_hash(keys).alias("_key")).agg(F.expr(f"approx_top_k(_key, {most}, {TRACKED})").alias("_top"))
    return top.select(F.explode("_top").alias("_item")).select(F.col("_item.item").alias("_hot"))


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    salts: int = SALTS,
    sketch_from: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join whose hot and null fact keys are spread over ``salts`` tasks.

    The lookup rows of hot keys are repeated once per salt, so each fact row still meets every match
    exactly once. The salt is a hash of the row and of the task it comes from: it spreads different rows of
    one task and equal rows of different tasks, and is the same when a lost task runs again. Null keys
    match nothing and need no repeated lookup rows.
    """
    if how not in ("left", "left_anti"):
        raise ValueError("how must be left or left_anti")
    hot = F.broadcast(hot_keys(facts if sketch_from is None else sketch_from, keys))
    any_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    plain = [f.name for f in facts.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.lit(salts)).cast("int")
    left = (
        facts.withColumn("_key", key_hash(keys))
        .join(hot, F.col("_key") == F.col("_hot"), "left")
        .withColumn("_salt", F.when(F.col("_hot").isNotNull() | any_null, spread).otherwise(F.lit(0)))
        .drop("_key", "_hot")
    )
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = (
        lookup.withColumn("_key", key_hash(keys))
        .join(hot, F.col("_key") == F.col("_hot"), "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_key", "_hot")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def suffix_clashes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rename non-key columns that both sides have to ``_x`` on the left and ``_y`` on the right."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    return (
        left.withColumnsRenamed({c: f"{c}_x" for c in shared}),
        right.withColumnsRenamed({c: f"{c}_y" for c in shared}),
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str, **options) -> DataFrame:
    """Child rows without a parent; null references are reported too."""
    referenced = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return lookup_join(child, referenced, column, "left_anti", **options).select(*child.columns)
