"""Sharding by a permutation-filled lookup table: constant-time placement that hardly moves when shards change."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from hashlib import blake2b

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots of the table: a prime, well over a hundred times the number of shards.
SLOTS = 65537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


@lru_cache(maxsize=16)
def lookup_table(shards: tuple[str, ...], slots: int = SLOTS) -> tuple[int, ...]:
    """The shard (its position) of each slot.

    Each shard prefers the slots in the order ``offset, offset + skip, ...`` modulo the prime ``slots``, with
    offset and skip from hashes of its name. Shards take turns, each claiming the first free slot it prefers,
    so every two shards differ by one slot at most.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need different names, at least one")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError(f"{slots} slots: a prime of at least {len(shards)} is needed")
    steps = []
    for name in shards:
        digest = blake2b(name.encode(), digest_size=16).digest()
        offset, skip = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
        steps.append([offset % slots, skip % (slots - 1) + 1 if slots > 2 else 1])
    table, left = [-1] * slots, slots
    while left:
        for shard, step in enumerate(steps):
            while table[step[0]] >= 0:
                step[0] = (step[0] + step[1]) % slots
            table[step[0]] = shard
            left -= 1
            if not left:
                break
    return tuple(table)


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 60 bits of its MD5 modulo the number of slots. A null key counts as empty text."""
    text = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def assign_shards(df: DataFrame, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """Add ``slot`` and ``shard`` (a name from ``shards``) to each row, by its key alone.

    The table has ``slots`` numbers, however large the input is, and is joined by broadcast: no shuffle, and a hot
    source or a group of copies is spread like any other rows as long as the key differs. Equal keys go to one
    shard; a null key has the slot of the empty text. Every row stays; columns named ``slot`` or ``shard`` are replaced.
    """
    spark = df.sparkSession
    names = tuple(shards)
    schema = T.StructType([T.StructField("slot", T.IntegerType(), False), T.StructField("shard", T.StringType(), False)])
    table = spark.createDataFrame([(i, names[k]) for i, k in enumerate(lookup_table(names, slots))], schema)
    placed = df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots=slots))
    return placed.join(F.broadcast(table), "slot", "left").select(*[placed[c] for c in placed.columns if c != "slot"], "slot", "shard")
