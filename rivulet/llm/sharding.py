"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table
(``offset + j * skip``).  Shards take turns, each claiming its next free slot,
until the table is full; a key's slot then names its shard.  Adding or removing
a shard moves few keys.  Placement is one broadcast join with a table whose size
is a parameter.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS, SLOTS = 64, 65_537


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int) -> list[int]:
    """The shard index of each slot."""
    if not shards or not is_prime(slots) or slots < len(shards) or len({*shards}) < len(shards):
        raise ValueError("needs distinct shards and a prime number of slots, no fewer than shards")
    orders = [(_hash(s + "/offset") % slots, _hash(s + "/skip") % (slots - 1) + 1) for s in shards]
    table, at, free = [-1] * slots, [0] * len(shards), slots
    while True:
        for i, (offset, skip) in enumerate(orders):
            while table[(offset + at[i] * skip) % slots] >= 0:
                at[i] += 1
            table[(offset + at[i] * skip) % slots] = i
            free -= 1
            if not free:
                return table


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot long, shard string), ``slots`` rows, from one string literal."""
    names = F.array(*[F.lit(s) for s in shards])
    line = F.lit(",".join(map(str, fill(shards, slots))))
    return spark.range(1).select(F.posexplode(F.split(line, ",")).alias("slot", "i")).select(F.col("slot").cast("long"), F.element_at(names, F.col("i").cast("int") + 1).alias("shard"))


def slot(key: Column, slots: int = SLOTS) -> Column:
    """The first 15 hex digits of the key's MD5, modulo ``slots``; null is the empty text."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """Adds ``slot`` and ``shard``, replacing columns of these names.  Equal keys
    share a shard; null keys are placed as the empty text."""
    names = [c for c in rows.columns if c not in ("slot", "shard")]
    with_slot = rows.withColumn("slot", slot(F.col(key), slots))
    return with_slot.drop("shard").join(F.broadcast(lookup(rows.sparkSession, shards, slots)), "slot").select(*names, "slot", "shard")


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]
