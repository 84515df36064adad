"""Sharding by a permutation-filled lookup table (DataFrame functions only).

Each shard prefers the slots of a prime-sized table in an order of its own,
given by an offset and a step from its name's hash. Shards take turns; each
claims its most preferred slot that is still free, until the table is full. A
row's key hashes to a slot and the slot names the shard, so placement is one
lookup, loads differ by about ``1 / (slots per shard)``, and a change of the
shard list moves few keys.

The table has ``table_size`` rows whatever the data's size: it is filled once
on the driver and broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_TABLE_SIZE = 65_537
#: Ten times the default: what a broadcast of (slot, shard) may hold, under 16 MB.
MAX_TABLE_SIZE = 655_373


def is_prime(n: int) -> bool:
    if n < 2:
        return False
    i = 2
    while i * i <= n:
        if n % i == 0:
            return False
        i += 1
    return True


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: Sequence[str], table_size: int = DEFAULT_TABLE_SIZE, weights: Sequence[int] | None = None) -> list[int]:
    """slot -> index into ``shards``. A shard of weight w claims w slots a turn."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and not empty")
    if not is_prime(table_size) or table_size > MAX_TABLE_SIZE:
        raise ValueError(f"table_size must be a prime of at most {MAX_TABLE_SIZE}")
    if len(shards) > table_size:
        raise ValueError("more shards than slots")
    turns = list(weights) if weights is not None else [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 0 or not any(turns):
        raise ValueError("one weight >= 0 per shard, not all 0")
    at = [_number(f"offset:{s}") % table_size for s in shards]
    step = [_number(f"step:{s}") % (table_size - 1) + 1 if table_size > 2 else 1 for s in shards]
    owner, free = [-1] * table_size, table_size
    while free:
        for i, n in enumerate(turns):
            for _ in range(n):
                if not free:
                    break
                while owner[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % table_size
                owner[at[i]] = i
                free -= 1
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], table_size: int = DEFAULT_TABLE_SIZE, weights: Sequence[int] | None = None) -> DataFrame:
    """(slot, shard) for every slot."""
    owner = fill_table(shards, table_size, weights)
    schema = T.StructType([T.StructField("slot", T.LongType(), False), T.StructField("shard", T.StringType(), False)])
    return spark.createDataFrame([(i, shards[o]) for i, o in enumerate(owner)], schema)


def slot_of(key: Column, table_size: int) -> Column:
    """The slot of a key: 60 bits of the md5 of its text, modulo the table's size. A null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(table_size)


def place(df: DataFrame, key: str, shards: Sequence[str], table_size: int = DEFAULT_TABLE_SIZE, weights: Sequence[int] | None = None, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """Add ``slot_col`` and ``shard_col`` to every row of ``df``; columns of these names are replaced.

    Null keys go to the slot of the empty text; equal keys to the same shard;
    repeated rows stay; an empty table gives an empty table. Spread of load
    needs a key with many values (an id): rows of one key stay together.
    """
    keep = df.drop(*[c for c in df.columns if c in (slot_col, shard_col) and c != key])
    table = lookup_table(df.sparkSession, shards, table_size, weights).select(F.col("slot").alias("__slot"), F.col("shard").alias("__shard"))
    slotted = keep.withColumn("__key_slot", slot_of(F.col(f"`{key}`"), table_size))
    joined = slotted.join(F.broadcast(table), F.col("__key_slot") == F.col("__slot"))
    return joined.select(*[F.col(f"`{c}`") for c in keep.columns], F.col("__slot").alias(slot_col), F.col("__shard").alias(shard_col))
