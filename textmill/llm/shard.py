"""Sharding by a permutation-filled lookup table.

Every shard orders the slots of a table of prime size by its own permutation,
(offset + k * skip) mod size, both numbers being hashes of its name.  The
shards take turns: each claims the first slot of its order that is still free,
until the table is full.  Shares differ by at most one slot, and a shard that
comes or goes moves little besides its own share.  A key's slot is its hash
modulo the size, so a placement is one lookup in a broadcast table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
MOST_SLOTS = 1 << 20  # bounds what is broadcast


def _number(salt: str, name: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (its place in ``shards``) of every slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("distinct shard names are needed")
    if not len(shards) < slots <= MOST_SLOTS or any(slots % p == 0 for p in range(2, int(slots ** 0.5) + 1)):
        raise ValueError(f"a prime of more slots than shards is needed, at most {MOST_SLOTS}")
    at = [_number("offset", s) % slots for s in shards]
    skip = [_number("skip", s) % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while True:
        for k in range(len(shards)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            owner[at[k]] = k
            free -= 1
            if not free:
                return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard), one row per slot."""
    owners = ",".join(map(str, fill(shards, slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard")).select(
        F.col("slot").cast("long").alias("slot"), F.col("shard").cast("int").alias("shard"))


def slot_of(key: str | Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of the MD5 of its text, modulo the size.  A
    null key counts as an empty text."""
    c = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long") % slots


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, slot_col: str = "slot",
          shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard of every row; no shuffle.  Columns of
    these names must not exist.  Repeated keys share a place; an empty table
    stays empty."""
    if clash := {slot_col, shard_col} & set(df.columns):
        raise ValueError(f"columns exist: {sorted(clash)}")
    table = lookup_table(df.sparkSession, shards, slots).select(F.col("slot").alias(slot_col), F.col("shard").alias(shard_col))
    placed = df.withColumn(slot_col, slot_of(key, slots))
    return placed.join(F.broadcast(table), slot_col).select(*[placed[c] for c in df.columns], placed[slot_col], table[shard_col])


def write_shards(df: DataFrame, path: str, key: str, shards: list[str], slots: int = SLOTS, salts: int = 8) -> None:
    """Parquet files by shard.  Each shard is written by ``salts`` tasks, so a
    large shard, or one hot key, does not pass through a single one."""
    placed = place(df, key, shards, slots)
    salt = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(salts))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)
