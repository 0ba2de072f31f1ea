"""Placement of keys on weighted shards through a permutation-filled lookup table.

Each shard walks the slots of a table of prime size in its own order, offset + j · skip.
Shards take turns, heavier ones more often, and claim their next free slot until the table
is full. A key is hashed to a slot; the table, whose size is a parameter, is broadcast.
Adding or losing a shard moves few keys but those it gains or gives up.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: dict[str, float], slots: int = SLOTS) -> list[str]:
    """Name of the shard of every slot. Weights are relative; a shard of weight 0 has none."""
    if not _is_prime(slots):
        raise ValueError(f"{slots} is not prime")
    live = {name: weight for name, weight in sorted(shards.items()) if weight > 0}
    if not live:
        raise ValueError("no shard has a weight")
    if slots < len(live):
        raise ValueError("more shards than slots")
    orders = {}
    for name in live:
        digest = hashlib.sha256(name.encode()).digest()
        offset = int.from_bytes(digest[:8], "big") % slots
        skip = int.from_bytes(digest[8:16], "big") % (slots - 1) + 1
        orders[name] = [offset, skip]
    table: list[str | None] = [None] * slots
    heaviest, credit, free = max(live.values()), dict.fromkeys(live, 0.0), slots
    while free:
        for name, weight in live.items():
            credit[name] += weight / heaviest
            if credit[name] < 1 - 1e-9 or not free:
                continue
            credit[name] -= 1
            at, skip = orders[name]
            while table[at] is not None:
                at = (at + skip) % slots
            table[at], free = name, free - 1
            orders[name][0] = (at + skip) % slots
    return table


def slot(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its MD5, modulo the table size. Null is the empty key."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(slots))


def table_frame(spark: SparkSession, shards: dict[str, float], slots: int = SLOTS) -> DataFrame:
    rows = list(enumerate(lookup_table(shards, slots)))
    return spark.createDataFrame(rows, "slot long, shard string")


def place(rows: DataFrame, key: str, shards: dict[str, float], slots: int = SLOTS) -> DataFrame:
    """Add slot and shard to every row of `rows`, in its own columns' order.

    A join against the broadcast table of `slots` rows: no shuffle, so a key that a third of
    the rows share costs nothing more. Rows without a key go where the empty key goes; rows
    that repeat go to the same shard; an empty table stays empty. Columns of `rows` named
    slot or shard are replaced.
    """
    table = table_frame(rows.sparkSession, shards, slots)
    kept = rows.drop("slot", "shard").withColumn("slot", slot(F.col(f"`{key}`"), slots))
    return kept.join(F.broadcast(table), "slot").select(*kept.columns, "shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write rows to one folder per shard; each task writes the shards of its own rows."""
    placed.write.partitionBy("shard").parquet(path)
