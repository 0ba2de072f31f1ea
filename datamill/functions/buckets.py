"""Hash buckets and hashed identifiers that give the same value on every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 2**32


def bucket(key: Column, salt: str) -> Column:
    """A bucket in [0, 2^32) from the first 8 hex digits of md5(key || salt)."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def share(fraction: float) -> int:
    """The bucket below which `fraction` of all keys fall."""
    return int(fraction * BUCKETS)


def topic_id(name: Column) -> Column:
    """First 8 bytes of the MD5 of a name, read little-endian as a signed 64-bit number."""
    digest = F.md5(F.encode(name, "utf-8"))
    big_endian = F.concat(*[F.substring(digest, at, 2) for at in range(15, 0, -2)])
    return F.conv(big_endian, 16, -10).cast("bigint")
