"""Joins and groupings that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 256
# Below this many rows in all, no single group can overload a task.
SMALL_TABLE = 10_000_000
SAMPLE_ROWS = 1_000_000
SLICES = 256


def hot_keys(
    df: DataFrame, key: str, total: int | None = None, small_table: int | None = None
) -> list[Any]:
    """Keys that hold more than about 1/256 of the rows: some hundred values at most.

    Taken from a sample of about a million keys, where such a key shows up thousands of
    times. Callers use the keys to spread work, never to choose rows, so a key that the
    sample judges wrongly costs time and not correctness. Tables of up to `small_table` rows
    (SMALL_TABLE if not given) are not searched; pass `total` when the number is known.
    """
    keys = df.select(key)
    if total is None:
        total = keys.count()
    if total <= (SMALL_TABLE if small_table is None else small_table):
        return []
    sample = keys.sample(min(1.0, SAMPLE_ROWS / total), seed=1) if total > SAMPLE_ROWS else keys
    most = sample.groupBy(key).count().orderBy(F.desc("count")).limit(int(1 / HOT_SHARE))
    least = min(total, SAMPLE_ROWS) * HOT_SHARE
    return [row[key] for row in most.collect() if row["count"] > least and row[key] is not None]


def slice_of(is_hot: Column, spread: list[str], slices: int = SLICES) -> Column:
    """The slice of a row: hot keys are spread by the `spread` columns, others stay whole."""
    return F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(slices))).otherwise(F.lit(0)).cast("int")


def every_slice(is_hot: Column, slices: int = SLICES) -> Column:
    """One row per slice for a hot key, one row in all for any other key."""
    return F.explode(F.sequence(F.lit(0), F.when(is_hot, F.lit(slices - 1)).otherwise(F.lit(0))))


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "left",
    spread: list[str] | None = None,
    total: int | None = None,
    small_table: int | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Join `table`, which has one row per `key`, to `rows`.

    Rows of hot keys are cut into 256 slices by the `spread` columns (all columns if not
    named) and only the table rows of those few keys are copied once per slice. Without hot
    keys this is the plain join, where Catalyst picks broadcast or shuffle by size.

    Where `rows` are costly to make, `probe` may name a cheaper frame, such as the scan
    below them, that holds the key in like shares.
    """
    hot = hot_keys(rows if probe is None else probe, key, total, small_table)
    if not hot:
        return rows.join(table, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    left = rows.withColumn("_slice", slice_of(is_hot, spread or rows.columns))
    right = table.withColumn("_slice", every_slice(is_hot))
    return left.join(right, [key, "_slice"], how).drop("_slice")
