"""Running totals and row numbers that no single task has to hold whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datamill.functions.buckets import bucket
from datamill.session import cut


def running_total(
    rows: DataFrame, group: list[str], order: list[str], value: str, out: str, block: str | None = None
) -> DataFrame:
    """Add `out`, the sum of `value` up to and with this row in `order` within `group`.

    `block` names a column that never falls along `order`. With it the sum is taken in two
    steps, whole blocks first and rows inside a block second, so a hot group is spread over
    as many tasks as it has blocks.
    """
    keys = [*group, block] if block else group
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if not block:
        return rows.withColumn(out, F.sum(value).over(inside))
    earlier = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(*keys)
        .agg(F.sum(value).alias("_block_total"))
        .withColumn("_before", F.coalesce(F.sum("_block_total").over(earlier), F.lit(0)))
        .drop("_block_total")
    )
    return (
        rows.join(before, keys)
        .withColumn(out, F.col("_before") + F.sum(value).over(inside))
        .drop("_before")
    )


def number_keys(keys: DataFrame, key: str, out: str, salt: str = "number", blocks: int = 4096) -> DataFrame:
    """Number the distinct values of `key` 0, 1, 2, … in the order of (hash block, key).

    Each hash block is numbered on its own and moved up by the rows of the blocks before
    it; only the `blocks` block sizes meet in one task. The keys are written out first.
    """
    rows = cut(keys.select(key).distinct()).select(
        key,
        F.lit(0).alias("_all"),
        F.pmod(bucket(F.col(key), salt), F.lit(blocks)).alias("_block"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    ranked = running_total(rows, ["_all"], [key], "_one", "_rank", "_block")
    return ranked.select(key, (F.col("_rank") - 1).alias(out))


def number_sorted(keys: DataFrame, key: str, out: str) -> DataFrame:
    """Number the distinct values of `key`, nulls left out, 0, 1, 2, … in their own order.

    The values are ranged over tasks; each range is numbered on its own and moved up by the
    rows of the ranges before it. No task and no driver holds all values.
    """
    ranged = keys.select(key).filter(F.col(key).isNotNull()).distinct().repartitionByRange(key)
    rows = cut(
        ranged.select(
            key, F.lit(0).alias("_all"), F.spark_partition_id().alias("_block"), F.lit(1).cast("bigint").alias("_one")
        )
    )
    ranked = running_total(rows, ["_all"], [key], "_one", "_rank", "_block")
    return ranked.select(key, (F.col("_rank") - 1).alias(out))


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    """The first `n` rows of each group. The rank limit runs before the shuffle as well, so
    only `n` rows per group and input partition are moved."""
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
