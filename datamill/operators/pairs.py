"""Unordered item pairs of records, counted over all records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A record with more items than this is cut into cells of about this many items.
CELL_ITEMS = 1024
# Big records up to this many are sent to every task; more are joined by shuffle.
BROADCAST_RECORDS = 100_000
# A task makes about so many pairs, however few bytes of rows they come from.
PAIRS_PER_TASK = 1_000_000
# No more parts than the driver keeps track of with ease.
MOST_PARTS = 50_000


def pair_parts(pairs: float, least: int) -> int:
    """Into how many tasks so many pairs go, `least` of them or more."""
    return int(max(least, min(MOST_PARTS, -(-pairs // PAIRS_PER_TASK))))


def record_pairs(rows: DataFrame, record: str, item: str, cell_items: int = CELL_ITEMS) -> DataFrame:
    """Pairs (record, first, second) with first < second, each once per record, and the
    self pair when a record names an item twice.

    The rows of a record meet on its key. A record of more than `cell_items` rows is dealt
    into slots, and each two slots meet in a cell of their own, so that no task ever holds
    a whole big record; every pair still comes out once. The number of tasks follows the
    pairs and not the bytes of the rows, which would put too many pairs into one task.
    """
    # Without NULLs from the start, all branches below read one and the same shuffle.
    rows = rows.select(F.col(record).alias("record"), F.col(item).alias("item"))
    rows = rows.filter("record is not null and item is not null")
    sizes = rows.groupBy("record").agg(F.count(F.lit(1)).alias("_rows"))
    big = sizes.filter(F.col("_rows") > cell_items)
    size = F.col("_rows").cast("double")
    seen = sizes.agg(F.count_if(F.col("_rows") > cell_items).alias("big"), F.sum(size * (size + 1) / 2).alias("pairs")).first()
    n_big = seen.big
    parts = pair_parts(seen.pairs or 0.0, rows.sparkSession.sparkContext.defaultParallelism)
    if n_big == 0:
        # One shuffle by record serves the count of repeats and both sides of the join.
        once = rows.repartition(parts, "record").groupBy("record", "item").agg(F.count(F.lit(1)).alias("times"))
        left = once.select("record", F.col("item").alias("first"))
        right = once.select("record", F.col("item").alias("second"))
        mixed = left.join(right, "record").filter("first < second")
    else:
        once = rows.groupBy("record", "item").agg(F.count(F.lit(1)).alias("times"))
        sizes = big.select("record", F.ceil(F.col("_rows") / cell_items).cast("int").alias("_slots"))
        if n_big <= BROADCAST_RECORDS:
            sizes = F.broadcast(sizes)
        slots = F.coalesce("_slots", F.lit(1))
        dealt = (
            once.join(sizes, "record", "left")
            .withColumn("slot", F.pmod(F.xxhash64("item"), slots).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), slots - 1)))
            .select(
                "record",
                F.least("slot", "other").alias("low"),
                F.greatest("slot", "other").alias("high"),
                "slot",
                "item",
            )
            .repartition(parts, "record", "low", "high")
        )
        left = dealt.select("record", "low", "high", F.col("slot").alias("slot_a"), F.col("item").alias("first"))
        right = dealt.select("record", "low", "high", F.col("slot").alias("slot_b"), F.col("item").alias("second"))
        # Off the diagonal only items of different slots meet, or a pair would repeat.
        mixed = left.join(right, ["record", "low", "high"]).filter(
            "first < second and (low = high or slot_a <> slot_b)"
        )
    mixed = mixed.select("record", "first", "second")
    own = once.filter("times > 1").select("record", F.col("item").alias("first"), F.col("item").alias("second"))
    return mixed.unionByName(own)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """In how many records each pair occurs."""
    return pairs.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
