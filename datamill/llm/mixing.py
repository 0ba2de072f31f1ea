"""Mixing sources to target weights.

Every document gets a hash-random key. A source's documents stand in the order of their
keys; its budget takes that order round and round, whole epochs first, and the last epoch
is cut at the exact word. The order is cut into equal ranges of the key, so prefix sums
come from range totals and from sums inside each range; no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from datamill.llm.tables import WORD, word_count, written


def targets(sizes: DataFrame, limit: float = 3.0) -> DataFrame:
    """Add `target` to rows of source and source_size: shares of the total by weights 1, 2, 3, 1, …
    in the order of the sources, null last.

    A source stops at `limit` times its size and the excess goes to the others by weight.
    Sources stop in the order of size per weight, so one running pass finds which do.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weighted = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    weighted = weighted.withColumn("most", F.col("source_size") * F.lit(float(limit)))
    rank = [F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source")]
    before = Window.orderBy(*rank).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*rank).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(*rank).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(onward)
    stopped = weighted.withColumn("level", level).withColumn("stops", F.col("most") / F.col("weight") <= level)
    # From the first source that does not stop, all share its level.
    turn = F.row_number().over(Window.orderBy(*rank))
    first = F.min(F.when(~F.col("stops"), F.struct("turn", "level"))).over(everything)
    stopped = stopped.withColumn("turn", turn)
    shared = first["level"]
    return stopped.withColumn("shared", shared).select(
        *sizes.columns,
        F.when(F.col("shared").isNull() | (F.col("most") <= F.col("weight") * F.col("shared")), F.col("most"))
        .otherwise(F.col("weight") * F.col("shared"))
        .alias("target"),
    )


def mix_sources(documents: DataFrame, limit: float = 3.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    `size` counts the words, `taken` those the mix takes, repeats included. The words taken
    of a source add up to its target, cut to a whole word. Keys are hashes of the id, so
    every run takes the same.

    A null text has size 0 and nothing is taken from it; null is a source of its own. A null
    id has one key; documents whose keys tie stand by id, size and text digest, and rows that
    repeat are each counted. An empty table gives no rows. Other columns are ignored.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = documents.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), F.xxhash64("text").alias("print")
    )
    rows = written(rows)
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    # About as many ranges as rows in one, so that neither grows with the whole source.
    ranges = F.greatest(F.lit(1), F.ceil(2 * F.sqrt("n"))).cast("bigint")
    sums = written(sums.withColumn("ranges", ranges))
    plan = written(targets(sums.drop("n"), limit))

    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    keyed = _by_source(rows, plan)
    keyed = keyed.withColumn("range", F.floor(place * F.col("ranges")).cast("bigint")).drop("ranges")
    totals = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("range_size").over(earlier), F.lit(0))).drop("range_size")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "print")
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    summed = keyed.withColumn("end", F.sum("size").over(inside))
    same = summed["source"].eqNullSafe(starts["source"]) & (summed["range"] == starts["range"])
    placed = summed.join(starts, same).select(
        summed["doc_id"], summed["source"], "size", "source_size", "target", (F.col("start") + F.col("end") - F.col("size")).alias("before")
    )
    budget = F.floor(F.col("target") + 1e-6)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + last).cast("bigint").alias("taken")
    )


def _by_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    same = rows["source"].eqNullSafe(plan["source"])
    return rows.join(plan, same).drop(plan["source"])


def copies(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself, in the columns of `documents`: a row per epoch of each document, the
    cut one with the words it gives, joined by one space; n_chars follows the text.

    `mixed` is joined by doc_id and size, so both must come from the same rows.
    """
    docs = documents.withColumn("__size", word_count(F.col("text")))
    plan = mixed.filter("taken > 0").groupBy(F.col("doc_id").alias("__id"), F.col("size").alias("__words"))
    plan = plan.agg(F.max("taken").alias("__taken"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__size") == F.col("__words"))
    rows = docs.join(plan, same).withColumn(
        "__epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("__taken") / F.col("__size")).cast("int")))
    )
    words = F.least(F.col("__size"), F.col("__taken") - (F.col("__epoch") - 1) * F.col("__size"))
    first = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words.cast("int"))
    rows = rows.withColumn("text", F.when(words < F.col("__size"), F.array_join(first, " ")).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return rows.select(*documents.columns)
