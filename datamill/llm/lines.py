"""Lines found in many documents, dropped everywhere but in the last document that holds them.

Every line becomes a narrow row: the hash of its key, its document and its position; texts do
not travel. The rows are ranged by hash and sorted by hash, document (largest first) and
position, and one pass over that order finds the documents of a hash as they first occur: the
first is the one that keeps the line, and a third one shows that it is found often enough. A
hash that holds more than a 256th of all rows goes another way: its documents are reduced
where they are read, and one row for each of these at most 256 hashes is sent to every task.

The result is no text but a compressed bit map per document: words of 64 lines each, only
those in which a line goes. `kept_text` applies it. Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datamill.llm.tables import parts, written
from datamill.operators.skew import hot_keys

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_BITS = 64


def _print(text: Column) -> Column:
    """With the id it names a row; rows equal in both have equal bit maps."""
    return F.xxhash64(text)


def _hashed_lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, print, pos) of every line whose key has `min_chars` code points or more.

    Two 64-bit hashes of the key stand for it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # A-Z only: other letters keep their case. An ASCII text has no other letters.
    lower = F.when(F.length("text") == F.octet_length("text"), F.lower("text")).otherwise(
        F.translate("text", UPPER, LOWER)
    )
    rows = documents.select(F.col("doc_id").alias("doc"), text.alias("text"))
    rows = rows.filter(F.length("text") >= min_chars).select(
        "doc", _print(F.col("text")).alias("print"), F.posexplode(F.split(lower, "\n", -1)).alias("pos", "line")
    )
    rows = rows.select("doc", "print", "pos", F.btrim("line", F.lit(SPACES)).alias("key"))
    keyed = rows.filter(F.length("key") >= min_chars)
    return keyed.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "print", "pos"
    )


def _dropped(lines: DataFrame, min_docs: int) -> DataFrame:
    """(doc, print, pos) of the lines that go; `lines` is a written table."""
    hot = hot_keys(lines, "h1", small_table=0)
    is_hot = F.col("h1").isin(hot) if hot else F.lit(False)

    ranged = lines.filter(~is_hot).repartitionByRange(parts(lines.sparkSession), "h1", "h2")
    order = [F.col("h1"), F.col("h2"), F.desc_nulls_last("doc"), F.col("pos")]
    ranged = ranged.sortWithinPartitions(*order)
    # The range holds all rows of a hash and the order is the window's: nothing moves again.
    same = Window.partitionBy("h1", "h2")
    # Documents of a hash as they first occur: number one is the largest.
    seen = ranged.withColumn("nth", F.dense_rank().over(same.orderBy(F.desc_nulls_last("doc"))))
    often = seen.withColumn("docs", F.max("nth").over(same))
    cold = often.filter((F.col("docs") >= min_docs) & (F.col("nth") > 1)).select("doc", "print", "pos")
    if not hot:
        return cold

    # Null ids are one document, the smallest.
    own = lines.filter(is_hot).select("h1", "h2", "doc").groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
    reduced = own.groupBy("h1", "h2").agg(F.max("doc").alias("last"), F.count(F.lit(1)).alias("docs"))
    # One row for each hot hash.
    winners = F.broadcast(reduced.filter(F.col("docs") >= min_docs).drop("docs"))
    held = lines.filter(is_hot).join(winners, ["h1", "h2"]).filter(~F.col("doc").eqNullSafe(F.col("last")))
    return cold.unionByName(held.select("doc", "print", "pos"))


def line_bitmaps(documents: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per document that loses lines: (doc_id, print, dropped), `dropped` being the
    words of its bit map that are not empty, as (word, bits); bit i of word w is line 64w+i.

    A line's key is the line without ASCII white space at both ends and with A-Z lower-cased.
    Keys of `min_chars` code points in `min_docs` documents or more lose all their lines but
    those in the largest doc_id. A null text is empty. Rows that share a doc_id are one
    document for the count and keep or lose a line together; all rows without an id are one
    document, smaller than any other. Texts and lines of any length are taken whole. An empty
    table gives no rows. Other columns are ignored.
    """
    lines = written(_hashed_lines(documents.select("doc_id", "text"), min_chars))
    word, bit = F.shiftright("pos", 6).alias("word"), F.col("pos").bitwiseAND(F.lit(WORD_BITS - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = _dropped(lines, min_docs).groupBy("doc", "print", word).agg(F.bit_or(mask).alias("bits"))
    maps = words.groupBy("doc", "print").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))
    return maps.withColumnRenamed("doc", "doc_id")


def n_dropped(dropped: Column) -> Column:
    """Lines that a bit map drops; null drops none."""
    ones = F.transform(dropped, lambda w: F.bit_count(w["bits"]))
    return F.coalesce(F.aggregate(ones, F.lit(0), lambda total, n: total + n), F.lit(0)).cast("bigint")


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines that a bit map keeps, joined by line feeds; a null map keeps all."""
    text = F.coalesce(text, F.lit(""))
    words = F.map_from_entries(dropped)
    bits = lambda i: F.coalesce(F.element_at(words, F.shiftright(i, 6)), F.lit(0).cast("bigint"))
    bit = lambda i: F.call_function("shiftright", bits(i), i.bitwiseAND(F.lit(WORD_BITS - 1)))
    kept = F.filter(F.split(text, "\n", -1), lambda _, i: bit(i).bitwiseAND(F.lit(1).cast("bigint")) == 0)
    return F.when(dropped.isNull(), text).otherwise(F.array_join(kept, "\n"))


def drop_common_lines(documents: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per row of `documents`: doc_id, n_lines (before dropping), n_dropped, the
    bit map `dropped` (null: all lines stay) and kept_text.

    Rows as in `line_bitmaps`; repeated rows have a row each, a null text has one empty line.
    """
    maps = line_bitmaps(documents, min_chars, min_docs)
    maps = maps.select(F.col("doc_id").alias("of"), F.col("print").alias("own"), "dropped")
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    mine = F.col("doc_id").eqNullSafe(F.col("of")) & (_print(F.col("text")) == F.col("own"))
    return docs.join(maps, mine, "left").select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines"),
        n_dropped(F.col("dropped")).alias("n_dropped"),
        "dropped",
        kept_text(F.col("text"), F.col("dropped")).alias("kept_text"),
    )
