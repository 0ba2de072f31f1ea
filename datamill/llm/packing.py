"""Packing of documents into sequences of one length, by conflict-constrained best fit.

Documents are cut into pieces of at most the capacity. Pieces are dealt by hash into groups
of about equal size, and each group is packed by itself: the largest pieces first, each into
the tightest bin that has room and that it does not conflict with. Open bins stand in the
order of what they have left; the search starts at the first that has room and goes on
through its successors until one is compatible.

A bin takes at most `per_source` pieces of a source and one piece of a duplicate cluster.
It carries bit maps for both. Where a group has more than 64 sources or clusters of two or
more pieces, some share a bit: that can keep pieces apart, and never puts a conflict together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datamill.llm.tables import ship, word_count

CAPACITY = 2048
GROUP_PIECES = 8192
LOOK = 256
PACKED = "doc_id long, piece long, start long, size long, source string, cluster long, group long, bin long"


def _bits(keys: np.ndarray) -> np.ndarray:
    """A bit of 64 per key that occurs twice or more, by rank; other keys need none."""
    _, rank, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = np.cumsum(times > 1) - 1
    bit = np.left_shift(np.uint64(1), (again % 64).astype(np.uint64))
    return np.where(times > 1, bit, np.uint64(0))[rank]


def best_fit(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int, per_source: int) -> np.ndarray:
    """The bin of each piece. Pieces come largest first."""
    n = len(sizes)
    left = np.empty(n, np.int64)  # open bins by what they have left, ascending
    bins = np.empty(n, np.int64)
    held = np.zeros((per_source, n), np.uint64)  # plane p: sources with more than p pieces
    copies = np.zeros(n, np.uint64)
    source_bits, cluster_bits = _bits(sources), _bits(clusters)
    out = np.empty(n, np.int64)
    open_, made = 0, 0
    for i in range(n):
        size, source, cluster = sizes[i], source_bits[i], cluster_bits[i]
        at = int(np.searchsorted(left[:open_], size))
        found = -1
        while at < open_:
            stop = min(at + LOOK, open_)
            free = ((held[per_source - 1, at:stop] & source) == 0) & ((copies[at:stop] & cluster) == 0)
            first = int(free.argmax())
            if free[first]:
                found = at + first
                break
            at = stop
        if found < 0:
            number, room, planes, marks = made, capacity, np.zeros(per_source, np.uint64), np.uint64(0)
            made += 1
        else:
            number, room, planes, marks = bins[found], left[found], held[:, found].copy(), copies[found]
            for array in (left, bins, copies):
                array[found : open_ - 1] = array[found + 1 : open_]
            held[:, found : open_ - 1] = held[:, found + 1 : open_]
            open_ -= 1
        out[i] = number
        room -= size
        if room > 0:
            for p in range(per_source):
                if not planes[p] & source:
                    planes[p] |= source
                    break
            to = int(np.searchsorted(left[:open_], room))
            for array, value in ((left, room), (bins, number), (copies, marks | cluster)):
                array[to + 1 : open_ + 1] = array[to:open_]
                array[to] = value
            held[:, to + 1 : open_ + 1] = held[:, to:open_]
            held[:, to] = planes
            open_ += 1
    return out


def _pack(capacity: int, per_source: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("piece", "ascending")])
        sizes = table["size"].to_numpy()
        sources = table["source"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        bins = best_fit(sizes, sources, table["cluster"].to_numpy(), capacity, per_source)
        return table.append_column("bin", pa.array(bins, pa.int64()))

    return pack


def pack_documents(
    documents: DataFrame, capacity: int = CAPACITY, per_source: int = 2, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """One row per piece: doc_id, piece, start, size, source, cluster, group, bin.

    `size` and `start` count words; the pieces of a document tile it in order. A bin is
    named by `group` and `bin` and holds at most `capacity` words. Documents of equal text
    are a cluster, as are the pieces of one document.

    A document without words (null or empty text) has one piece of size 0, which takes no
    room and is put in a bin like any other. Null sources are one source. Rows that repeat
    are copies of each other. A null id stays null. An empty table gives no rows. Other
    columns are ignored.
    """
    ship(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "source",
        word_count(F.col("text")).alias("words"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("cluster"),
    )
    last = F.greatest(F.lit(0), F.ceil(F.col("words") / capacity) - 1).cast("bigint")
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).select(
        "doc_id",
        "piece",
        (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity).cast("bigint").alias("size"),
        "source",
        "cluster",
    )
    groups = max(1, -(-documents.count() // (group_pieces // 2)))
    # A piece's group follows its id and place, so a large source or cluster is spread evenly.
    group = F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(groups))
    return pieces.withColumn("group", group).groupBy("group").applyInArrow(_pack(capacity, per_source), PACKED)
