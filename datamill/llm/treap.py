"""Ranked lexical search: a K2-treap over the grid of terms and documents.

The grid has a row per query term and a column per document; a cell holds the impact of the
term in the document. It is kept as a quadtree of the cells that are not empty: a node has a
4-bit mask of its children, the place of the first one, and the largest impact below it. An
item descends the paths of all its rows jointly: a range of documents is bounded by the sum
of its rows' maxima times their weights, ranges are opened best first, and a range that
cannot reach the k-th best document so far is never opened.

The documents are read once for the postings of the query terms. Every task then turns its
postings into treaps of a bounded number of cells and gives the best `k` documents of each
item in each; the best of those are the result. Columns stand in order of length, so that a
range holds like impacts. Items are taken in blocks of a bounded number of terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datamill.llm.tables import discard, ship, written
from datamill.operators.ranking import top_per_group

# Rows (item, term) that the driver and every task hold at a time.
BLOCK_TERMS = 1 << 18
# Cells of one treap: about 100 MB with all levels.
TREAP_CELLS = 1 << 20
# Entries (range, term) opened at once, and those that may wait before depth goes first.
OPEN_ENTRIES = 1 << 16
WAIT_ENTRIES = 1 << 24

POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"


def _term_bytes() -> bytes:
    """For each byte its place in a term, A-Z as a-z, or a space. Terms are runs of ASCII
    letters and digits and of all code points from 128 on, whose bytes are 128 and above."""
    return bytes(
        b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
    )


TERM_BYTES = _term_bytes()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


class Treap:
    """Quadtree of cells (row, column, impact); every cell is there once.

    Nodes of all levels stand in one list, node 0 being no node at all; the children of a
    node are neighbours there, in the order of their quadrants.
    """

    ones = np.array([bin(mask).count("1") for mask in range(16)], np.int32)

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray):
        last = max(int(rows.max(initial=0)), int(columns.max(initial=0)))
        self.levels = max(last.bit_length(), 1)
        codes = self._interleaved(rows, columns)
        order = np.argsort(codes)
        codes, most = codes[order], impacts[order].astype(np.int32)
        masks, firsts, mosts = [np.zeros(1, np.uint8)], [np.zeros(1, np.int32)], [np.zeros(1, np.int32)]
        first, mask, size = np.zeros(len(codes), np.int32), np.zeros(len(codes), np.uint8), 1
        for _ in range(self.levels + 1):
            masks.append(mask)
            firsts.append(first)
            mosts.append(most)
            begin = np.flatnonzero(np.diff(codes >> 2, prepend=-1))
            quadrant = np.left_shift(1, codes & 3).astype(np.uint8)
            first = (begin + size).astype(np.int32)
            size += len(codes)
            mask, most, codes = np.bitwise_or.reduceat(quadrant, begin), np.maximum.reduceat(most, begin), codes[begin] >> 2
        self.mask, self.first, self.most = (np.concatenate(x) for x in (masks, firsts, mosts))
        self.root = size - 1

    def _interleaved(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        codes = np.zeros(len(rows), np.int64)
        for bit in range(self.levels):
            codes |= ((rows >> bit & 1) << (2 * bit + 1)) | ((columns >> bit & 1) << (2 * bit))
        return codes

    def children(self, nodes: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The child of each node in a quadrant, 0 where there is none."""
        mask = self.mask[nodes]
        place = self.first[nodes] + self.ones[mask & ((1 << quadrant) - 1)]
        return np.where(mask >> quadrant & 1, place, 0)

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of the `k` best documents with a score above 0, equal scores by
        ascending rank in `ids`."""
        columns, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        inside = rows >> self.levels == 0  # rows beyond the last one that has a cell
        rows, weights = rows[inside], weights[inside]
        if not len(rows):
            return columns, scores
        least = 1  # the lowest bound that can still matter
        level = np.array([self.levels])
        start = np.zeros(1, np.int64)
        nodes = np.full((1, len(rows)), self.root, np.int32)
        bound = np.array([int(self.most[self.root]) * int(weights.sum())])
        at_once = max(1, OPEN_ENTRIES // len(rows))
        while len(bound):
            if len(bound) > at_once:
                first = -bound if nodes.size <= WAIT_ENTRIES else level
                pick = np.argpartition(first, at_once)[:at_once]
            else:
                pick = np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[pick] = False
            below = level[pick] - 1
            row_bit = rows[None, :] >> below[:, None] & 1
            waiting = [(level[rest], start[rest], nodes[rest], bound[rest])]
            for side in (0, 1):
                child = self.children(nodes[pick], 2 * row_bit + side)
                limit = self.most[child].astype(np.int64) @ weights
                at = start[pick] | side << below
                leaf = (below == 0) & (limit >= least)
                if leaf.any():
                    columns, scores = np.append(columns, at[leaf]), np.append(scores, limit[leaf])
                go = (below > 0) & (limit >= least)
                waiting.append((below[go], at[go], child[go], limit[go]))
            if len(scores) > k:
                keep = np.lexsort((ids[columns], -scores))[:k]
                columns, scores = columns[keep], scores[keep]
            if len(scores) == k:
                least = max(least, int(scores.min()))
            level, start, nodes, bound = (np.concatenate(x) for x in zip(*waiting))
            alive = bound >= least
            if not alive.all():
                level, start, nodes, bound = level[alive], start[alive], nodes[alive], bound[alive]
        return columns, scores


class Items(NamedTuple):
    """Items of a block: where each one's rows begin, the rows, and weight times repeats."""

    numbers: np.ndarray
    begins: np.ndarray
    rows: np.ndarray
    weights: np.ndarray


def item_terms(items: DataFrame) -> DataFrame:
    """(item_no, item_id, term, times) for every row of `items` that has a term."""
    ship(items.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [Counter(terms_of(text or b"")) for text in texts]
            sizes = [len(own) for own in found]
            of = pa.array(np.repeat(np.arange(len(texts)), sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_no").take(of), batch.column("item_id").take(of),
                    pa.array([term for own in found for term in own], pa.binary()),
                    pa.array([n for own in found for n in own.values()], pa.int64()),
                ],
                names=["item_no", "item_id", "term", "times"],
            )

    numbered = items.select(
        F.monotonically_increasing_id().alias("item_no"), F.col("item_id").cast("bigint"), F.col("text").cast("binary")
    )
    return numbered.mapInArrow(rows, "item_no long, item_id long, term binary, times long")


def postings(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """A row per document with a term: doc_id, n, its query terms and their occurrences."""
    spark = documents.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in batches:
            sizes, terms, counts, ends = [], [], [], [0]
            for text in batch.column("text"):
                words = terms_of(text.as_py() or b"")
                own = Counter(map(number, words))
                own.pop(None, None)
                sizes.append(len(words))
                terms += own
                counts += own.values()
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(counts, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    read = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return read.mapInArrow(rows, POSTINGS).filter("n > 0")


def _searched(table: DataFrame, items: Items, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best `k` documents of each item in every treap: (item_no, doc_id, score)."""
    sent = table.sparkSession.sparkContext.broadcast(items)

    def found(ids: pa.Array, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        own = sent.value
        # Null ids come last among equal scores.
        rank = np.empty(len(ids), np.int64)
        rank[pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        order = np.lexsort((rank, n))
        column = np.empty(len(ids), np.int64)
        column[order] = np.arange(len(ids))
        length = np.repeat(75 + 25 * n * n_docs // n_terms, sizes)
        impacts = 10**9 * counts // (1000 * counts + 12 * length)
        treap = Treap(terms, np.repeat(column, sizes), impacts)
        picked, scores, numbers = [], [], []
        for i in range(len(own.numbers)):
            part = slice(own.begins[i], own.begins[i + 1])
            columns, values = treap.best(own.rows[part], own.weights[part], k, rank[order])
            picked.append(order[columns])
            scores.append(values)
            numbers.append(np.full(len(values), own.numbers[i]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(numbers)), ids.take(pa.array(np.concatenate(picked))), pa.array(np.concatenate(scores))],
            names=["item_no", "doc_id", "score"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cells = [], 0

        def search() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            terms, counts = whole.column("terms"), whole.column("counts")
            as_long = lambda x: x.to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = as_long(pa.compute.list_value_length(terms))
            return found(whole.column("doc_id"), as_long(whole.column("n")), sizes, as_long(terms.flatten()), as_long(counts.flatten()))

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                held.append(part)
                cells += len(part.column("terms").flatten())
                if cells >= TREAP_CELLS:
                    yield search()
                    held, cells = [], 0
        if cells:
            yield search()

    return table.filter(F.size("terms") > 0).mapInArrow(rows, "item_no long, doc_id long, score long")


def _block(documents: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """Results of the items of one block, written out."""
    spark = documents.sparkSession
    rows = terms.select("item_no", "term", "times").orderBy("item_no", "term").collect()  # at most about BLOCK_TERMS
    vocabulary = {term: i for i, term in enumerate(dict.fromkeys(bytes(row.term) for row in rows))}
    table = written(postings(documents, vocabulary))
    whole = table.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"), F.sum(F.size("terms")).alias("cells")).first()
    frequency = np.zeros(len(vocabulary), np.int64)
    for row in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per query term
        frequency[row.t] = row["count"]
    weight = [math.floor(1000 * math.log((2 * whole.docs + 2) / (2 * int(df) + 1))) for df in frequency]
    numbers, begins = np.unique(np.array([row.item_no for row in rows], np.int64), return_index=True)
    own = np.array([vocabulary[bytes(row.term)] for row in rows], np.int64)
    times = np.array([row.times for row in rows], np.int64)
    items = Items(numbers, np.append(begins, len(rows)), own, np.array(weight, np.int64)[own] * times)
    tasks = max(spark.sparkContext.defaultParallelism, -(-(whole.cells or 0) // TREAP_CELLS))
    found = _searched(table.coalesce(tasks), items, whole.docs, whole.n or 1, k)
    ranked = top_per_group(found, ["item_no"], [F.desc("score"), F.asc_nulls_last("doc_id")], k, "rank")
    out = written(ranked)
    discard(table)
    return out


def rank_documents(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents of each row of `items` with a
    score above 0, highest first, equal scores by ascending doc_id.

    Terms are runs of ASCII letters and digits and code points from 128 on, A-Z in lower case.
    The weight of a term is floor(1000 ln((2N + 2) / (2 df + 1))) over the N documents that
    have a term; a document scores the sum of weight · (10^9 tf div (1000 tf + 12 m)) over the
    item's terms with repeats, m being 75 + (25 n N div L) for its n of all L terms. Texts that
    are null or have no term are no documents, and items without a term have no rows. Repeated
    rows count and are ranked each by itself, in any order among themselves; rows without an
    id come last among equal scores. Texts of any length are read whole. An empty table of
    either kind gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    terms = written(item_terms(items))
    blocks = -(-terms.count() // BLOCK_TERMS)
    found = None
    for block in range(blocks):
        own = terms.filter(F.pmod(F.xxhash64("item_no"), F.lit(blocks)) == block)
        part = _block(documents, own, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    named = found.join(terms.select("item_no", "item_id").distinct(), "item_no")
    return named.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
