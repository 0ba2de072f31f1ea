"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Every document becomes a sparse vector over the words of the examples, with document
frequencies of the whole corpus. The examples stand in a block-max inverted index: words
that few examples hold have plain postings, the most frequent ones have postings in blocks
of examples, each block with its maxima. Documents come in batches. The plain postings are
summed, and a block is opened for those documents of a batch that its maxima could still
give one of their nearest examples, so the neighbours are exact.

Votes are weighted by nearness, where a shared word counts by how far its shares among toxic
and other examples differ, and by the sampling of the classes. A monotone curve fitted to
votes that leave the own example out turns them into probabilities.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datamill.llm.tables import discard, ship, written

WORD = re.compile(r"[^\W\d_]+")
LONG_TEXT = 100_000
# Words with postings in blocks, examples in a block, documents in a batch.
FREQUENT, BLOCK, BATCH = 512, 32, 64
# Products of the block postings are single precision; what lies this near is taken as equal
# until it is measured in full.
SLACK = 1e-5
# Chance alone reaches this chi-square in about one of a million words: half of the full weight.
# A word of even shares has 1/48 of it.
HALF_CHI, EVEN_CHI = 24.0, 0.5
PRIOR_WEIGHT = 1e-6
LEAST_EXAMPLES = 8
KNOWN_VECTORS = 4096


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents is kept from training, by their id; no id, not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def _words(text: str | None) -> Iterable[str]:
    """Words in lower case; those of a long text one by one, so no list of them is held."""
    if not text:
        return ()
    text = text.lower()
    return WORD.findall(text) if len(text) < LONG_TEXT else (m[0] for m in WORD.finditer(text))


def _example_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [len(set(_words(text.as_py()))) for text in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["print"], pa.array(sizes, pa.int64())], names=["print", "n"])


def _example_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"].to_pylist()):
            own = list(set(_words(text.as_py())))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([toxic] * len(own), pa.int32())], names=["term", "toxic"])


class Vocabulary:
    """Words by number. They travel as one Arrow array; the dictionary is made in the worker
    that looks words up, so the driver never holds it."""

    def __init__(self, words: pa.Array) -> None:
        self.words = words

    def __getstate__(self) -> dict:
        return {"words": self.words}

    def __setstate__(self, state: dict) -> None:
        self.numbers = {word: i for i, word in enumerate(state["words"].to_pylist())}


def _vector(text: str | None, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Known words of a text by number, and how often each occurs."""
    found = Counter(_words(text))
    terms = np.fromiter(map(vocabulary.get, found, repeat(-1)), np.int32, len(found))
    times = np.fromiter(found.values(), np.int32, len(found))
    order = np.argsort(terms, kind="stable")[np.count_nonzero(terms < 0) :]
    return terms[order], times[order]


def _example_vectors(vocabulary: Broadcast):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_vector(text.as_py(), vocabulary.value.numbers) for text in batch["text"]]
            terms, times = (pa.array([v[i].tobytes() for v in own], pa.binary()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], terms, times], names=["doc_id", "toxic", "terms", "times"])

    return make


def _frequencies(vocabulary: Broadcast):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.numbers
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for text in batch["text"]:
                held = [known[w] for w in set(_words(text.as_py())) if w in known]
                total[held] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "n"])

    return count


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places start, start + 1, … of n each, one after another."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def _digest(terms: bytes, times: bytes) -> bytes:
    return hashlib.blake2b(terms + times, digest_size=16).digest()


class Index:
    """Labelled examples in a block-max inverted index.

    Examples are (id, toxic, terms, times). Those of equal vectors are one row that carries
    the weight of all; rows stand in the order of a digest of the vector, which also decides
    ties. `idf` and `telling` have a weight per term: of the cosine, and of a vote.
    """

    def __init__(self, examples, idf: np.ndarray, telling: np.ndarray, rates: dict[int, float], neighbours: int) -> None:
        self.idf, self.telling, self.k = idf, telling, neighbours
        rows: dict[bytes, list] = {}
        for doc, toxic, terms, times in examples:
            if len(terms):
                rows.setdefault(_digest(terms.tobytes(), times.tobytes()), []).append((doc, toxic, terms, times))
        self.digests = sorted(rows)
        # An example of a class that was sampled stands for 1 / rate documents.
        self.weight, self.toxic, self.own, self.ids = np.zeros(len(rows)), np.zeros(len(rows)), {}, []
        terms, times = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        for row, digest in enumerate(self.digests):
            for doc, toxic, _, _ in rows[digest]:
                self.weight[row] += 1 / rates[toxic]
                self.toxic[row] += toxic / rates[toxic]
                mine = self.own.get((doc, row), (0.0, 0.0))
                self.own[doc, row] = (mine[0] + 1 / rates[toxic], mine[1] + toxic / rates[toxic])
            self.ids.append(min(doc for doc, *_ in rows[digest]))
            terms.append(rows[digest][0][2])
            times.append(rows[digest][0][3])
        whole = sum(1 / rates[y] for _, y, _, _ in examples)
        self.prior = sum(y / rates[y] for _, y, _, _ in examples) / whole if whole else 0.0
        # A few examples without any word are no ground to reject what has none.
        none = [(1 / rates[y], y / rates[y]) for _, y, t, _ in examples if not len(t)]
        self.unknown = sum(y for _, y in none) / (sum(n for n, _ in none) + LEAST_EXAMPLES)
        self.first = np.cumsum([0, *(len(t) for t in terms[1:])])
        self.terms, self.times = np.concatenate(terms), np.concatenate(times)
        # Filled where it is searched: the driver only sends it.
        self.blocks = None

    def _fill(self) -> None:
        n, held = len(self.digests), np.bincount(self.terms, minlength=len(self.idf))
        w = (1 + np.log(self.times)) * self.idf[self.terms]
        row = np.repeat(np.arange(n), np.diff(self.first))
        self.values = w / np.sqrt(np.bincount(row, w * w, n))[row] if n else w
        frequent = np.argsort(-held, kind="stable")[:FREQUENT]
        self.column = np.full(len(self.idf), -1, np.int32)
        self.column[frequent] = np.arange(len(frequent))
        inside = self.column[self.terms] >= 0
        blocks = -(-n // BLOCK)
        dense = np.zeros((blocks * BLOCK, len(frequent)), np.float32)
        dense[row[inside], self.column[self.terms[inside]]] = self.values[inside]
        # Like examples share a block, so that its maxima say more.
        order = np.concatenate([self._alike(dense[:n]), np.arange(n, blocks * BLOCK)])
        self.blocks = dense[order].reshape(blocks, BLOCK, len(frequent))
        # The same in full precision, for the few examples that are measured.
        self.exact = np.zeros((n, len(frequent)))
        self.exact[row[inside], self.column[self.terms[inside]]] = self.values[inside]
        self.maxima = self.blocks.max(axis=1) if n else np.zeros((0, len(frequent)), np.float32)
        self.row_at = order
        self.place = place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_term = np.argsort(self.terms[~inside], kind="stable")
        self.posting_place = place[row[~inside]][by_term].astype(np.int32)
        self.posting = self.values[~inside][by_term]
        self.start = np.searchsorted(self.terms[~inside][by_term], np.arange(len(self.idf) + 1))

    @staticmethod
    def _alike(dense: np.ndarray, centres: int = 32) -> np.ndarray:
        """Rows grouped by a few rounds of spherical k-means; only speed hangs on it."""
        if len(dense) <= centres:
            return np.arange(len(dense))
        middle = dense[np.linspace(0, len(dense) - 1, centres).astype(int)]
        for _ in range(4):
            group = np.argmax(dense @ (middle / (np.linalg.norm(middle, axis=1, keepdims=True) + 1e-9)).T, axis=1)
            middle = np.stack([dense[group == j].mean(axis=0) if (group == j).any() else middle[j] for j in range(centres)])
        return np.lexsort((np.linalg.norm(dense, axis=1), group))

    def __getstate__(self) -> dict:
        """Only what the rest follows from travels."""
        kept = ("idf", "telling", "k", "digests", "weight", "toxic", "own", "ids", "prior", "unknown", "first", "terms", "times")
        return {name: getattr(self, name) for name in kept}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._fill()

    def weights(self, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        w = (1 + np.log(times)) * self.idf[terms]
        return w / np.sqrt((w * w).sum()) if len(w) else w

    def _kth(self, sums: np.ndarray) -> np.ndarray:
        """The k + 1 st largest of each line: one more than k, as the own example may be among them."""
        if sums.shape[1] <= self.k + 1:
            return np.zeros(len(sums))
        return np.partition(sums, -self.k - 1, axis=1)[:, -self.k - 1]

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per query rows, cosines and telling parts of the cosines of the k + 1 nearest
        examples, all cosines above zero; ties go to the first in order of the digests."""
        if not self.digests or not queries:
            return [(np.empty(0, np.int64), np.empty(0), np.empty(0))] * len(queries)
        if self.blocks is None:
            self._fill()
        weights = [self.weights(*q) for q in queries]
        frequent = np.zeros((len(queries), self.blocks.shape[2]), np.float32)
        plain, telling = np.zeros((2, len(queries), len(self.row_at)))
        for i, (terms, _) in enumerate(queries):
            column = self.column[terms]
            inside = column >= 0
            frequent[i, column[inside]] = weights[i][inside]
            rare, w = terms[~inside], weights[i][~inside]
            n = self.start[rare + 1] - self.start[rare]
            at = _ranges(self.start[rare], n)
            at_place, value = self.posting_place[at], self.posting[at]
            plain[i] = np.bincount(at_place, np.repeat(w, n) * value, plain.shape[1])
            telling[i] = np.bincount(at_place, np.repeat(w * self.telling[rare], n) * value, plain.shape[1])
        sums = plain.copy()
        most = sums.reshape(len(queries), -1, BLOCK).max(axis=2) + frequent @ self.maxima.T + SLACK

        def visit(todo: np.ndarray) -> None:
            for b in np.flatnonzero(todo.any(axis=0)):
                q = np.flatnonzero(todo[:, b])
                sums[q, b * BLOCK : (b + 1) * BLOCK] += frequent[q] @ self.blocks[b].T

        lead = min(most.shape[1], 2 * (self.k + 1) // BLOCK + 1)
        opened = most >= np.partition(most, -lead, axis=1)[:, -lead, None]
        visit(opened)
        visit(~opened & (most >= self._kth(sums)[:, None]))
        least = self._kth(sums) - SLACK
        found = []
        for i, (terms, _) in enumerate(queries):
            rows = np.sort(self.row_at[np.flatnonzero((sums[i] >= least[i]) & (sums[i] > 0))])
            column = self.column[terms]
            inside = column >= 0
            shared = self.exact[rows[:, None], column[inside]] * weights[i][inside]
            cosines = np.round(plain[i, self.place[rows]] + shared.sum(axis=1), 12)
            order = np.lexsort((rows, -cosines))[: self.k + 1]
            told = telling[i, self.place[rows[order]]] + shared[order] @ self.telling[terms[inside]]
            found.append((rows[order], cosines[order], told))
        return found

    def without(self, doc, found: tuple[np.ndarray, np.ndarray, np.ndarray], digest: bytes) -> tuple[np.ndarray, ...]:
        """The k neighbours, their weights and toxic weights, without the own label of `doc`."""
        rows, cosines, telling = found
        weight, toxic = self.weight[rows], self.toxic[rows]
        for i, row in enumerate(rows):
            if cosines[i] < 1 - 1e-9:
                break
            mine = self.own.get((doc, int(row)))
            if mine is not None and self.digests[row] == digest:
                weight[i] -= mine[0]
                toxic[i] -= mine[1]
        left = np.flatnonzero(weight > 1e-9)[: self.k]
        return rows[left], cosines[left], telling[left], weight[left], np.maximum(toxic[left], 0.0)

    def vote(self, cosines: np.ndarray, telling: np.ndarray, weight: np.ndarray, toxic: np.ndarray) -> float:
        """Toxic share of the neighbours by nearness; ones that tell little leave it near the prior."""
        near = telling**2 / (0.1 + np.sqrt(np.maximum(0, 2 - 2 * cosines)))
        return float(((near * toxic).sum() + PRIOR_WEIGHT * self.prior) / ((near * weight).sum() + PRIOR_WEIGHT))


def _curve(votes: list[tuple[float, int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """A rising curve from left-out (vote, toxic, weight) to shares of toxic examples."""
    if not votes:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    rows = np.array(sorted(votes))
    pools: list[list[float]] = []  # vote, toxic, weight, examples
    for g in np.array_split(rows, max(1, min(40, len(rows) // LEAST_EXAMPLES))):
        pools.append([float((g[:, 0] * g[:, 2]).sum()), float((g[:, 1] * g[:, 2]).sum()), float(g[:, 2].sum())])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    # Two more that are not toxic: an example or two are no ground to reject a document.
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / (p[2] + 2) for p in pools])


def _voted(index: Index, rows: Iterable[tuple], known: dict) -> Iterator[tuple[float | None, np.ndarray, np.ndarray]]:
    """Vote, neighbours and cosines of each (doc_id, terms, times), in order; no vote where
    no example shares a word. Equal vectors are searched once while `known` holds them."""
    rows = [(doc, terms, times, _digest(terms.tobytes(), times.tobytes())) for doc, terms, times in rows]
    new = {digest: (terms, times) for _, terms, times, digest in rows if digest not in known}
    if len(known) > KNOWN_VECTORS:
        known.clear()
        new = {digest: (terms, times) for _, terms, times, digest in rows}
    known.update(zip(new, index.nearest(list(new.values()))))
    for doc, _, _, digest in rows:
        own, cosines, telling, weight, toxic = index.without(doc, known[digest], digest)
        yield (index.vote(cosines, telling, weight, toxic) if len(own) else None), own, cosines


def _left_out(index: Broadcast):
    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for part in (batch.slice(i, BATCH) for i in range(0, len(batch), BATCH)):
                rows = zip(part["doc_id"].to_pylist(), part["terms"].to_pylist(), part["times"].to_pylist())
                rows = [(d, np.frombuffer(t, np.int32), np.frombuffer(n, np.int32)) for d, t, n in rows]
                found = [v for v, _, _ in _voted(index.value, rows, known)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), part["toxic"]], names=["vote", "toxic"])

    return votes


class Model:
    """Vocabulary and index, sent to each Python worker once, and the curve of the votes."""

    def __init__(self, vocabulary: Broadcast, index: Broadcast, curve: tuple[np.ndarray, np.ndarray]) -> None:
        self.vocabulary, self.index, self.curve = vocabulary, index, curve

    def scored(self, ids: pa.Array, texts: pa.Array, known: dict) -> Iterator[tuple[float, list[int], list[float]]]:
        """Score, evidence and cosines of each text of a batch."""
        index, vocabulary = self.index.value, self.vocabulary.value.numbers
        for at in range(0, len(ids), BATCH):
            rows = [(d.as_py(), *_vector(t.as_py(), vocabulary)) for d, t in zip(ids[at : at + BATCH], texts[at : at + BATCH])]
            for vote, own, cosines in _voted(index, rows, known):
                value = index.unknown if vote is None else float(np.clip(np.interp(vote, *self.curve), 0, 1))
                yield value, [index.ids[r] for r in own], cosines.tolist()


def train(
    documents: DataFrame,
    labels: DataFrame,
    per_class: int = 4096,
    neighbours: int = 50,
    postings: int = 1 << 21,
) -> Model:
    """A model over all words of the examples, with document frequencies of all documents.

    Trains on labelled documents that are not held out, at most about `per_class` of each
    class, taken by a hash of the id; all of a smaller class. Where these hold more than
    `postings` different words, counted per example, examples are taken in the order of a
    hash of their texts as they fit. So the index, and all that reaches the driver, is
    bounded by these two numbers.
    """
    spark = documents.sparkSession
    ship(spark)
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id"))).distinct()
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    rates = {y: min(1.0, per_class / max(1, sizes.get(y, 0))) for y in (0, 1)}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("example")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(draw < F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0]))
    joined = docs.join(F.broadcast(sample), "doc_id").distinct()  # bounded by 2 · per_class ids
    table = chosen = written(joined.withColumn("print", F.xxhash64("text")))

    room, fit, short = postings, [], False
    for r in sorted(chosen.mapInArrow(_example_sizes, "print long, n long").collect()):
        if r.n <= room:
            room -= r.n
            fit.append((r.print,))
        else:
            short = True
    if short:
        chosen = chosen.join(F.broadcast(spark.createDataFrame(fit, "print long").distinct()), "print", "left_semi")

    totals = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    n1, n0 = max(1, totals.get(1, 0)), max(1, totals.get(0, 0))
    words = chosen.select("text", "toxic").mapInArrow(_example_words, "term string, toxic int")
    words = words.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("c"))
    found = words.toArrow().sort_by("term")  # at most `postings` words
    vocabulary = spark.sparkContext.broadcast(Vocabulary(found["term"].combine_chunks()))
    a, c = found["a"].to_numpy().astype(float), found["c"].to_numpy().astype(float)
    del found
    cross, held = a * (n0 - c) - c * (n1 - a), a + c
    chi = cross * cross * (n1 + n0) / (held * np.maximum(n1 + n0 - held + 0.5, 0.5) * n1 * n0)

    total = docs.count()
    counted = docs.select("text").mapInArrow(_frequencies(vocabulary), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(len(a))
    frequency[counted["term"].to_numpy()] = counted["n"].to_numpy()
    idf = np.log((1 + total) / (1 + frequency)) + 1

    own = chosen.select("doc_id", "text", "toxic").mapInArrow(_example_vectors(vocabulary), "doc_id long, toxic int, terms binary, times binary")
    own = written(own.distinct())
    examples = [(r.doc_id, r.toxic, np.frombuffer(r.terms, np.int32), np.frombuffer(r.times, np.int32)) for r in own.toLocalIterator()]
    index = Index(examples, idf, (chi + EVEN_CHI) / (chi + HALF_CHI), rates, neighbours)
    del examples
    shared = spark.sparkContext.broadcast(index)
    del index
    pa.default_memory_pool().release_unused()
    cores = spark.sparkContext.defaultParallelism
    votes = own.repartition(4 * cores).mapInArrow(_left_out(shared), "vote double, toxic int").collect()  # two numbers an example
    curve = _curve([(r.vote, r.toxic, 1 / rates[r.toxic]) for r in votes if r.vote is not None])
    discard(table, own)
    return Model(vocabulary, shared, curve)


SCORES = "doc_id long, held_out boolean, score double, predicted int, evidence array<bigint>, cosines array<double>"


def toxicity_scores(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings: int) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence, cosines.

    `evidence` has the ids of the nearest examples, the smallest one for examples of equal
    words, and `cosines` their nearness. Document frequencies cover all documents; `settings`
    are those of `train`. A document that is an example itself is scored without its own label.

    A null or empty text, or one that shares no word with an example, gets the toxic share among
    examples without words, held low where those are few. Without any usable label every score
    is 0. Null labels and ids are no examples; a document with both labels counts as two; rows
    that repeat are each scored. Long texts are read whole, word by word. Examples equally near
    are taken in the order of a digest of their words. An empty table gives no rows. Other
    columns are ignored.
    """
    model = train(documents, labels, **settings)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            found = list(model.scored(batch["doc_id"], batch["text"], known))
            value = [f[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], batch["held_out"], pa.array(value, pa.float64()),
                    pa.array([int(v >= threshold) for v in value], pa.int32()),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(pa.float64())),
                ],
                names=["doc_id", "held_out", "score", "predicted", "evidence", "cosines"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(score, SCORES)


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings: int) -> DataFrame:
    """`documents`, all their columns, without those that score the threshold or more.

    Scores, and what nulls, repeats, long texts, ties and empty tables give, are those of
    `toxicity_scores`. Columns of any name are passed on as they are.
    """
    model = train(documents, labels, **settings)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            ids = batch["doc_id"].cast(pa.int64())
            yield batch.filter(pa.array([s < threshold for s, _, _ in model.scored(ids, batch["text"], known)], pa.bool_()))
        # The worker lives on; the next stage needs the memory.
        pa.default_memory_pool().release_unused()

    return documents.mapInArrow(keep, documents.schema)
