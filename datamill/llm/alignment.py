"""Alignment of two tokenizers' tokens by the byte offsets where both end a token.

A is a byte-level BPE with character offsets, B a BPE over pieces with byte fallback whose
proto carries the span of every piece. Spans are coarse cuts: where one covers exactly the
bytes of its token, its end is the token's end. Where a character is split over several
tokens, the spans cannot tell them apart, and the decoded bytes of the tokens refine it.

Neither tokenizer joins symbols over a space that follows no white space (`Aligner` makes
sure of that from the piece list, and takes whole texts where it does not hold), so a text
falls into units there, both tokenizers end a token at each of those cuts, and a unit found
again is looked up. New units are tokenized together, as one text whose cuts they are, and a
task keeps the units it met, at most twice `memo` and those of one batch.

One pass over the texts writes, for each document, its counts, the digest of its groups and
how often it links which pair of ids; sums per pair and the highest per id of B are made from
that table, and texts are not read again.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from datamill.llm.tables import discard, ship, written
from datamill.operators.skew import lookup

TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_MARK = "▁"
# Pairs that are sent to every task: about 100 MB there. More are joined by a shuffle.
BROADCAST_PAIRS = 1 << 21
# Units of a batch are gathered from so many bytes of text; a longer text is a batch.
BATCH_BYTES = 4 << 20
MEMO_UNITS = 200_000
# Units are encoded as texts of about so many characters.
JOIN_CHARS = 1 << 13
# Longer units hardly come again.
MEMO_CHARS = 48

# Tokens of A and of B, groups, their part of the digest, links as 64-bit numbers.
Unit = tuple[int, int, int, str, bytes]

# A space that follows no white space begins a unit, but for a last one of the text.
UNIT = re.compile(r" (?:[^ ]+|(?<=\s) | \Z)*")

ALIGNED = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<bigint>, times array<int>"


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256, 257, …"""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class _Numbers(dict):
    """Numbers its keys as they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Aligner:
    """Both tokenizers with their token bytes, and the units found before."""

    def __init__(self, byte_level: str, pieces: str, memo: int = MEMO_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        back = _byte_of_char()
        special = self.a.get_added_tokens_decoder()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if i in special else bytes(back[c] for c in token)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(name[3:-1], 16)]) if self.b.is_byte(i) else name.replace(SPACE_MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in own]) for own in (self.a_bytes, self.b_bytes))
        # What a token adds to the digest: its id and the mark behind it.
        self.names = np.array(
            [f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"]
            + [f"{i}{mark}" for i in range(len(self.b_bytes)) for mark in ",;"],
            dtype=object,
        )
        crossing = any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", name) for name in names)
        self.unit = re.compile(r"(?s).+") if crossing else UNIT
        self.memo = memo
        self.new: dict[str, Unit | None] = {}
        self.old: dict[str, Unit | None] = {}

    @staticmethod
    def ends(begin: np.ndarray, end: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Byte ends of tokens from their byte spans and the lengths of their bytes.

        A span as long as its token is exact. Other tokens are parts of a character: they end
        as many bytes after the last exact end as they and the tokens between have.
        """
        exact = end - begin == lengths
        if exact.all():
            return end
        decoded = np.cumsum(lengths)
        last = np.maximum.accumulate(np.where(exact, np.arange(len(end)), -1))
        base = np.where(last >= 0, end[last] - decoded[last], 0)
        return base + decoded

    def _joined(self, units: list[str]) -> list[Unit] | None:
        """The alignments of units that follow each other in one text; None where the bytes
        of either tokenizer differ from it."""
        text = "".join(units)
        raw = text.encode()
        a = self.a.encode(text, add_special_tokens=False)
        # B adds the first space itself, and its spans do not count it.
        b = self.b.encode(text[1:], return_type="proto", num_threads=1).pieces
        a_ids, b_ids = a.ids, [piece.id for piece in b]
        if b"".join([self.a_bytes[i] for i in a_ids]) != raw or b"".join([self.b_bytes[i] for i in b_ids]) != raw:
            return None
        a_ids, b_ids = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        spans = np.array(a.offsets, np.int64).reshape(-1, 2)
        sizes = np.array([len(unit) for unit in units])
        if len(raw) != len(text):
            # The offsets of A count characters; UTF-8 begins one at each byte but 10xxxxxx.
            byte_of = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))
            spans = byte_of[spans]
            unit_ends = byte_of[np.cumsum(sizes)]
        else:
            unit_ends = np.cumsum(sizes)
        a_ends = self.ends(spans[:, 0], spans[:, 1], self.a_lengths[a_ids])
        begin = np.array([piece.begin for piece in b], np.int64) + 1
        begin[0] = 0
        b_ends = self.ends(begin, np.array([piece.end for piece in b], np.int64) + 1, self.b_lengths[b_ids])

        # No token is without bytes, so each side ends one token at a common offset.
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        a_last, b_last = cuts[a_group] == a_ends, cuts[b_group] == b_ends
        links = a_ids[a_last] * len(self.b_bytes) + b_ids[b_last]
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        codes = np.concatenate([2 * a_ids + a_last, 2 * (len(self.a_bytes) + b_ids) + b_last])
        names = self.names[codes[order]].tolist()

        # Units end at cuts, as neither side joins symbols over them.
        stops = [np.searchsorted(ends, unit_ends, side="right") for ends in (a_ends, b_ends, cuts)]
        n_a, n_b, n_groups = (np.diff(stop, prepend=0).tolist() for stop in stops)
        out, token = [], 0
        for k, (x, y, n, stop) in enumerate(zip(n_a, n_b, n_groups, stops[2].tolist())):
            out.append((x, y, n, "".join(names[token : token + x + y]), links[stop - n : stop].tobytes()))
            token += x + y
        return out

    def _encoded(self, units: list[str]) -> Iterator[Unit | None]:
        """The alignment of each unit, in order. Units that end in white space stand alone,
        as a space behind them would be no cut; so do those of a text that fails as a whole."""
        some, size = [], 0
        for unit in [*units, ""]:
            if some and (not unit or size + len(unit) > JOIN_CHARS or some[-1][-1].isspace()):
                found = self._joined(some)
                if found is None and len(some) > 1:
                    found = [one[0] if (one := self._joined([u])) else None for u in some]
                yield from found or [None]
                some, size = [], 0
            some.append(unit)
            size += len(unit)

    def align(self, units: list[str]) -> list[Unit | None]:
        """The alignment of each different unit, from the memo or made now."""
        new, old = self.new, self.old
        out = [new.get(unit, 0) for unit in units]
        fresh = []
        for k, unit in enumerate(units):
            if out[k] == 0:
                if unit in old:
                    out[k] = new[unit] = old[unit]
                else:
                    fresh.append(k)
        for k, found in zip(fresh, self._encoded([units[k] for k in fresh])):
            out[k] = found
            if len(units[k]) <= MEMO_CHARS:
                new[units[k]] = found
        if len(new) > self.memo:  # units not met for a whole round go
            self.old, self.new = new, {}
        return out

    def documents(self, texts: list[str | None]) -> tuple[list[list], np.ndarray, np.ndarray, np.ndarray]:
        """Columns n_a, n_b, n_groups, n_links and digest of the texts; where the pairs of
        each begin, the linked pairs, and how often each is linked there."""
        numbers = _Numbers()
        own = [list(map(numbers.__getitem__, self.unit.findall(" " + text))) if text else [] for text in texts]
        found = self.align(list(numbers))
        bad = {k for k, unit in enumerate(found) if unit is None}
        if bad:
            own = [[] if not bad.isdisjoint(units) else units for units in own]
            found = [unit or (0, 0, 0, "", b"") for unit in found]
        flat = np.fromiter(chain.from_iterable(own), np.int64)
        text_of = np.repeat(np.arange(len(own)), [len(units) for units in own])
        counts = np.array([unit[:3] for unit in found], np.int64).reshape(-1, 3)
        sums = [np.bincount(text_of, counts[flat, c], len(own)).astype(np.int64).tolist() for c in range(3)]
        names = [unit[3] for unit in found]
        digests = [
            hashlib.sha256("".join([names[k] for k in units])[:-1].encode()).hexdigest() if units else ""
            for units in own
        ]
        # The links of each unit, of each text.
        links = np.frombuffer(b"".join([unit[4] for unit in found]), np.int64)
        stops = np.cumsum(counts[:, 2])
        times = counts[flat, 2]
        before = np.cumsum(times) - times
        at = np.repeat(stops[flat] - times - before, times) + np.arange(times.sum())
        linked_by = np.repeat(text_of, times)
        order = np.lexsort((links[at], linked_by))
        pairs, texts_of = links[at][order], linked_by[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1).astype(bool) | np.diff(texts_of, prepend=-1).astype(bool))
        begins = np.searchsorted(texts_of[first], np.arange(len(own) + 1))
        return [*sums, sums[2], digests], begins, pairs[first], np.diff(first, append=len(pairs))


@lru_cache(maxsize=1)
def _aligner(byte_level: str, pieces: str, memo: int) -> Aligner:
    """One per Python worker, kept from task to task."""
    return Aligner(SparkFiles.get(byte_level), SparkFiles.get(pieces), memo)


def _batches(texts: list[str | None]) -> Iterator[slice]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= BATCH_BYTES or k + 1 == len(texts):
            yield slice(first, k + 1)
            first, size = k + 1, 0


def aligned(documents: DataFrame, byte_level: str, pieces: str, memo: int = MEMO_UNITS) -> DataFrame:
    """A row per document: counts, digest and linked pairs with how often it links them."""
    spark = documents.sparkSession
    ship(spark)
    for path in (byte_level, pieces):
        spark.sparkContext.addFile(path)
    names = Path(byte_level).name, Path(pieces).name

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*names, memo)
        for batch in batches:
            ids, numbers = batch.column("doc_id"), batch.column("row")
            texts = batch.column("text").to_pylist()
            for part in _batches(texts):
                columns, begins, pairs, times = aligner.documents(texts[part])
                size, at = part.stop - part.start, pa.array(begins, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(part.start, size), numbers.slice(part.start, size),
                        *[pa.array(x, pa.int64()) for x in columns[:4]], pa.array(columns[4], pa.string()),
                        pa.ListArray.from_arrays(at, pa.array(pairs, pa.int64())),
                        pa.ListArray.from_arrays(at, pa.array(times, pa.int32())),
                    ],
                    names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    numbered = documents.select(
        F.col("doc_id").cast("bigint"), F.monotonically_increasing_id().alias("row"), F.col("text")
    )
    return numbered.mapInArrow(rows, ALIGNED)


@lru_cache(maxsize=4)
def piece_count(pieces: str) -> int:
    """Ids of B."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()


def align_tokenizers(
    documents: DataFrame, byte_level: str = f"{TOKENIZERS}/{BYTE_LEVEL}", pieces: str = f"{TOKENIZERS}/{PIECES}",
    memo: int = MEMO_UNITS,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256, the digest of its groups `a1,a2|b1;a3|b2,b3`.

    A encodes the text behind a space, B the text, to which it adds one. Byte offsets where
    tokens of both end cut them into groups; two tokens that end together are a link. The count
    of an id pair is the number of its links in all documents; `count_sum` adds it up over a
    document's links and `n_best` counts the links whose count is the highest of their B id,
    ties included. Texts that are null or empty, or whose joined tokens differ from the text,
    have zeros and an empty digest. Texts of any length are encoded whole. Repeated rows have
    a row each and all count; rows without an id as well. An empty table gives no rows. Other
    columns are ignored.
    """
    docs = written(aligned(documents.select("doc_id", "text"), byte_level, pieces, memo))
    opened = docs.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    opened = opened.select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = written(opened.groupBy("pair").agg(F.sum("times").alias("n")))
    b_id = F.pmod("pair", F.lit(piece_count(pieces)))
    # A row per id pair: the vocabularies bound a group.
    best = counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(b_id)))
    n_pairs = counts.count()
    if n_pairs <= BROADCAST_PAIRS:
        joined = opened.join(F.broadcast(best), "pair")
    else:
        joined = lookup(opened, best, "pair", "inner", spread=["row"])
    sums = written(
        joined.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    discard(counts)
    zero = F.lit(0).cast("bigint")
    return docs.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
