"""Removal of word passages that repeat across documents, by level-wise doubling.

Level one takes the windows of `length` words. Windows that some other document holds too
are its survivors. A window of twice the length can only repeat where the windows at its
start and in its middle both survived, so each further level is made from survivors alone,
until a level has none. Every occurrence of a first-level window but those of its smallest
document is removed.

A level is one packed shuffle. Each block of documents sends a window once, in the name of
the smallest document of the block that holds it, as eight bytes in a run of its bucket;
so a passage in a third of all documents is pre-aggregated before it moves. A bucket sorts
its hashes and answers with the places of windows that other blocks hold. The answers
travel to the documents' own groups, where the passages are marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datamill.llm.tables import discard, parts, ship, written
from datamill.llm.words import blocks, grams, mix, sequence_hash, word_hashes

LENGTH = 13
LAST = np.iinfo(np.int64).max
SENT = "bucket int, homes binary, ids binary, prints binary, counts binary, hashes binary, later binary"
FLAGS = "home int, ids binary, prints binary, counts binary, codes binary"
LOCAL = -1  # the bucket number of what a block found out by itself


def _order_ids(ids: pa.Array) -> np.ndarray:
    """Document ids as numbers to order by; null comes after all others."""
    return ids.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _pack(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


SENT_SCHEMA = pa.schema(
    [("bucket", pa.int32()), *[(c, pa.binary()) for c in ("homes", "ids", "prints", "counts", "hashes", "later")]]
)
FLAGS_SCHEMA = pa.schema(
    [("home", pa.int32()), *[(c, pa.binary()) for c in ("ids", "prints", "counts", "codes")]]
)


class _Windows:
    """Windows of some documents: per document its id, print, home, and sorted distinct hashes."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.prints: list[int] = []
        self.homes: list[int] = []
        self.hashes: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int, mark: int, home: int, hashes: np.ndarray) -> None:
        if len(hashes):
            self.ids.append(doc)
            self.prints.append(mark)
            self.homes.append(home)
            self.hashes.append(np.unique(hashes))
            self.size += len(self.hashes[-1])

    def send(self, buckets: int) -> Iterator[dict]:
        """Packed rows of the block. Windows that several of its documents hold also go as
        LOCAL rows, with a byte each: 1 if a smaller document of the block has it."""
        if not self.size:
            return
        ids, prints = np.array(self.ids, np.int64), np.array(self.prints, np.uint64)
        homes = np.array(self.homes, np.int32)
        place = np.lexsort((prints, ids))  # documents by id
        ids, prints, homes = ids[place], prints[place], homes[place]
        parts_ = [self.hashes[p] for p in place]
        h = np.concatenate(parts_)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(p) for p in parts_])
        order = np.argsort(h, kind="stable")  # by hash, then by document
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        head = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        later = ids[doc] > ids[doc[head]][run]
        last = np.append(head[1:], len(h)) - 1
        shared = (ids[doc[last]] > ids[doc[head]])[run]  # some other document of the block has it
        # Rows that tie with the first by id are the same id again; they are sent as well.
        sent = ~later
        if shared.any():
            yield from self._rows(LOCAL, h[shared], doc[shared], ids, prints, homes, later[shared])
        h, doc = h[sent], doc[sent]
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((h, doc, bucket))
        h, doc, bucket = h[order], doc[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(h))):
            if b > a:
                yield from self._rows(int(bucket[a]), h[a:b], doc[a:b], ids, prints, homes, None)

    @staticmethod
    def _rows(bucket, h, doc, ids, prints, homes, later) -> Iterator[dict]:
        if later is not None:
            order = np.lexsort((h, doc))
            h, doc, later = h[order], doc[order], later[order]
        named, counts = np.unique(doc, return_counts=True)
        yield {
            "bucket": bucket,
            "homes": homes[named].tobytes(),
            "ids": ids[named].tobytes(),
            "prints": prints[named].tobytes(),
            "counts": counts.astype(np.int32).tobytes(),
            "hashes": h.tobytes(),
            "later": None if later is None else later.astype(np.uint8).tobytes(),
        }


def _answer(home, ids, prints, doc, codes) -> Iterator[dict]:
    """Flag rows, one per home group: the codes of each document's flagged windows."""
    order = np.lexsort((doc, home[doc]))
    doc, codes = doc[order], codes[order]
    at = home[doc]
    cuts = np.flatnonzero(np.diff(at)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(at))):
        if b > a:
            own = doc[a:b]
            step = np.append(0, np.flatnonzero(np.diff(own)) + 1)
            yield {
                "home": int(at[a]),
                "ids": ids[own[step]].tobytes(),
                "prints": prints[own[step]].tobytes(),
                "counts": np.diff(np.append(step, len(own))).astype(np.int32).tobytes(),
                "codes": codes[a:b].tobytes(),
            }


def _codes(hashes: np.ndarray, later: np.ndarray) -> np.ndarray:
    """A flagged window's hash, its lowest bit given up to `a smaller document has it`."""
    return (hashes & ~np.uint64(1)) | later.astype(np.uint64)


def _judge(table: pa.Table) -> pa.Table:
    """One bucket: which of its windows do documents of several ids hold? What a block
    settled by itself passes through."""
    rows = table.to_pylist()

    def column(of: list[dict], name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(r[name], kind) for r in of])

    answers = []
    for of in ([r for r in rows if r["bucket"] < 0], [r for r in rows if r["bucket"] >= 0]):
        if not of:
            continue
        homes, ids, prints = (column(of, *c) for c in (("homes", np.int32), ("ids", np.int64), ("prints", np.uint64)))
        counts, h = column(of, "counts", np.int32), column(of, "hashes", np.uint64)
        doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        if of[0]["bucket"] < 0:
            codes = _codes(h, column(of, "later", np.uint8))
        else:
            order = np.lexsort((ids[doc], h))
            h, doc = h[order], doc[order]
            owner = ids[doc]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            head = np.flatnonzero(new)
            run = np.cumsum(new) - 1
            least, most = owner[head], owner[np.append(head[1:], len(h)) - 1]
            hit = (most > least)[run]
            codes, doc = _codes(h[hit], (owner > least[run])[hit]), doc[hit]
        answers.append((homes, ids, prints, doc, codes))
    if len(answers) == 2:  # one packet per home, whoever answers
        first, second = answers
        shift = len(first[0])
        answers = [(*map(np.concatenate, zip(first[:3], second[:3])), np.append(first[3], second[3] + shift), np.append(first[4], second[4]))]
    out = [row for answer in answers for row in _answer(*answer)]
    return pa.Table.from_batches([_pack(out, FLAGS_SCHEMA)])


class _Flags:
    """Answers that reached a home group, by document."""

    def __init__(self, table: pa.Table) -> None:
        self.by: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in table.to_pylist():
            counts = np.frombuffer(r["counts"], np.int32)
            codes = np.split(np.frombuffer(r["codes"], np.uint64), np.cumsum(counts)[:-1])
            ids, prints = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["prints"], np.uint64)
            for doc, mark, own in zip(ids.tolist(), prints.tolist(), codes):
                self.by.setdefault((doc, mark), []).append(own)

    def of(self, doc: int, mark: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window of a document: does another document hold it, does a smaller one?"""
        repeated, later = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
        told = self.by.get((doc, mark))
        if not told or not len(hashes):
            return repeated, later
        codes = np.concatenate(told)
        u, place = np.unique(hashes & ~np.uint64(1), return_inverse=True)
        at = np.searchsorted(u, codes & ~np.uint64(1))
        is_repeated, is_later = np.zeros(len(u), bool), np.zeros(len(u), bool)
        is_repeated[at] = True
        is_later[at[(codes & np.uint64(1)) == 1]] = True
        return is_repeated[place], is_later[place]


def _send_texts(length: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, homes = _order_ids(batch["_id"]), batch["_home"].to_numpy(zero_copy_only=False)
            for rows, data, at in blocks(batch["_text"]):
                words, first = word_hashes(data, at)
                block = _Windows()
                for i, row in enumerate(range(rows.start, rows.stop)):
                    own = words[first[i] : first[i + 1]]
                    block.add(int(ids[row]), sequence_hash(own), int(homes[row]), grams(own, length))
                yield _pack(list(block.send(buckets)), SENT_SCHEMA)

    return send


def _send_survivors(span: int, buckets: int):
    """Windows of twice the `span` words, where both halves survived."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _Windows()
            for r in batch.to_pylist():
                _, hashes = _doubled(r, span)
                block.add(r["_id"], _unsigned(r["_print"]), r["_home"], hashes)
                if block.size > 500_000:
                    yield _pack(list(block.send(buckets)), SENT_SCHEMA)
                    block = _Windows()
            yield _pack(list(block.send(buckets)), SENT_SCHEMA)

    return send


def _unsigned(number: int) -> int:
    return number % 2**64


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number


def _steps(starts: np.ndarray) -> bytes:
    """Places as differences, which compress to little: windows survive in runs."""
    return np.diff(starts, prepend=0).astype(np.int32).tobytes()


def _doubled(row: dict, span: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum(np.frombuffer(row["starts"], np.int32), dtype=np.int64)
    hashes = np.frombuffer(row["hashes"], np.uint64)
    at = np.searchsorted(starts, starts + span)
    both = np.flatnonzero(starts[np.minimum(at, len(starts) - 1)] == starts + span)
    second = hashes[at[both]]
    return starts[both], mix(hashes[both] * np.uint64(0xD6E8FEB86659FD93) + second)


MARKED = (
    "_id long, _print long, _home int, doc_id long, n_words long, n_removed long, kept_text string, "
    "kept_sha256 string, starts binary, hashes binary"
)
SURVIVORS = "_id long, _print long, _home int, starts binary, hashes binary"


def _mark_texts(length: int, keep_text: bool):
    schema = pa.schema(
        [("_id", pa.int64()), ("_print", pa.int64()), ("_home", pa.int32()), ("doc_id", pa.int64()),
         ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()),
         ("kept_sha256", pa.string()), ("starts", pa.binary()), ("hashes", pa.binary())]
    )

    def mark(docs: pa.Table, flags: pa.Table) -> pa.Table:
        told = _Flags(flags)
        texts = docs["_text"].combine_chunks()
        order, ids = _order_ids(docs["_id"].combine_chunks()), docs["_id"].to_pylist()
        home = docs["_home"].to_pylist()
        out = []
        for rows, data, at in blocks(texts):
            words, first = word_hashes(data, at)
            for i, row in enumerate(range(rows.start, rows.stop)):
                own = words[first[i] : first[i + 1]]
                print_ = sequence_hash(own)
                hashes = grams(own, length)
                repeated, later = told.of(int(order[row]), print_, hashes)
                kept = data[at[i] : at[i + 1]].tobytes().split()
                n = len(kept)
                if later.any():
                    cover = np.zeros(n + 1, np.int32)
                    np.add.at(cover, np.flatnonzero(later), 1)
                    np.add.at(cover, np.flatnonzero(later) + length, -1)
                    covered = np.cumsum(cover[:n]) > 0
                    kept = [w for w, gone in zip(kept, covered.tolist()) if not gone]
                text = b" ".join(kept)
                survive = np.flatnonzero(repeated)
                out.append(
                    {
                        "_id": int(order[row]), "_print": _signed(print_), "_home": home[row],
                        "doc_id": ids[row], "n_words": n, "n_removed": n - len(kept),
                        "kept_text": text.decode() if keep_text else None,
                        "kept_sha256": hashlib.sha256(text).hexdigest(),
                        "starts": _steps(survive), "hashes": hashes[survive].tobytes(),
                    }
                )
        return pa.Table.from_pylist(out, schema=schema)

    return mark


def _mark_survivors(span: int):
    schema = pa.schema(
        [("_id", pa.int64()), ("_print", pa.int64()), ("_home", pa.int32()),
         ("starts", pa.binary()), ("hashes", pa.binary())]
    )

    def mark(docs: pa.Table, flags: pa.Table) -> pa.Table:
        told = _Flags(flags)
        out = []
        for r in docs.to_pylist():
            starts, hashes = _doubled(r, span)
            repeated, _ = told.of(r["_id"], _unsigned(r["_print"]), hashes)
            if repeated.any():
                r["starts"], r["hashes"] = _steps(starts[repeated]), hashes[repeated].tobytes()
                out.append(r)
        return pa.Table.from_pylist(out, schema=schema)

    return mark


def _judged(sent: DataFrame, buckets: int) -> DataFrame:
    # What a block settled by itself is dealt out evenly: it needs no meeting.
    spread = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(
        F.pmod(F.xxhash64("ids", "hashes"), F.lit(buckets)).cast("int")
    )
    return sent.withColumn("_to", spread).groupBy("_to").applyInArrow(lambda t: _judge(t.drop_columns(["_to"])), FLAGS)


def repeated_passages(
    documents: DataFrame,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_text: bool = True,
    deeper: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, kept_sha256, longest.

    Words are runs of anything but ASCII white space. A word is removed if a window of
    `length` words over it also starts in a document with a smaller id. `kept_text` joins
    the kept words with one space (null without `keep_text`); `longest` is the greatest
    level (length, 2·length, …) at which a window of the document starts in another one, 0
    if none does.

    A null text is empty: no words, the digest of nothing. A null id comes after all
    others. Rows that repeat an id do not remove from one another, as neither is smaller;
    each is returned. An empty table gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    buckets = homes = parts(spark)
    few = max(1, buckets // 4)  # for the deeper levels, which hold far less
    rows = documents.select(F.col(id_column).cast("bigint").alias("_id"), F.col(text_column).alias("_text"))
    rows = rows.withColumn("_home", F.pmod(F.xxhash64("_id", "_text"), F.lit(homes)).cast("int"))
    flags = written(_judged(rows.mapInArrow(_send_texts(length, buckets), SENT), buckets))
    marked = rows.groupBy("_home").cogroup(flags.groupBy("home")).applyInArrow(_mark_texts(length, keep_text), MARKED)
    marked = written(marked)
    discard(flags)
    alive = marked.filter(F.octet_length("starts") > 0).select("_id", "_print", "_home", "starts", "hashes")
    span = length
    longest = alive.select("_id", "_print", F.lit(span).alias("level"))
    while deeper:
        flags = _judged(alive.mapInArrow(_send_survivors(span, few), SENT), few)
        above = written(
            alive.groupBy("_home").cogroup(flags.groupBy("home")).applyInArrow(_mark_survivors(span), SURVIVORS)
        )
        if hasattr(alive, "written_to"):
            discard(alive)
        alive, span = above, 2 * span
        if alive.isEmpty():
            break
        longest = longest.unionByName(written(alive.select("_id", "_print", F.lit(span).alias("level"))))
    longest = longest.groupBy("_id", "_print").agg(F.max("level").cast("bigint").alias("longest"))
    return marked.join(longest, ["_id", "_print"], "left").select(
        "doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", F.coalesce("longest", F.lit(0)).alias("longest")
    )
