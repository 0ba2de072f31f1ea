"""WARC archives whose records are Zstandard frames over one dictionary.

An archive starts with a skippable frame that holds the dictionary; each record after it is
a frame of its own, so a reader can start at any of them. The dictionary is trained on a
bounded sample of the records. Records with a payload seen before are written as revisits.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datamill.llm.tables import shared_folder, ship, written

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_PAYLOAD = 100
SAMPLE_RECORDS = 1024
SAMPLE_CHARS = 16_384
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string"


def record_types(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Add payload_bytes, payload_digest, record_type and refers_to to page_id, url, html.

    Of equal payloads of at least `least` bytes the row with the smallest page_id is the
    response; rows of that same id are responses too. Rows without an id come last, and are
    responses if none has one. The digests that repeat are few against the pages, and the
    join splits a digest that a large part of them share.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        "html",
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    first = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    joined = rows.join(first, "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(again, F.col("first"))
    ).drop("first")


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and drops the payload."""
    body = b"" if refers_to is not None else payload
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + body
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or 'urn:none', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if refers_to is not None:
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(rows: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from about SAMPLE_RECORDS records, taken by a hash of their digest, of
    whose payloads the first SAMPLE_CHARS characters count. Samples too small to train on
    are the dictionary themselves."""
    total = rows.count()
    draw = F.pmod(F.xxhash64("page_id", "payload_digest"), F.lit(1 << 30))
    chosen = rows.filter(draw < int((1 << 30) * min(1.0, SAMPLE_RECORDS / max(1, total))))
    chosen = chosen.select("page_id", "url", F.substring("html", 1, SAMPLE_CHARS).alias("html"), "payload_bytes", "payload_digest")
    samples = []
    for r in sorted(chosen.collect(), key=lambda r: (r.payload_digest, str(r.page_id))):
        samples.append(record(r.page_id, r.url, (r.html or "").encode(), r.payload_bytes, r.payload_digest, None))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that Spark names by a URI, and its path there."""
    plain = re.sub(r"^file:/+", "/", folder)
    return fs.FileSystem.from_uri(plain)


def _write(folder: str, dictionary: bytes, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(folder)
        files.create_dir(path, recursive=True)
        shared = _dictionary(dictionary)
        compressor = zstandard.ZstdCompressor(level=level, dict_data=shared if dictionary else None)
        out, name, held, n, done = None, "", 0, 0, []

        def close() -> None:
            # An attempt that fails leaves a name that no manifest holds.
            out.close()
            files.move(f"{path}/{name}.part", f"{path}/{name}")
            done.append((name, n, held))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, held, n = f"pages-{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = files.open_output_stream(f"{path}/{name}.part", compression=None)
                    out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
                data = compressor.compress(
                    record(
                        row["page_id"], row["url"], (row["html"] or "").encode(), row["payload_bytes"],
                        row["payload_digest"], row["refers_to"],
                    )
                )
                out.write(data)
                held, n = held + len(data), n + 1
                if held >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                pa.array([d[2] for d in done], pa.int64()),
            ],
            names=["archive", "records", "bytes"],
        )

    return write


def write_archives(pages: DataFrame, folder: str, level: int = 3) -> DataFrame:
    """Write a record per page to archives in `folder`; their names, records and bytes.

    Only archives of finished tasks are named, so a task that ran twice leaves no doubt.
    """
    ship(pages.sparkSession)
    rows = record_types(pages)
    dictionary = train_dictionary(rows)
    return written(rows.mapInArrow(_write(folder, dictionary, level), "archive string, records long, bytes long"))


def _frames(files: fs.FileSystem, path: str) -> Iterator[bytes]:
    """The records of an archive, one after the other, in bounded memory."""
    with files.open_input_stream(path, compression=None) as data:
        magic, size = struct.unpack("<II", data.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{path} has no dictionary frame")
        dictionary = data.read(size)
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary) if dictionary else None)
        rest = b""
        while True:
            rest = rest or data.read(1 << 16)
            if not rest:
                return
            frame, out = reader.decompressobj(), []
            while True:
                out.append(frame.decompress(rest))
                if frame.eof:
                    rest = frame.unused_data
                    break
                rest = data.read(1 << 16)
                if not rest:
                    raise ValueError(f"{path} ends inside a record")
            yield b"".join(out)


def parse(data: bytes) -> dict:
    """What a record says of its payload; a response's digest is computed anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = named["WARC-Payload-Digest"].removeprefix("sha256:")
    if named["WARC-Type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError(f"record {named['WARC-Record-ID']} does not hold the payload it names")
    number = lambda name: int(named[name]) if name in named else None
    return {
        "page_id": number("X-Page-ID"), "payload_bytes": size, "payload_digest": digest,
        "record_type": named["WARC-Type"], "refers_to": number("X-Refers-To-Page"), "payload": payload,
    }


def _read(folder: str, with_payload: bool):
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string())]
    schema = pa.schema(kinds + [("payload", pa.binary())] * with_payload)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(folder)
        for batch in batches:
            for name in batch["archive"].to_pylist():
                rows, held = [], 0
                for data in _frames(files, f"{path}/{name}"):
                    row = parse(data) | {"archive": name}
                    held += len(row["payload"]) if with_payload else 500
                    rows.append({c: row[c] for c in schema.names})
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read


def read_archives(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of archives named by a manifest, one task per few archives."""
    ship(archives.sparkSession)
    schema = RECORDS + ", payload binary" * with_payload
    names = archives.select("archive").repartition(archives.sparkSession.sparkContext.defaultParallelism)
    return names.mapInArrow(_read(folder, with_payload), schema)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read every record back.

    A row per page: page_id, payload_bytes, payload_digest, record_type, refers_to, archive.
    A null html is an empty payload, a null url `urn:none`; rows that repeat are each
    written; an empty table gives no rows. Other columns are ignored.
    """
    folder = shared_folder(pages.sparkSession)
    return read_archives(write_archives(pages, folder), folder)
