"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

A file starts with a skippable frame that holds the dictionary; then each record is one frame, so
that any record can be read with the dictionary and its own bytes alone. Records are WARC/1.1;
payloads that occur more than once are stored once, the others refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, materialize, scratch_path

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: Records from which the dictionary is built, bytes taken of each, and its size.
DICTIONARY_RECORDS, DICTIONARY_RECORD_BYTES, DICTIONARY_BYTES = 2000, 16 << 10, 64 << 10
#: A file is closed when it is larger than this.
SEGMENT_BYTES = 64 << 20
LEVEL = 3

RECORD_SCHEMA = "page_id {id}, target_uri string, record_type string, refers_to {id}, payload_bytes long, payload_digest string, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: object) -> str:
    return "null" if page_id is None else str(page_id)


def record_bytes(page_id: object, url: str | None, payload: bytes, refers_to: object | None, revisit: bool) -> bytes:
    """A response, or a revisit that has the response's HTTP head but no payload."""
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "") or f"urn:x-page:{_name(page_id)}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{_name(page_id)}>",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:x-page:{_name(refers_to)}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> bytes:
    """Trained on the records; of too few or too small ones, their own end is the dictionary."""
    samples = [s[:DICTIONARY_RECORD_BYTES] for s in samples]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\nWARC-Type: response\r\n"


def write_segments(rows: Iterator[tuple], root: str, stem: str, dictionary: bytes) -> Iterator[tuple[str, int, int]]:
    """Write records (page_id, url, payload, refers_to, revisit); give (path, bytes, records) of each finished file.

    A file gets its name only when it is complete, and names never repeat: a task that is run again
    leaves whole files that no manifest lists.
    """
    store, base = fs.FileSystem.from_uri(root)
    store.create_dir(base, recursive=True)
    squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
    out, name, size, n = None, "", 0, 0
    for row in rows:
        if out is None:
            name = f"{stem}-{uuid.uuid4().hex}.warc.zst"
            out = store.open_output_stream(f"{base}/_{name}", compression=None)  # the name would have it compressed again
            size = out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
        size += out.write(squeeze.compress(record_bytes(*row)))
        n += 1
        if size >= SEGMENT_BYTES:
            out.close()
            store.move(f"{base}/_{name}", f"{base}/{name}")
            yield f"{root}/{name}", size, n
            out, n = None, 0
    if out is not None:
        out.close()
        store.move(f"{base}/_{name}", f"{base}/{name}")
        yield f"{root}/{name}", size, n


def frames(data: memoryview) -> Iterator[bytes]:
    """The records of a file: its dictionary comes from the leading frame."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[8 : 8 + size])))
    at, step = 8 + size, 16 << 10
    while at < len(data):
        one, parts = expand.decompressobj(), []
        while not one.eof:
            if at >= len(data):
                raise ValueError("the archive ends within a record")
            piece = data[at : at + step]
            parts.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[str, str, str, str | None, int, str, bytes | None]:
    """(id, uri, type, refers to, payload bytes, digest, payload): the payload's size is that of the HTTP head."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:20]}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[16:]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    name = lambda x: x[len("<urn:x-page:") : -1]
    return name(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], name(fields["WARC-Refers-To"]) if revisit else None, length, digest, None if revisit else payload


def write_archive(pages: DataFrame, root: str, min_payload: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write one record per row below ``root`` and return the manifest (path, bytes, records).

    Of payloads of at least ``min_payload`` bytes that are equal, the row with the largest id is the
    response and the others revisit it; rows that repeat that id as well are responses too. A null
    payload is empty; a null id is smaller than any other. Other columns are not read; an empty table
    writes no file.

    Only digests are grouped (with partial sums); payloads move once, to join the largest id of their
    digest, and a digest that many rows share is split by the adaptive skew join.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"), F.coalesce(pages[payload_col], F.lit("")).alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    most = rows.groupBy("digest").agg(F.max("page_id").alias("most"))
    decided = rows.join(most, "digest").select(
        "page_id", "url", F.col("payload").cast("binary").alias("payload"), "most",
        (~F.col("page_id").eqNullSafe(F.col("most")) & (F.octet_length("payload") >= min_payload)).alias("revisit"),
    )
    sample = bounded_sample(rows.select("page_id", "url", F.substring("payload", 1, DICTIONARY_RECORD_BYTES).alias("payload")), DICTIONARY_RECORDS, "page_id")
    dictionary = build_dictionary([record_bytes(r.page_id, r.url, r.payload.encode(), None, False) for r in sample.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (
            (r["page_id"], r["url"], r["payload"], r["most"], r["revisit"])
            for batch in batches
            for k in range(0, batch.num_rows, 256)
            for r in batch.slice(k, 256).to_pylist()
        )
        for path, size, n in write_segments(each, root, "part", dictionary):
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])

    return materialize(decided.mapInArrow(run, "path string, bytes long, records long"), f"manifest-{kind}")


def read_archive(spark: SparkSession, manifest: DataFrame, id_type: str = "bigint", payloads: bool = True) -> DataFrame:
    """The records of the files that ``manifest`` lists, one row each; payloads are checked against their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = fs.FileSystem.from_uri(path)
                with store.open_input_stream(at, compression=None) as f:
                    data = memoryview(f.read())
                held, size = [], 0
                for record in frames(data):
                    held.append(parse_record(record)[: 7 if payloads else 6])
                    size += len(record) if payloads else 256
                    if size > 4 << 20:
                        yield pack(held)
                        held, size = [], 0
                if held:
                    yield pack(held)

    def pack(held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
        names = ["page_id", "target_uri", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names[: len(columns)])

    schema = "page_id string, target_uri string, record_type string, refers_to string, payload_bytes long, payload_digest string" + ", payload binary" * payloads
    files = manifest.select("path").repartition(max(1, manifest.count()))
    out = files.mapInArrow(run, schema)
    as_id = lambda c: F.when(F.col(c) != "null", F.col(c)).cast(id_type).alias(c)
    return out.select(as_id("page_id"), "target_uri", "record_type", as_id("refers_to"), "payload_bytes", "payload_digest", *["payload"] * payloads)


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write an archive of ``pages`` into the shared folder, read it back, and describe each record."""
    spark = pages.sparkSession
    manifest = write_archive(pages, scratch_path(spark, "warc"))
    out = read_archive(spark, manifest, pages.schema["page_id"].dataType.simpleString(), payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")
