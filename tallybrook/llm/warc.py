"""Web archive records in seekable Zstandard bundles.

Records are grouped into independent frames; after the last one a seek table, itself
a frame that other readers skip, has the sizes of all frames. An index maps the id of
each record to its file, frame and offset inside the frame, so one record costs
reading one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A frame is closed once it has so many bytes; a longer record has a frame of its own.
FRAME_BYTES = 1 << 20
#: A bundle is closed once it has so many bytes; a task goes on with another one.
BUNDLE_BYTES = 1 << 30
#: Bytes of records that a task reads back, about.
READ_BYTES = 16 << 20
LEVEL = 3

# Fixed values of the seekable format and of the archive format.
_SKIPPABLE, _SEEKABLE, _WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_VERSION = "WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NO_DATE = "1970-01-01T00:00:00Z"

_INDEX = "record_id string, file string, frame int, offset long, length long"


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The last frame of a bundle, from (compressed size, size, checksum) of each frame."""
    entries = b"".join(struct.pack("<III", *f) for f in frames)
    footer = struct.pack("<IBI", len(frames), _WITH_CHECKSUMS, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int, int, int]]:
    """(offset, compressed size, size, checksum) of each frame of a bundle."""
    size = file.size()
    n, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != _SEEKABLE:
        raise ValueError("the bundle has no seek table")
    out, at = [], 0
    for entry in struct.iter_unpack("<III", file.read_at(12 * n, size - 9 - 12 * n)):
        out.append((at, *entry))
        at += entry[0]
    return out


def read_frame(file: pa.NativeFile, place: tuple[int, int, int, int]) -> bytes:
    at, packed, size, checksum = place
    data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, at), max_output_size=size)
    if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
        raise ValueError("a frame is damaged")
    return data


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response, or where ``refers_to`` names one with the same payload, a revisit without it.

    Both have the digest of the payload, and its length in the head of the response.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    lines = [
        _VERSION,
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: {record_id}",
        f"WARC-Date: {_NO_DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # A line end in an address would end the header.
        lines.append(f"WARC-Target-URI: {''.join(c if c > ' ' else f'%{ord(c):02X}' for c in url)}")
    if refers_to:
        lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {_REVISIT}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers of a record by lower-case name, head of its response, payload."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = data[end + 4 : end + 4 + int(headers["content-length"])]
    if lines[0] != _VERSION or data[end + 4 + len(block) :] != b"\r\n\r\n":
        raise ValueError("not a record")
    head, _, payload = block.partition(b"\r\n\r\n")
    return headers, head, payload


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    inner = name.removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def dealt_pages(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, first: each page with the first one of its payload, NULL for a payload that is too short."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    long = F.octet_length("payload") >= least_bytes
    firsts = rows.where(long).groupBy("digest").agg(F.min("page_id").alias("first"))
    firsts.write.parquet(f"{folder}/firsts")
    firsts = pages.sparkSession.read.parquet(f"{folder}/firsts")
    # Equal digests have equal lengths: a short payload finds no first page.
    return rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "first")


def write_archive(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as bundles and their index below ``folder``.

    Of pages whose payloads are equal and at least ``least_bytes`` long, that with the
    smallest page_id is a response and the others revisit it. Payloads are equal if
    their SHA-256 is, whatever their SHA-1. The first page of a payload is found by an
    aggregate over digests, written to a table of its own: its join back sends each
    page once, and adaptive execution splits a payload that many pages share.

    Defined cases: a NULL html is an empty payload; a NULL page_id is never the first
    while another page has the payload; rows with the first one's own page_id are
    responses like it; rows that repeat a page_id, and all those without one, have
    records of the same id, of which :func:`find_record` gives the first one written;
    a NULL url leaves the record without one. ``folder`` must be
    reachable by all workers. A repeated task writes files of new names, and only
    those of the task that counts are in the index.
    """
    dealt = dealt_pages(pages, folder, least_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = arrow_fs.FileSystem.from_uri(folder)
        packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        task = TaskContext.get()
        stream, frames, records, held, index, written = None, [], [], 0, [], 0
        file = ""

        def close_frame() -> None:
            nonlocal held, written
            data = b"".join(records)
            packed = packer.compress(data)
            stream.write(packed)
            frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            written += len(packed)
            held = 0
            records.clear()

        def close_bundle() -> pa.RecordBatch:
            nonlocal stream, written, index
            if records:
                close_frame()
            stream.write(seek_table(frames))
            stream.close()
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*index), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                ["record_id", "file", "frame", "offset", "length"],
            )
            stream, written, index = None, 0, []
            frames.clear()
            return out

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                page_id, url, payload, first = row
                if stream is None:
                    file = f"{task.partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                    stream = store.open_output_stream(f"{root}/{file}", compression=None)
                name = _name(page_id)
                data = record(name, url, payload, None if first is None or page_id == first else _name(first))
                index.append((name, file, len(frames), held, len(data)))
                records.append(data)
                held += len(data)
                if held >= FRAME_BYTES:
                    close_frame()
                    if written >= BUNDLE_BYTES:
                        yield close_bundle()
        if stream is not None:
            yield close_bundle()

    dealt.mapInArrow(run, _INDEX).write.parquet(f"{folder}/index")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    Frames are dealt to tasks; each is read once, by its place in the seek table, and
    its records by their offsets. A response's payload must have the digest that its
    header names; a revisit has no payload, its length and digest are those of the
    full one.
    """
    index = spark.read.parquet(f"{folder}/index")
    # By the bytes to be read, not by those of the index: few rows of it are much work.
    size = index.agg(F.sum("length").alias("size")).first()["size"] or 0
    dealt = index.repartition(-(-size // READ_BYTES) or 1, "file", "frame")
    frames = dealt.groupBy("file", "frame").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    frames = frames.sortWithinPartitions("file", "frame")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = arrow_fs.FileSystem.from_uri(folder)
        tables: dict[str, list] = {}
        for batch in batches:
            for file, frame, places in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(f"{root}/{file}") as f:
                    if file not in tables:
                        tables.clear()
                        tables[file] = read_seek_table(f)
                    data = read_frame(f, tables[file][frame])
                out = []
                for place in places:
                    headers, head, payload = parse(data[place["offset"] : place["offset"] + place["length"]])
                    expected = headers["warc-payload-digest"].removeprefix("sha1:")
                    length = int(head.rpartition(b"Content-Length: ")[2])
                    revisit = headers["warc-type"] == "revisit"
                    if not revisit and (digest(payload) != expected or len(payload) != length):
                        raise ValueError(f"{headers['warc-record-id']}: the payload isn't that of its header")
                    out.append(
                        {
                            "page_id": _number(headers["warc-record-id"]),
                            "url": headers.get("warc-target-uri"),
                            "record_type": headers["warc-type"],
                            "refers_to": _number(headers["warc-refers-to"]) if revisit else None,
                            "payload_bytes": length,
                            "payload_digest": expected,
                            "payload": None if revisit else payload,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )
    return frames.mapInArrow(
        run,
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary",
    )


def find_record(spark: SparkSession, folder: str, page_id: int) -> bytes:
    """One record as written, by its id: the index names the frame, the seek table its place."""
    found = spark.read.parquet(f"{folder}/index").where(F.col("record_id") == _name(page_id))
    row = found.orderBy("file", "frame", "offset").first()
    if row is None:
        raise KeyError(page_id)
    store, root = arrow_fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{row['file']}") as f:
        data = read_frame(f, read_seek_table(f)[row["frame"]])
    return data[row["offset"] : row["offset"] + row["length"]]
