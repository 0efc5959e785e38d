"""Token ids of a corpus in files of independent entropy-coded blocks.

A corpus is a folder: ``table.bin`` has the frequency table that all blocks share,
each ``part-<part>-<block>.rans`` has consecutive blocks of whole documents in
ascending order of doc_id, and ``index`` is a table with a row for each block: where
it is, its documents and ids, and its checksum. Blocks decode independently, and
inside a block decoding can begin at any checkpoint.

File: magic, then for each block the numbers of documents and ids, doc_ids, ids of
each document, the coded ids (see ``rans``) and a checksum over these.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.memory import small_slices
from tallybrook.llm.rans import Table, decode, encode
from tallybrook.llm.words import word_encoder

#: A block is closed once it has so many ids; a longer document makes a longer block.
BLOCK_IDS = 1 << 17
#: Bytes of blocks that a task decodes, about.
READ_BYTES = 4 << 20
_MAGIC = b"TBTOKEN1"
_BLOCK = "<IQ"
_NO_ID = np.iinfo(np.int64).min

_TOKENS = "part int, block int, doc_ids binary, counts binary, ids binary"
_INDEX = "part int, block int, path string, offset long, length long, first_doc long, last_doc long, n_docs long, n_ids long, crc32 long"


def tokenise(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Blocks of ids, in ascending order of doc_id: part, block, and the documents with their ids.

    Rows are dealt by ranges of doc_id and, among equals, of a hash of the text, so
    that a repeated id may hold any share of the rows.
    """
    tie = F.xxhash64("text")
    rows = docs.select("doc_id", "text", tie.alias("tie")).repartitionByRange("doc_id", "tie")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, block = word_encoder(vocabulary), TaskContext.get().partitionId(), 0
        doc_ids: list[int] = []
        found: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal block, held
            row = {
                "part": [part],
                "block": [block],
                "doc_ids": [np.array(doc_ids, dtype="<i8").tobytes()],
                "counts": [np.array([len(x) for x in found], dtype="<i8").tobytes()],
                "ids": [np.concatenate(found).astype("<u4" if wide else "<u2").tobytes()],
            }
            block, held = block + 1, 0
            doc_ids.clear()
            found.clear()
            return pa.RecordBatch.from_pydict(row, schema=_arrow(_TOKENS))

        wide = encoder.library.get_vocab_size() > 1 << 16
        for batch in batches:
            for few in small_slices(batch, 1):
                texts = [t or "" for t in few.column(1).to_pylist()]
                for doc_id, ids in zip(few.column(0).to_pylist(), encoder.encode_batch(texts)):
                    doc_ids.append(_NO_ID if doc_id is None else doc_id)
                    found.append(np.append(ids, end_id))
                    held += len(ids) + 1
                    if held >= BLOCK_IDS:
                        yield close()
        if found:
            yield close()

    return rows.mapInArrow(run, _TOKENS)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in schema.split(", "))])


def _ids(row: dict) -> np.ndarray:
    n = int(np.frombuffer(row["counts"], "<i8").sum())
    return np.frombuffer(row["ids"], "<u2" if len(row["ids"]) == 2 * n else "<u4")


def count_ids(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in the corpus; as many rows as ids come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                found = np.bincount(_ids(row))
                if len(found) > len(total):
                    total = np.append(total, np.zeros(len(found) - len(total), np.int64))
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    rows = tokens.select("counts", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_blocks(tokens: DataFrame, folder: str, table: Table) -> DataFrame:
    """Write the blocks as files below ``folder``; the rows of their index.

    A file is written under a name of its own and takes its final name when whole.
    A repeated task writes the same again.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(table.to_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.from_bytes(shared.value)
        store, root = arrow_fs.FileSystem.from_uri(folder)
        part, stream, written, index = None, None, 0, []

        def close() -> pa.RecordBatch:
            stream.close()
            path = f"{root}/part-{index[0]['part']:06d}-{index[0]['block']:06d}.rans"
            store.move(temporary, path)
            name = path.removeprefix(f"{root}/")
            return pa.RecordBatch.from_pylist([r | {"path": name} for r in index], schema=_arrow(_INDEX))

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part or row["block"] != index[-1]["block"] + 1:
                    if index:
                        yield close()
                    part, written, index = row["part"], len(_MAGIC), []
                    temporary = f"{root}/_writing-{uuid.uuid4().hex}"
                    stream = store.open_output_stream(temporary)
                    stream.write(_MAGIC)
                n_docs, ids = len(row["doc_ids"]) // 8, _ids(row)
                doc_ids = np.frombuffer(row["doc_ids"], "<i8")
                body = struct.pack(_BLOCK, n_docs, len(ids)) + row["doc_ids"] + row["counts"] + encode(ids, table)
                crc = zlib.crc32(body)
                body += struct.pack("<I", crc)
                stream.write(body)
                index.append(
                    {
                        "part": part,
                        "block": row["block"],
                        "offset": written,
                        "length": len(body),
                        "first_doc": int(doc_ids[0]),
                        "last_doc": int(doc_ids[-1]),
                        "n_docs": n_docs,
                        "n_ids": len(ids),
                        "crc32": crc,
                    }
                )
                written += len(body)
        if index:
            yield close()

    return tokens.mapInArrow(run, _INDEX)


def write_corpus(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> None:
    """Write ``docs`` (doc_id, text) as token files under ``folder``, a path that all workers reach.

    A first pass writes the ids as a plain table, a second one counts them, a third
    one codes them with the frequencies of the whole corpus.

    Defined cases: a NULL or empty text has the end id only; rows without doc_id
    come first; repeated ids stay, next to each other; no rows make an empty index.
    """
    spark = docs.sparkSession
    plain = f"{folder}/_tokens"
    tokenise(docs, vocabulary, end_id).write.option("compression", "zstd").parquet(plain)
    tokens = spark.read.parquet(plain)
    table = Table.from_counts(count_ids(tokens))
    store, root = arrow_fs.FileSystem.from_uri(folder)
    with store.open_output_stream(f"{root}/table.bin") as f:
        f.write(table.to_bytes())
    write_blocks(tokens, folder, table).write.parquet(f"{folder}/index")


def read_corpus(spark: SparkSession, folder: str, column: str = "ids") -> DataFrame:
    """The documents of token files: doc_id, start (ids of all documents before it), n_tokens, crc32, ids.

    Blocks are dealt to tasks one by one; damaged ones are errors. ``ids`` is a
    binary of 32-bit numbers.
    """
    index = spark.read.parquet(f"{folder}/index")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # A row for each part, that is for each task that wrote.
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("n_ids").over(before.partitionBy("part").orderBy("block")), F.lit(0))
    blocks = index.withColumn("_inside", inside).join(parts, "part")
    blocks = blocks.select("path", "offset", "length", "crc32", (F.col("_before") + F.col("_inside")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = arrow_fs.FileSystem.from_uri(folder)
        table = None
        for batch in batches:
            for row in batch.to_pylist():
                if table is None:
                    with store.open_input_stream(f"{root}/table.bin") as f:
                        table = Table.from_bytes(f.read())
                with store.open_input_file(f"{root}/{row['path']}") as f:
                    body = f.read_at(row["length"], row["offset"])
                if zlib.crc32(body[:-4]) != row["crc32"] or struct.unpack("<I", body[-4:])[0] != row["crc32"]:
                    raise ValueError(f"a block of {row['path']} is damaged")
                n_docs, n_ids = struct.unpack_from(_BLOCK, body)
                at = struct.calcsize(_BLOCK)
                doc_ids = np.frombuffer(body, "<i8", n_docs, at)
                counts = np.frombuffer(body, "<i8", n_docs, at + 8 * n_docs)
                ids = decode(body[at + 16 * n_docs : -4], table).astype("<u4")
                ends = np.cumsum(counts)
                coded = [ids[e - c : e].tobytes() for e, c in zip(ends, counts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64(), mask=doc_ids == _NO_ID),
                        pa.array(row["start"] + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(b) for b in coded], pa.int64()),
                        pa.array(coded, pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "crc32", column],
                )

    # By the bytes to be decoded: the index itself is small.
    size = index.agg(F.sum("length").alias("size")).first()["size"] or 0
    dealt = blocks.repartition(-(-size // READ_BYTES) or 1, "path", "offset")
    return dealt.mapInArrow(run, f"doc_id long, start long, n_tokens long, crc32 long, `{column}` binary")
