"""CSV records with line breaks in quotes, read by many tasks for a file.

A file is read in byte ranges, as lines. Whether a range starts inside quotes follows
from the number of quotes before it: each range counts its own, and a running sum of
the counts over the ranges of a file tells their parity. With that known, every range
finds its own records: a line begins one if the quotes before it are even. What a range
has before its first record, or behind the start of its last one, are pieces of records
that lie in several ranges; there are two of them in a range at most, and they are put
together by file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Ranges that start inside quotes have 16 bytes each in a broadcast: 64 MB at most, for
#: 500 TB in ranges of 128 MB if all do. Larger ranges (spark.sql.files.maxPartitionBytes) make fewer.
MOST_OPEN = 4 << 20

_WHOLE, _HEAD, _TAIL = "whole", "head", "tail"


def _lines(spark: SparkSession, files: list[str] | str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(files)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _quotes(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def _key(file: str, start: int) -> bytes:
    return hashlib.blake2b(f"{start} {file}".encode(), digest_size=16).digest()


def range_parities(spark: SparkSession, files: list[str] | str) -> DataFrame:
    """file, start, opens, ends_open: whether each range of a file starts, and whether it ends, inside quotes."""
    own = _lines(spark, files).groupBy("file", "start").agg(F.sum(_quotes(F.col("value"))).alias("quotes"))
    # A row for each range, not for each line.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return own.select("file", "start", opens.alias("opens"), (opens.cast("int") + F.col("quotes")) % 2 == 1).toDF(
        "file", "start", "opens", "ends_open"
    )


def read_records(spark: SparkSession, files: list[str], parities: DataFrame) -> DataFrame:
    """file, is_first, record: the records of ``files``, whose ``parities`` are known; is_first for the first one of each.

    Records keep the line breaks inside them, and the carriage return where lines end
    with one before the line feed. Quotes must be balanced in each file.
    """
    open_ = parities.where("opens").select("file", "start")
    keys = {_key(r.file, r.start) for r in open_.limit(MOST_OPEN + 1).collect()}
    if len(keys) > MOST_OPEN:
        raise ValueError(f"more than {MOST_OPEN} ranges start inside quotes; set a larger spark.sql.files.maxPartitionBytes")
    shared = spark.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        lines: list[str] = []
        inside = first = False
        kind = _WHOLE

        def emit(kind: str) -> None:
            nonlocal first
            if lines:
                out.append((*now, kind, first and kind != _HEAD, "\n".join(lines)))
                first = first and kind == _HEAD
                lines.clear()

        def taken() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 5
            out.clear()
            types = (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["file", "start", "kind", "is_first", "record"])

        for batch in batches:
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != now:
                    if now:
                        emit(_HEAD if kind == _HEAD else _TAIL)
                    now = (file, start)
                    inside = _key(file, start) in shared.value
                    first = start == 0
                    kind = _HEAD if inside else _WHOLE
                lines.append(line)
                inside ^= line.count('"') % 2 == 1
                if not inside:
                    emit(kind)
                    kind = _WHOLE
            yield taken()
        if now:
            # What is left open: a record's beginning, or the whole range if it began inside one.
            emit(_HEAD if kind == _HEAD else _TAIL)
        yield taken()

    schema = "file string, start long, kind string, is_first boolean, record string"
    rows = _lines(spark, files).mapInArrow(run, schema)
    whole = rows.where(F.col("kind") == _WHOLE).select("file", "is_first", "record")
    # Pieces: a tail begins a record, heads of later ranges go on with it.
    pieces = rows.where(F.col("kind") != _WHOLE).withColumn("order", F.struct("start", F.col("kind") == _TAIL))
    number = F.count_if(F.col("kind") == _TAIL).over(Window.partitionBy("file").orderBy("order"))
    parts = F.array_sort(F.collect_list(F.struct("order", "record")))
    joined = pieces.withColumn("number", number).groupBy("file", "number").agg(
        F.bool_or("is_first").alias("is_first"), F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record")
    )
    return whole.unionByName(joined.select("file", "is_first", "record"))
