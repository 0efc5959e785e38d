"""Reading, conforming and writing tables."""

from __future__ import annotations

import csv
import io
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, contextmanager
from datetime import datetime
from functools import reduce
from threading import Lock
from typing import TypeVar
from urllib.parse import unquote

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.sources.records import range_parities, read_records
from tallybrook.sources.schemas import KEYS, LOAD_TIME, landing_schema

V, W = TypeVar("V"), TypeVar("W")

#: Columns with the raw line of a CSV row that has too few or too many fields, and whether it has.
BROKEN, IS_BROKEN = "_broken_line", "_is_broken"
#: Versions of a written table that are kept.
RETAINED = 2
#: Files whose first lines are read at a time.
AT_A_TIME = 32
#: Bytes read by a job that has tasks enough for a cluster by itself.
LARGE = 32 << 20
#: Most bytes of files for a task that sorts or folds what it reads; as rows in memory they are about twenty times as many.
SPLIT = 16 << 20

_settings_lock = Lock()
#: Who holds a setting of a session: how many blocks, and the value before the first of them.
_settings_held: dict[tuple[SparkSession, str], tuple[int, str | None]] = {}


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with headers, all columns as text, by name, with ``BROKEN`` and ``IS_BROKEN`` beside them.

    The files of ``path`` may have their columns in any order, and columns that others
    lack, which are then NULL; only their first lines are read to find that out. A row
    that hasn't as many fields as its file's header has its line in ``BROKEN``, which
    is NULL for all others. ``multiline`` accepts line breaks inside quotes (see
    :func:`read_multiline`).
    """
    if multiline:
        return read_multiline(spark, path)
    return read_csv_files(spark, _data_files(spark, path), path)


def read_csv_files(spark: SparkSession, files: Sequence[str], origin: str) -> DataFrame:
    """:func:`read_csv` for files that are known by name; ``origin`` names them in errors."""
    with ThreadPoolExecutor(AT_A_TIME) as pool:
        headers = list(pool.map(lambda file: _header(spark, file), files))
    by_header = defaultdict(list)
    for header, file in zip(headers, files):
        by_header[header].append(file)
    parts = [_files_of(spark, _named_once(header, some[0]), some) for header, some in by_header.items()]
    return _by_name(parts, origin)


def read_multiline(spark: SparkSession, path: str) -> DataFrame:
    """CSV with line breaks inside quotes, in as many tasks as its bytes ask for; columns as in :func:`read_csv`.

    Two passes over the text: the first finds which byte ranges start inside quotes and
    the headers, the second reads the records. No file is opened on the driver; distinct
    headers come to it. Quotes stand around whole fields and are doubled within. A file
    that ends inside quotes isn't of that kind: it is read in one task, by Spark alone.
    Lines without any text are left out.
    """
    files = _data_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no CSV with a header in {path}")
    folder = shared_folder(spark)
    range_parities(spark, files).write.parquet(f"{folder}/parities")
    parities = spark.read.parquet(f"{folder}/parities")
    # A file's last range tells whether its quotes are balanced; such files are few.
    last = parities.groupBy("file").agg(F.max_by("ends_open", "start").alias("open"))
    unbalanced = sorted(r.file for r in last.where("open").collect())
    parts = [_files_of(spark, _named_once(_header(spark, f), f), [f], multiline=True) for f in unbalanced]
    # Paths as Spark names them: without the blanks and marks that it escapes.
    odd = {_plain(f) for f in unbalanced}
    balanced = [f for f in files if _plain(f) not in odd]
    if balanced:
        records = read_records(spark, balanced, parities)
        headers = records.where("is_first").select("file", F.col("record").alias("header"))
        headers.write.parquet(f"{folder}/headers")
        headers = spark.read.parquet(f"{folder}/headers")
        distinct = sorted(r[0] for r in headers.select("header").distinct().collect())
        # Where lines end with a carriage return, too, it is none of the text.
        record = F.when(F.endswith("header", F.lit("\r")), F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "")).otherwise(F.col("record"))
        rows = records.where(~F.col("is_first")).join(headers, "file").withColumn("record", record).where(F.length("record") > 0)
        for text in distinct:
            header = _named_once(tuple(next(csv.reader(io.StringIO(text.removeprefix("\ufeff"))))), text)
            schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in (*header, BROKEN))
            options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
            part = rows.where(F.col("header") == text).select(F.from_csv("record", schema, options).alias("row"))
            parts.append(part.select("row.*").withColumn(IS_BROKEN, F.col(BROKEN).isNotNull()))
    return _by_name(parts, path)


def _plain(file: str) -> str:
    return unquote(file.partition(":")[2]).lstrip("/")


def _files_of(spark: SparkSession, header: tuple[str, ...], files: list[str], multiline: bool = False) -> DataFrame:
    """The rows of files with one header."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, BROKEN)])
    part = csv_options(spark.read.schema(schema)).option("multiLine", multiline).csv(files)
    return part.withColumn(IS_BROKEN, is_broken(part))


def _named_once(header: tuple[str, ...], file: str) -> tuple[str, ...]:
    if len(set(header)) < len(header):
        raise ValueError(f"a column name occurs twice in {file}: {list(header)}")
    return header


def _by_name(parts: list[DataFrame], path: str) -> DataFrame:
    if not parts:
        raise FileNotFoundError(f"no CSV with a header in {path}")
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(*[c for c in whole.columns if c not in (BROKEN, IS_BROKEN)], BROKEN, IS_BROKEN)


def csv_options(reader):
    """How landing CSV is read.

    Rows are parsed whole, whatever columns are asked for: only then a row with too
    few or too many fields is seen as broken.
    """
    options = {"header": True, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, "columnPruning": False}
    return reader.options(**options)


def _data_files(spark: SparkSession, path: str) -> list[str]:
    fs, where = file_system(spark, path)
    found = fs.listStatus(where) if fs.exists(where) else []
    hidden = ("_", ".")
    return sorted(str(f.getPath()) for f in found if f.isFile() and f.getLen() and not f.getPath().getName().startswith(hidden))


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first line of a file, compressed or not."""
    io, hadoop = spark._jvm.java.io, spark._jvm.org.apache.hadoop
    fs, where = file_system(spark, file)
    stream = fs.open(where)
    codec = hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(where)
    reader = io.BufferedReader(io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return tuple(next(csv.reader([reader.readLine().removeprefix("\ufeff")])))
    finally:
        reader.close()


def is_broken(rows: DataFrame) -> Column:
    """Whether a row read with :func:`csv_options` doesn't fit its header.

    Names another column as well: Spark reads no broken lines for themselves.
    """
    other = next(c for c in rows.columns if c != BROKEN)
    return F.coalesce(F.length(F.concat(F.col(BROKEN), F.coalesce(other, F.lit("")))), F.lit(-1)) >= 0


def parse_landing(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a landing table as text, whole and broken ones, with ``BROKEN`` and ``IS_BROKEN``."""
    return with_keys(read_csv(spark, f"{root}/{table}.csv"), table)


def with_keys(parsed: DataFrame, table: str) -> DataFrame:
    """``parsed``, if it has the columns of the table's key."""
    lacking = [c for c in KEYS[table] if c not in parsed.columns]
    if lacking:
        raise ValueError(f"{table}.csv lacks the columns {lacking}")
    return parsed


def whole_rows(parsed: DataFrame, table: str) -> DataFrame:
    """The whole rows of a parsed landing table: declared columns first, in their order, whatever the order in the files."""
    declared = [c for c in landing_schema(table).names if c in parsed.columns]
    more = sorted(set(parsed.columns) - {*declared, BROKEN, IS_BROKEN})
    return parsed.where(~F.col(IS_BROKEN)).select(*declared, *more)


def rejected_rows(parsed: DataFrame, table: str) -> DataFrame:
    """The lines that :func:`whole_rows` leaves out: table_name, line."""
    return parsed.where(IS_BROKEN).select(F.lit(table).alias("table_name"), F.col(BROKEN).alias("line"))


def read_landing(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The whole rows of a landing table as text; the cleaning job gives the columns their types."""
    return whole_rows(parse_landing(spark, root, table), table)


def read_rejected(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The lines of a landing table that :func:`read_landing` leaves out: table_name, line."""
    return rejected_rows(read_csv(spark, f"{root}/{table}.csv"), table)


def find_landing_tables(spark: SparkSession, root: str, tables: Sequence[str] = tuple(KEYS)) -> list[str]:
    """``tables``, by default all of them, each of which must have a CSV under ``root``."""
    absent = [t for t in tables if not path_exists(spark, f"{root}/{t}.csv")]
    if absent:
        raise FileNotFoundError(f"no landing CSV in {root} for {absent}")
    return list(tables)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compressed: bool = False) -> None:
    """Write with a header, every value as text.

    ``compressed`` files are read by one task each, so they have 100,000 rows at most.
    """
    text = df.selectExpr(*[f"string(`{c}`) AS `{c}`" for c in df.columns])
    writer = text.write.mode(mode).option("header", True).option("escape", '"')
    if compressed:
        writer = writer.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 100_000})
    writer.csv(path)


def conform(df: DataFrame, schema: T.StructType, load_time: datetime | None = None) -> DataFrame:
    """Bring ``df`` to the declared columns and types of a loaded table.

    Casts are strict: an unreadable value or an overflow fails the job, decimals
    round half up, and text longer than its declared limit is refused. The load
    time is ``load_time``, NULL by default; other absent columns become NULL.
    """
    present = [f for f in schema if f.name in df.columns]
    limits = {f.name: f.metadata["max_length"] for f in present if "max_length" in f.metadata}
    # A condition beside the columns, not around them: keys stay plain columns, so
    # a join on them can use the partitioning that the rows already have.
    refused = " ".join(
        f"WHEN length(string(`{c}`)) > {n} THEN raise_error('{c}: value longer than {n}')"
        for c, n in limits.items()
    )
    fitting = df.where(f"CASE {refused} ELSE true END") if refused else df
    return fitting.selectExpr(*[_column(f, f in present, load_time) for f in schema])


def _column(field: T.StructField, present: bool, load_time: datetime | None) -> str:
    value = f"`{field.name}`" if present else "NULL"
    if not present and field.name == LOAD_TIME and load_time is not None:
        value = f"'{load_time}'"
    return f"cast({value} AS {field.dataType.simpleString()}) AS `{field.name}`"


def schema_name(layer: str | None, default: str = "public") -> str:
    """A layer's name is used verbatim as its schema name."""
    return default if layer is None else layer.strip()


def table_path(root: str, layer: str | None, table: str) -> str:
    return f"{root}/{schema_name(layer)}/{table}"


def _versions(spark: SparkSession, path: str) -> dict[int, str]:
    """The folder of each version of a table that was written to its end."""
    fs, where = file_system(spark, f"{path}/version=*/_SUCCESS")
    folders = [str(f.getPath().getParent()) for f in fs.globStatus(where) or []]
    return {int(f.rsplit("=", 1)[1]): f for f in folders}


def write_table(
    df: DataFrame, root: str, layer: str | None, table: str, partition_by: str | None = None, rebalance: bool = True
) -> DataFrame:
    """Replace a layer's table by ``df`` and return the table as written.

    The rows are a new version in a folder of its own, which counts once it is
    complete: a failed job leaves the former version, and who reads that goes on
    reading it. The newest versions are kept. Two writers at a time write versions of
    their own, of which the one with the higher number is read.

    With ``partition_by``, rows are first rebalanced on that column: each
    partition gets few files, and one that holds a large share of all rows is
    split over several tasks at run time. Without ``rebalance`` the rows stay in their
    tasks, each of which writes a file for every partition that it has rows of.
    """
    spark, path = df.sparkSession, table_path(root, layer, table)
    there = _versions(spark, path)
    number = max(there, default=0) + 1
    # A number that another writer has taken, at work or failed, is passed over.
    while not claim(spark, f"{path}/_claims/{number:010d}"):
        number += 1
    folder = f"{path}/version={number:010d}"
    rows = df.hint("rebalance", partition_by) if partition_by and rebalance else df
    writer = rows.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    for old in sorted(there)[: -(RETAINED - 1) or None]:
        for place in (there[old], f"{path}/_claims/{old:010d}"):
            fs, where = file_system(spark, place)
            fs.delete(where, True)
    return spark.read.schema(df.schema).parquet(folder).select(df.columns)


def read_table(spark: SparkSession, root: str, layer: str | None, table: str) -> DataFrame:
    """The newest complete version of a layer's table."""
    path = table_path(root, layer, table)
    there = _versions(spark, path)
    if not there:
        raise FileNotFoundError(f"no complete version of {path}")
    return spark.read.parquet(there[max(there)])


def shared_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, inside the folder the cluster names.

    That is ``spark.checkpoint.dir``. Where a session on one machine doesn't set it,
    the folder is inside its warehouse. The folder is removed when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    fs, where = file_system(spark, f"{base.rstrip('/')}/tallybrook-{uuid.uuid4().hex}")
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return str(where)


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system of ``path``, and ``path`` in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file, and say whether it wasn't there before; of several that try at once one succeeds."""
    fs, where = file_system(spark, path)
    fs.mkdirs(where.getParent())
    if fs.getUri().getScheme() == "file":
        # Hadoop's local file system looks first and creates then; the operating system does both at once.
        return spark._jvm.java.io.File(where.toUri().getPath()).createNewFile()
    try:
        fs.create(where, False).close()
    except Py4JJavaError:
        if fs.exists(where):
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = file_system(spark, path)
    stream = fs.create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = file_system(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def together(do: Callable[[V], W], items: Iterable[V], size: Callable[[V], int] | None = None) -> list[W]:
    """``do`` for each item, in threads: their jobs fill the cores that the last tasks of one alone leave idle.

    With ``size``, in bytes read, the items that are ``LARGE`` go one after another beside
    the others, the largest first: each fills the cores by itself, and where shuffles are
    freed (:func:`sparing_disk`) the shuffle of one is gone before that of the next.
    """
    items = list(items)
    sizes = [size(i) if size else 0 for i in items]
    with ThreadPoolExecutor(max(1, len(items))) as beside, ThreadPoolExecutor(1) as in_turn:
        by_size = sorted(range(len(items)), key=lambda n: -sizes[n])
        jobs = {n: (in_turn if sizes[n] > LARGE else beside).submit(do, items[n]) for n in by_size}
        return [jobs[n].result() for n in range(len(items))]


def read_bytes(df: DataFrame) -> int:
    """The bytes of the files that ``df`` is read from."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size()))


@contextmanager
def held(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session while the block runs, for all its threads; of blocks that overlap the first sets and the last resets."""
    with _settings_lock:
        for key, value in settings.items():
            holders, former = _settings_held.get((spark, key), (0, None))
            if not holders:
                former = spark.conf.get(key, None)
                spark.conf.set(key, value)
            _settings_held[spark, key] = holders + 1, former
    try:
        yield
    finally:
        with _settings_lock:
            for key in settings:
                holders, former = _settings_held.pop((spark, key))
                if holders > 1:
                    _settings_held[spark, key] = holders - 1, former
                elif former is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, former)


def sparing_disk(spark: SparkSession, split: int | None = SPLIT) -> AbstractContextManager[None]:
    """Jobs of the block, which write tables off files, leave little on local disks.

    Shuffles are freed when the job that made them has ended; otherwise they stay until the
    driver happens to collect its garbage, and those of a whole run add up. Tasks read at
    most ``split`` bytes of files, so that what they sort or fold fits into memory and isn't
    spilled. Rows go to up to two partitions of a written table without a sort.
    """
    usual = spark._jsparkSession.sessionState().conf()
    settings = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.maxConcurrentOutputFileWriters": str(max(2, usual.maxConcurrentOutputFileWriters())),
    }
    if split:
        settings["spark.sql.files.maxPartitionBytes"] = str(min(split, usual.filesMaxPartitionBytes()))
    return held(spark, settings)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)
