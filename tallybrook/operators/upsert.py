"""Keyed upsert, and tables of buckets that an upsert rewrites only where the batch falls.

A version of such a table is a list: for each bucket the folder with its rows. A batch
writes new folders for the buckets that its keys fall into; the new version takes over
all others as they are. Buckets are filled by a hash of the key. As the table grows,
buckets are split one after another (linear hashing): with ``n`` buckets at the start of
a round, the bucket next in turn gives the rows whose hash modulo ``2 n`` says so to a
new one. No other bucket is touched by that, and a round that has split all of them
starts the next one with twice as many.

To Spark the table has ``n`` buckets throughout a round, the split ones of several
files, so that a join on the key needs no shuffle of it. As names of files tell Spark the
bucket, the rows split off in a round are written once more at its end.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.operators.dedupe import require_unique
from tallybrook.sources.schemas import LOAD_TIME
from tallybrook.sources.tables import claim, file_system, read_text, write_text

#: Bytes that a bucket should have at most, on average.
BUCKET_BYTES = 128 << 20
#: Seconds to wait for another writer that has claimed a version to list it.
PATIENCE = 60


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], kept: Sequence[str] = (LOAD_TIME,)
) -> DataFrame:
    """``target`` with the rows of ``batch`` inserted or, where the key exists, updated.

    An update sets every column of the batch but the keys and the ``kept`` ones.
    Rows of the target without a match stay. A key that occurs twice in the batch
    fails the job. Both sides have unique keys, so one shuffle for each side is
    all the join needs and no key can be hot.
    """
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = require_unique(batch, keys).withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, list(keys), "full_outer")
    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    columns = []
    for c in target.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c not in batch.columns:
            columns.append(F.col(f"old.{c}"))
        else:
            taken = is_new & ~is_old if c in kept else is_new
            columns.append(F.when(taken, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c))
    return joined.select(columns)


@dataclass
class Version:
    """Where the rows of a version are: a folder below the table for each bucket that has any."""

    #: Buckets at the start of the round, and how many of them have been split in it.
    buckets: int
    split: int
    schema: str
    #: Folder and bytes of each bucket, by its number as text.
    folders: dict[str, str] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)

    def bucket(self, keys: Sequence[str]) -> Column:
        """The bucket of a row."""
        place = F.hash(*keys)
        first = F.pmod(place, F.lit(self.buckets))
        return F.when(first < self.split, F.pmod(place, F.lit(2 * self.buckets))).otherwise(first)

    def grown(self, target: int) -> Version:
        """The next state of the table: with buckets split, none of it written yet, so that they have ``target`` bytes on average."""
        wanted = math.ceil(sum(self.sizes.values()) / target) - (self.buckets + self.split)
        split = self.split + max(0, min(wanted, self.buckets - self.split))
        if split == self.buckets:
            return Version(2 * self.buckets, 0, self.schema)
        return Version(self.buckets, split, self.schema)

    def rewritten(self, new: Version) -> set[int]:
        """The buckets whose rows or file names change on the way to ``new``."""
        if new.buckets == self.buckets:
            return set(range(self.split, new.split))
        return {b for b in map(int, self.folders) if b >= self.split}


def _place(root: str, version: int) -> str:
    return f"{root}/_versions/{version:010d}.json"


def _listed(spark: SparkSession, root: str) -> dict[int, str]:
    fs, where = file_system(spark, f"{root}/_versions/*.json")
    files = [str(f.getPath()) for f in fs.globStatus(where) or []]
    return {int(f.rsplit("/", 1)[1].removesuffix(".json")): f for f in files}


def _read(spark: SparkSession, file: str) -> Version | None:
    """A version, or None while its writer hasn't listed it to the end."""
    try:
        return Version(**json.loads(read_text(spark, file)))
    except json.JSONDecodeError:
        return None


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions of a table that were written to their end, ascending."""
    return sorted(v for v, file in _listed(spark, root).items() if _read(spark, file))


def _newest(spark: SparkSession, root: str, below: int | None = None) -> tuple[int, Version | None]:
    """Number and list of the newest version (older than ``below``); 0 and None without one."""
    listed = [v for v in _listed(spark, root) if below is None or v < below]
    for v in sorted(listed, reverse=True):
        version = _read(spark, _place(root, v))
        if version:
            return v, version
    return 0, None


def version_files(spark: SparkSession, root: str, version: int | None = None) -> dict[int, str]:
    """The folder of each bucket of a version, the newest by default."""
    found = _newest(spark, root)[1] if version is None else _read(spark, _place(root, version))
    return {int(b): folder for b, folder in found.folders.items()} if found else {}


def read_version(
    spark: SparkSession, root: str, below: int | None = None, keys: Sequence[str] = ()
) -> DataFrame | None:
    """The newest committed version (older than ``below``), or None.

    With the table's ``keys`` it is read by buckets, so that a join on the keys
    needs no shuffle of it.
    """
    version = _newest(spark, root, below)[1]
    return None if version is None else _rows(spark, root, version, keys)


def read_hit(
    spark: SparkSession, root: str, keys: Sequence[str], hits: DataFrame, below: int | None = None
) -> DataFrame | None:
    """Those buckets of a version that the keys of ``hits`` fall into, or None without a version."""
    version = _newest(spark, root, below)[1]
    if version is None:
        return None
    return _rows(spark, root, version, keys, _hit(version, keys, hits))


def _hit(version: Version, keys: Sequence[str], rows: DataFrame) -> set[int]:
    # Buckets are few: their numbers, not the keys, come to the driver.
    return {r[0] for r in rows.select(version.bucket(keys)).distinct().collect()}


def _rows(
    spark: SparkSession, root: str, version: Version, keys: Sequence[str], only: Iterable[int] | None = None
) -> DataFrame:
    """The rows of a version, or of some of its buckets."""
    schema = T.StructType.fromJson(json.loads(version.schema))
    wanted = version.folders if only is None else {str(b) for b in only} & set(version.folders)
    by_batch = defaultdict(list)
    for b in sorted(wanted, key=int):
        batch, _, name = version.folders[b].rpartition("=")
        by_batch[batch].append(name)
    # One pattern for all buckets that a batch wrote: they are found by one listing.
    folders = [f"{batch}={{{','.join(names)}}}" for batch, names in by_batch.items()]
    if not folders:
        return spark.createDataFrame([], schema)
    if not keys:
        return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    name = _passing_name()
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {version.buckets} BUCKETS "
        f"LOCATION '{root}/{{{','.join(folders)}}}'"
    )
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def _passing_name() -> str:
    # Only a table of the catalog can have buckets. The entry names an external
    # folder and is dropped at once; the files stay.
    return f"tallybrook_{uuid.uuid4().hex}"


def upsert_table(
    batch: DataFrame,
    root: str,
    keys: Sequence[str],
    version: int | None = None,
    retain: int | None = 2,
    buckets: int | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    kept: Sequence[str] = (LOAD_TIME,),
) -> int:
    """Upsert ``batch`` into the versioned table at ``root``; returns the version written.

    A version counts once it is listed to its end, so readers never see half a write
    and a failed or repeated job leaves the former version whole. Naming the
    ``version`` makes a repeat write the same version from the same base. The newest
    ``retain`` versions are kept.

    Only buckets that the batch falls into are read and written, and those whose turn
    it is to be split because buckets have more than ``bucket_bytes`` on average; the
    batch alone is shuffled. Keys are unique and so fill the buckets evenly. ``buckets``
    counts for the first version; an update leaves the ``kept`` columns as they are.

    Of two writers that start from one version the second one to end finds its number
    claimed, and does its work again on the new version: no batch is lost.
    """
    spark = batch.sparkSession
    while True:
        base_number, base = _newest(spark, root, version)
        number = base_number + 1 if version is None else version
        folder = f"rows/{number:010d}-{uuid.uuid4().hex}"
        new = _written(batch, root, keys, folder, base, buckets, bucket_bytes, kept)
        if version is not None:
            fs, where = file_system(spark, _place(root, version))
            fs.delete(where, False)
        if claim(spark, _place(root, number)):
            write_text(spark, _place(root, number), json.dumps(asdict(new)))
            break
        fs, where = file_system(spark, f"{root}/{folder}")
        fs.delete(where, True)
        _await(spark, _place(root, number))
    if retain is not None:
        _remove_older(spark, root, number, retain)
    return number


def _written(
    batch: DataFrame,
    root: str,
    keys: Sequence[str],
    folder: str,
    base: Version | None,
    buckets: int | None,
    bucket_bytes: int,
    kept: Sequence[str],
) -> Version:
    """The version that follows ``base``, with the rows of changed buckets written to ``folder``."""
    spark = batch.sparkSession
    if base is None:
        count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        new = Version(count, 0, batch.schema.json())
        merged, changed = require_unique(batch, keys), set()
    else:
        new = base.grown(bucket_bytes)
        changed = _hit(base, keys, batch) | base.rewritten(new)
        merged = upsert(_rows(spark, root, base, keys, changed), batch, keys, kept)
    name = _passing_name()
    (
        merged.withColumn("_bucket", new.bucket(keys))
        .write.partitionBy("_bucket")
        .bucketBy(new.buckets, *keys)
        .sortBy(*keys)
        .option("path", f"{root}/{folder}")
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")
    if base is not None:
        kept = set(base.folders) - {str(b) for b in changed}
        new.folders = {b: base.folders[b] for b in kept}
        new.sizes = {b: base.sizes[b] for b in kept}
    fs, where = file_system(spark, f"{root}/{folder}/_bucket=*/part-*")
    for file in fs.globStatus(where) or []:
        bucket = file.getPath().getParent().getName().split("=")[1]
        new.folders[bucket] = f"{folder}/_bucket={bucket}"
        new.sizes[bucket] = new.sizes.get(bucket, 0) + file.getLen()
    return new


def _await(spark: SparkSession, place: str) -> None:
    """Wait until a version that another writer has claimed is listed."""
    until = time.monotonic() + PATIENCE
    while _read(spark, place) is None:
        if time.monotonic() > until:
            raise TimeoutError(f"{place} was claimed but never listed; remove it if its writer has ended")
        time.sleep(0.1)


def _remove_older(spark: SparkSession, root: str, number: int, retain: int) -> None:
    """Remove all but the newest ``retain`` versions up to ``number``, and the folders that only they list."""
    versions = {v: _read(spark, file) for v, file in _listed(spark, root).items()}
    whole = sorted(v for v, listed in versions.items() if listed)
    gone = [v for v in whole if v <= number][:-retain]
    used = {f for v in whole if v not in gone for f in versions[v].folders.values()}
    for v in gone:
        # The list first: a version without all of its rows mustn't be found.
        fs, where = file_system(spark, _place(root, v))
        fs.delete(where, False)
        for f in set(versions[v].folders.values()) - used:
            fs.delete(file_system(spark, f"{root}/{f}")[1], True)
