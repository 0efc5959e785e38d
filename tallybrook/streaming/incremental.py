"""Incremental ingest: new landing files are cleaned and upserted into a loaded table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tallybrook.operators.upsert import upsert_table
from tallybrook.plans.cleaning import CLEANERS
from tallybrook.sources.schemas import KEYS, landing_schema, raw_schema
from tallybrook.sources.tables import conform, read_csv_files, rejected_rows, whole_rows, with_keys

#: Columns of a stream of files.
FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(
    spark: SparkSession,
    table: str,
    landing: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
    then: Callable[[DataFrame], object] | None = None,
) -> StreamingQuery:
    """Take in all files of ``landing`` that no earlier run took, then stop.

    The stream is one of file names; what is in the files is read by batch, by column
    name, as a landing table is: files may differ in the order of columns, lack
    optional ones and have more. Each file is taken exactly once through the checkpoint.
    Batch n writes version n + 1 of the target from the version before it, so a batch
    that is repeated after a failure writes the same version again. A later row of a
    key updates an earlier one; no watermark is needed, as the key decides. The target
    belongs to this stream alone. Lines that don't fit are kept beside the target, in
    ``<target>-rejected``, by batch.

    A batch rewrites the buckets that its rows fall into; ``files_per_batch`` splits a
    run that would be too large at once. ``then`` is called with the rows of each batch,
    as they were loaded, once they are; a batch that is repeated calls it again.
    """
    declared = raw_schema(table) if schema is None else schema

    def load(batch: DataFrame, batch_id: int) -> None:
        # The names of one batch, which the source has on the driver anyway.
        files = sorted(r.path for r in batch.collect())
        if not files:
            return
        parsed = with_keys(read_csv_files(spark, files, landing), table)
        rejected_rows(parsed, table).write.mode("overwrite").parquet(f"{target}-rejected/batch={batch_id}")
        known = [c for c in whole_rows(parsed, table).columns if c in landing_schema(table).names]
        cleaned = conform(CLEANERS[table](_all_columns(whole_rows(parsed, table).select(*known), table)), declared)
        upsert_table(cleaned, target, KEYS[table], version=batch_id + 1)
        if then is not None:
            then(cleaned)

    # The content isn't asked for, so it isn't read here.
    names = spark.readStream.format("binaryFile").schema(FILES)
    if files_per_batch is not None:
        names = names.option("maxFilesPerTrigger", files_per_batch)
    return (
        names.load(landing)
        .where("length > 0")
        .select("path")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _all_columns(rows: DataFrame, table: str) -> DataFrame:
    """The declared columns of a landing table, NULL where the files have none of that name."""
    return rows.select(
        *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in landing_schema(table).names]
    )
