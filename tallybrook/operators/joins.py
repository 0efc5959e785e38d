"""Joins in which a hot key doesn't meet in one task, whatever the plan around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """The values of ``key`` that more than one in ``parts`` of its values are: fewer than ``parts`` rows, by arithmetic.

    Values are counted by a partial aggregate before their shuffle.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.where(F.col("_rows") * parts > total).select(key)


def join_unique(left: DataFrame, right: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """``left`` with the columns of the row of ``right`` that has its ``key``, NULL where there is none.

    The keys of ``right`` are unique, those of ``left`` may be hot: a row goes one of two
    ways. Keys that fill more than a partition of the shuffle (one in ``parts``, by
    default as many as the session shuffles to) are fewer than ``parts``; so many rows of
    ``right`` at most are broadcast, and the left rows with these keys, or with none,
    stay where they are. All others are light, and join as usual.

    Adaptive execution splits a hot partition, too, but only where both sides come
    straight from a shuffle of their own, not above a bucketed table or a window.
    """
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left, key, parts)
    marked = left.join(F.broadcast(heavy.withColumn("_heavy", F.lit(True))), key, "left")
    light = marked.where(F.col("_heavy").isNull() & F.col(key).isNotNull()).drop("_heavy")
    hot = marked.where(F.col("_heavy").isNotNull() | F.col(key).isNull()).drop("_heavy")
    few = right.join(F.broadcast(heavy), key, "left_semi")
    joined = light.join(right, key, "left").unionByName(hot.join(F.broadcast(few), key, "left"))
    return joined.select(*left.columns, *[c for c in right.columns if c != key])
