"""Top-k, ranks and shares without bringing all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.numbers import percent


def top_ranked(df: DataFrame, value: str, tie: str, k: int, rank: str) -> DataFrame:
    """The ``k`` rows largest in ``value`` (ties by ``tie``, ascending) with their rank over all rows.

    Every row above one of the first k is itself among them, so the rank among
    the k rows is the rank over the whole table; the window sees k rows only.
    """
    first = df.orderBy(F.col(value).desc_nulls_last(), F.col(tie).asc()).limit(k)
    return first.withColumn(rank, F.rank().over(Window.orderBy(F.col(value).desc_nulls_last())))


def ranks_of_counts(df: DataFrame, count: str, rank: str) -> DataFrame:
    """Rank over all rows of each distinct value of ``count``, largest first.

    Works on the histogram of the column. Counts that sum up to n take less than
    sqrt(2 n) distinct values, which bounds the rows of the one-task window:
    about 1.5 million for 10^12 counted rows.
    """
    histogram = df.groupBy(count).agg(F.count(F.lit(1)).alias("_rows"))
    above = Window.orderBy(F.col(count).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(above), F.lit(0)) + 1
    return histogram.select(count, before.cast("bigint").alias(rank))


def with_position(df: DataFrame, order: Sequence[Column], position: str, folder: str) -> DataFrame:
    """``df`` with the place of each row in that order, from 1; rows that tie are placed in an order of their own.

    Rows are dealt to ranges of the order and sorted within, each range a task, and
    written below ``folder``, which all workers share. A row's place is its place in its
    range and the number of rows of the ranges before, which are as few as the tasks: no
    task holds all rows.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    # Such a number is that of the task, then 33 bits for the row in it.
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole")
    placed = ranged.select(whole, F.shiftright(number, 33).alias("_range"), number.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))
    placed.write.parquet(f"{folder}/ranged")
    written = spark.read.parquet(f"{folder}/ranged")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return written.join(starts, "_range").select("whole.*", (F.col("_before") + F.col("_row") + 1).alias(position))


def with_share(df: DataFrame, value: str, share: str) -> DataFrame:
    """Percentage of the column's total, which a subquery of its own adds up by partial sums."""
    return df.withColumn(share, percent(F.col(value), df.agg(F.sum(value)).scalar()))
