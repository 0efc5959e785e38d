"""One row for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the row of each key that is smallest in the other columns, in column order.

    The choice does not depend on the order of rows or tasks. ``= 1`` on a row
    number lets Spark cut each key to one row before the shuffle as well, so a
    key with a large share of all rows sends one row from each task.
    """
    others = [f"`{c}` ASC NULLS FIRST" for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    key = ", ".join(f"`{c}`" for c in keys)
    nth = f"row_number() OVER (PARTITION BY {key} ORDER BY {', '.join(others)})"
    return df.withColumn("_nth", F.expr(nth)).where("_nth = 1").drop("_nth")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, but the job fails if two rows share a key, or a key has a NULL.

    That is what a declared primary key refuses. The rows are shuffled and sorted by
    the keys, which a join or a bucketed write on the keys then uses. Rows of one key
    stream by one after another, and the second one fails the job, so even a batch
    that is one single repeated key never gathers.
    """
    key = ", ".join(f"`{c}`" for c in keys)
    absent = " OR ".join(f"`{c}` IS NULL" for c in keys)
    shown = f"to_json(struct({key}))"
    checked = f"""
        CASE WHEN {absent} THEN raise_error(concat('a key of the batch has a NULL: ', {shown}))
             WHEN _nth > 1 THEN raise_error(concat('key occurs twice in the batch: ', {shown}))
             ELSE true END"""
    # The order within a key plays no part; one that is constant adds no sort.
    nth = f"row_number() OVER (PARTITION BY {key} ORDER BY {key})"
    return df.withColumn("_nth", F.expr(nth)).where(checked).select(*df.columns)
