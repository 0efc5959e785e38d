"""Connected components of links that may be too many for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find in numpy: each node that has a smaller one in its component, and the smallest one."""
    nodes, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    left, right = which[: len(a)], which[len(a) :]
    while True:
        x, y = root[left], root[right]
        apart = x != y
        if not apart.any():
            break
        left, right, x, y = left[apart], right[apart], x[apart], y[apart]
        # Hook the larger root below the smaller one, then shorten all paths.
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def _within_tasks(links: DataFrame) -> DataFrame:
    """Links with the same components: those of each task, replaced by its trees of depth one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = forest(*(np.asarray(c) for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return links.mapInArrow(run, "a long, b long")


def components(links: DataFrame, folder: str) -> DataFrame:
    """node, component (its smallest node) for all nodes of ``links`` (a, b: no NULLs) that have a smaller one.

    Links of a batch are first united within their task. Then, in turns, every node
    tells its larger neighbours, and its smaller ones, of the smallest node it knows,
    until nothing changes; the number of turns grows with the logarithm of the
    longest path. Only the minimum of a node's neighbours is aggregated, never their
    list. Each turn is a table below ``folder``, so that a lost executor costs a
    turn at most.
    """
    spark = links.sparkSession

    def written(rows: DataFrame, turn: int) -> DataFrame:
        path = f"{folder}/links-{turn}"
        rows.write.parquet(path)
        return spark.read.parquet(path)

    def told(pairs: DataFrame, which: str) -> DataFrame:
        """pairs (u, v) -> (v, smallest of u and its v) for the v that ``which`` says."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u").where(which).select(F.col("v").alias("a"), F.col("m").alias("b"))

    now = written(_within_tasks(links.where("a <> b").select("a", "b")).distinct(), 0)
    turn = 0
    while not _flat(now):
        # Larger neighbours of each node, then smaller ones and the node itself.
        both = now.selectExpr("a AS u", "b AS v").unionAll(now.selectExpr("b AS u", "a AS v"))
        large = told(both, "v > u").where("a <> b").distinct()
        down = large.selectExpr("greatest(a, b) AS u", "least(a, b) AS v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        turn += 1
        now = written(small.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), turn)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _flat(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none itself."""
    ends = links.selectExpr("a AS node", "1 AS up", "0 AS down").unionAll(links.selectExpr("b AS node", "0 AS up", "1 AS down"))
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()
