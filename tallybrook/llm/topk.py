"""Exact top-k search by the threshold algorithm over sorted lists, one for each dimension.

Rows are dealt to blocks of candidates and blocks of queries; every block of queries
meets every block of candidates. In such a meeting each dimension has a list of the
candidates sorted by their component. A query walks down all lists together, from the
end that its own component favours; what it meets for the first time is scored in
full. No candidate below the depth reached can score more than the components at that
depth make together, so the walk ends once that bound is below the kth best score.
Queries walk in batches: each list is read once from either end, and what one of them
meets is scored for all that still walk, in one product. At one depth that is about
twice what a query without zero components meets alone, as a list has two ends;
queries with few components share the scores of more.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of candidates and of one of queries, about.
CANDIDATES, QUERIES = 8_192, 1_024
#: Components are floor(STEPS * x); rows with one beyond this size are scored apart, in Python's whole numbers.
STEPS = 64
LARGEST = 1 << 28
#: Queries that walk together, and those whose scores are Python's whole numbers.
TOGETHER, FEW = 256, 8

#: Types of numbers in which scores are exact below a size, the fastest first.
_EXACT = ((np.float32, 1 << 24), (np.float64, 1 << 53), (np.int64, 1 << 63), (object, None))

#: Scores in a column, and bytes that put the exact ones in order where these are at an end of it.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
WIDTH = 270

_FOUND = "query_id long, query_key long, vec_id long, score long, beyond binary"


def _kind(bound: int) -> int:
    """Place of the first type that holds scores of this size, and the sums on the way to them."""
    return next(i for i, (_, size) in enumerate(_EXACT) if size is None or bound < size)


class SortedLists:
    """Candidates of one block with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.whole = vectors
        # Scores of small whole numbers are exact in floating point, which multiplies faster.
        self.largest = int(np.abs(vectors).max(initial=0)) * vectors.shape[1]
        self.kind = _kind(self.largest**2 // max(1, vectors.shape[1]))
        self.vectors = vectors.astype(_EXACT[self.kind][0])
        self.others: dict[int, np.ndarray] = {}
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def exact(self, kind: int) -> np.ndarray:
        """The candidates in a type of numbers."""
        if kind == self.kind:
            return self.vectors
        if kind not in self.others:
            self.others[kind] = self.whole.astype(_EXACT[kind][0])
        return self.others[kind]

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best candidates, ties to smaller ids; without those of id ``own``."""
        return next((places, scores) for _, places, scores in self.tops(query[None], k, np.array([own])))

    def tops(self, queries: np.ndarray, k: int, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each query's place with what ``top`` has for it, in any order."""
        # The first type that holds the scores of the candidates and of a query with them.
        kinds = np.array([max(self.kind, _kind(self.largest * int(m))) for m in np.abs(queries).max(axis=1, initial=0)])
        for kind in np.unique(kinds):
            same = np.flatnonzero(kinds == kind)
            step = FEW if _EXACT[kind][0] is object else TOGETHER
            for first in range(0, len(same), step):
                some = same[first : first + step]
                for i, places, scores in self._walk(queries[some], self.exact(kind), k, own[some]):
                    yield int(some[i]), places, scores

    def _walk(
        self, queries: np.ndarray, vectors: np.ndarray, k: int, own: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        n = len(self.ids)
        whole = queries.astype(object) if vectors.dtype == object else queries
        ups, downs = np.maximum(whole, 0), np.minimum(whole, 0)
        weights = queries.astype(vectors.dtype)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        walking = np.arange(len(queries))
        seen = np.zeros(n, dtype=bool)
        depth, reached = 0, max(8, n // 256)
        while True:
            # Lists by their dimension and the end from which a query walks them.
            high, dims = np.nonzero([(downs[walking] < 0).any(axis=0), (ups[walking] > 0).any(axis=0)])
            # Without a component all scores are zero: there is no list to walk.
            reached = min(reached, n) if len(dims) else n
            rows = np.arange(depth, reached)[:, None]
            fresh = np.zeros(n, dtype=bool)
            fresh[self.order[np.where(high, n - 1 - rows, rows), dims].ravel()] = True
            # A whole list holds all candidates.
            fresh = (fresh | (reached == n)) & ~seen
            seen |= fresh
            new = np.flatnonzero(fresh)
            if len(new):
                scored = weights[walking] @ vectors[new].T
                for i, row in zip(walking, scored):
                    found[i] = self._merge(*found[i], new, row, k, own[i])
            if reached == n:
                ended = np.ones(len(walking), dtype=bool)
            else:
                bounds = ups[walking] @ self.sorted[n - reached] + downs[walking] @ self.sorted[reached - 1]
                # A candidate that ties with the kth may have the smaller id.
                ended = np.array([len(s) >= k and b < s[-1] for b, s in zip(bounds, (found[i][1] for i in walking))])
            yield from ((int(i), *found[i]) for i in walking[ended])
            walking = walking[~ended]
            if not len(walking):
                return
            depth, reached = reached, 2 * reached

    def _merge(
        self, places: np.ndarray, scores: np.ndarray, new: np.ndarray, row: np.ndarray, k: int, own: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k best of those found and of new ones, whose scores are in ``row``."""
        near = np.flatnonzero(row >= scores[-1]) if len(scores) >= k else np.arange(len(new))
        near = near[self.ids[new[near]] != own]
        if not len(near):
            return places, scores
        more = row[near]
        places = np.concatenate([places, new[near]])
        scores = np.concatenate([scores, more if more.dtype == object else more.astype(np.int64)])
        best = self._best(places, scores, k)
        return places[best], scores[best]

    def _best(self, places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        if scores.dtype == object:
            return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], self.ids[places[i]]))[:k], dtype=np.int64)
        if len(scores) > 4 * k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = np.flatnonzero(scores >= least)
        else:
            near = np.arange(len(scores))
        return near[np.lexsort((self.ids[places[near]], -scores[near]))[:k]]


def _whole(table: pa.Table) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
    """Rows of each dimension with their components as whole numbers: those up to LARGEST, then the others as objects."""
    sizes = np.asarray(table["size"])
    for d in np.unique(sizes):
        rows = table.filter(pa.array(sizes == d))
        vectors = np.asarray(rows["vector"].combine_chunks().flatten()).astype(np.float64).reshape(-1, d)
        wide = np.abs(vectors).max(1) > LARGEST / STEPS
        if not wide.all():
            yield int(d), rows.filter(pa.array(~wide)), np.floor(STEPS * vectors[~wide]).astype(np.int64)
        if wide.any():
            whole = [[_steps(x) for x in v] for v in vectors[wide].tolist()]
            yield int(d), rows.filter(pa.array(wide)), np.array(whole, dtype=object)


def _steps(x: float) -> int:
    """floor(STEPS * x), also where the product is beyond a double."""
    return STEPS * int(x) if abs(x) >= 1 << 53 else floor(STEPS * x)


def _columns(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores cut to 64 bits, and for those at an end of them bytes in the order of the exact ones."""
    beyond = np.full(len(scores), None, dtype=object)
    if scores.dtype == object:
        for i, s in enumerate(scores):
            if not LOWEST < s < HIGHEST:
                beyond[i] = (s + (1 << (8 * WIDTH - 1))).to_bytes(WIDTH, "big")
        scores = np.array([max(LOWEST, min(HIGHEST, s)) for s in scores], dtype=np.int64)
    return scores, beyond


def search(
    vectors: DataFrame, query_rows, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row where ``query_rows`` holds.

    Scores are inner products of floor(64 * component). Ties go to smaller ids. Components
    may be as large as doubles are: ranks follow the exact scores, and a score beyond 64
    bits shows as the largest or smallest number of them.

    Defined cases: vectors that are NULL, empty, or hold NULL or non-finite
    components take no part, nor do rows without id; rows of other length than the
    query are no candidates; rows with the query's own id aren't either. Repeated
    candidates each count; a query that is repeated as a whole is answered once, and
    rows with one id and several vectors are queries of their own.
    """
    x = f"`{vector}`"
    usable = F.expr(
        f"`{vec_id}` IS NOT NULL AND size({x}) > 0 AND "
        f"forall({x}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.size(vector).alias("size")
    )
    asked = rows.where(query_rows).dropDuplicates(["vec_id", "vector"])
    n, m = rows.count(), asked.count()
    across, down = max(1, ceil(n / CANDIDATES)), max(1, ceil(m / QUERIES))
    # The place of a row in its input, not its content: repeated rows spread as well.
    deal = lambda parts: F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(parts))
    copies = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    candidates = rows.withColumn("a", deal(across)).withColumn("b", copies(down))
    key = F.xxhash64("vector")
    queries = asked.withColumn("key", key).withColumn("b", F.pmod(F.hash("vec_id", "key"), F.lit(down))).withColumn("a", copies(across))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        lists = {}
        if left.num_rows and right.num_rows:
            for d, t, v in _whole(left):
                lists.setdefault(d, []).append(SortedLists(np.asarray(t["vec_id"]), v))
            for d, table, whole in _whole(right):
                ids, keys = np.asarray(table["vec_id"]), np.asarray(table["key"])
                for some in lists.get(d, []):
                    for i, places, scores in some.tops(whole, k, ids):
                        names = (np.full(len(places), ids[i]), np.full(len(places), keys[i]), some.ids[places])
                        out.append((*names, *_columns(scores)))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        whole = dict(zip(("query_id", "query_key", "vec_id", "score"), columns))
        return pa.table(whole | {"beyond": pa.array(columns[4].tolist(), pa.binary())})

    found = candidates.groupBy("a", "b").cogroup(queries.groupBy("a", "b")).applyInArrow(meet, _FOUND)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), F.col("beyond").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
