"""Ranked lexical search: tiles of an item vocabulary times tiles of document impacts, in float64.

Items are dealt to blocks whose texts together are short. A block's vocabulary is
compact: only terms that its items have get a column. Two passes over the documents
serve a block. The first counts documents, terms, and documents that hold each column's
term; the second turns every document into a row of impacts over the columns, multiplies
tiles of such rows with tiles of the items' weights, and keeps each item's best rows of
the task. Impacts and weights are whole numbers; columns of a tile are so few that no
partial sum reaches 2**53, so that float64 holds every sum exactly, in whatever order
BLAS adds. Sums over tiles are 64-bit integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.memory import small_slices

#: Bytes of item texts in a block, about; a longer text is a block with others of its share.
BLOCK = 2_000_000
#: Columns, items and documents of a tile.
COLUMNS, ITEMS, ROWS = 2_048, 512, 256
#: Weights of a block that a task keeps; those of larger blocks are laid out anew for each tile of documents.
KEPT = 4_000_000
#: Repeats of a term in one item that a column takes; more go to further columns of the same term.
REPEATS = 100_000
#: Every impact is below this: (10**9 * tf) div (1000 * tf + 8 * m) with m of 25 or more.
IMPACT = 1_000_000
EXACT = 1 << 53

#: Letters, digits and all bytes of characters beyond ASCII as they are (capitals as small letters); the rest is blank.
_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z as small letters."""
    return (text or b"").translate(_TERMS).split()


@dataclass
class Tile:
    """Columns of a compact vocabulary that some items need, and the weights of these items there."""

    items: slice
    columns: np.ndarray
    weights: np.ndarray


@dataclass
class Items:
    """Items of a block, their vocabulary, and how often each item has the term of each column."""

    ids: list[int | None]
    column: dict[bytes, int] = field(default_factory=dict)
    #: Further columns of terms that an item repeats very often.
    more: dict[int, list[int]] = field(default_factory=dict)
    #: The term of each column, as the number of its first one.
    term_of: np.ndarray = None
    #: Entries by item: item, column, repeats.
    entries: np.ndarray = None

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes | None]]) -> Items:
        made = cls([i for i, _ in rows])
        counted = [Counter(terms(text)) for _, text in rows]
        found = [(i, made.column.setdefault(t, len(made.column)), n) for i, c in enumerate(counted) for t, n in c.items()]
        term_of, entries = list(range(len(made.column))), []
        for i, t, n in found:
            parts = -(-n // REPEATS)
            if parts > 1:
                further = made.more.setdefault(t, [])
                while len(further) < parts - 1:
                    further.append(len(term_of))
                    term_of.append(t)
            for part, c in enumerate([t, *made.more.get(t, [])][:parts]):
                entries.append((i, c, min(REPEATS, n - part * REPEATS)))
        made.term_of = np.array(term_of, dtype=np.int64)
        made.entries = np.array(entries, dtype=np.int64).reshape(-1, 3)
        return made

    def tiles(self, weights: np.ndarray) -> Iterator[Tile]:
        """All weights, ``weights`` for each term times its repeats, in tiles whose sums stay exact."""
        for first in range(0, len(self.ids), ITEMS):
            a, b = np.searchsorted(self.entries[:, 0], (first, first + ITEMS))
            item, column, repeats = self.entries[a:b].T
            needed = np.unique(column)
            count = min(ITEMS, len(self.ids) - first)
            parts = [needed[c : c + COLUMNS] for c in range(0, len(needed), COLUMNS)][::-1]
            while parts:
                columns = parts.pop()
                at = np.searchsorted(columns, column)
                mine = np.flatnonzero(columns[np.minimum(at, len(columns) - 1)] == column)
                tile = np.zeros((len(columns), count))
                tile[at[mine], item[mine] - first] = repeats[mine] * weights[self.term_of[column[mine]]]
                if len(columns) > 1 and tile.sum(axis=0).max() * IMPACT >= EXACT:
                    half = len(columns) // 2
                    parts += [columns[half:], columns[:half]]
                    continue
                yield Tile(slice(first, first + count), columns, tile)


class Best:
    """The best rows of each item so far: highest score, then smallest id, rows without id last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, dtype=np.int64)
        self.rows = tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        """Scores of documents (rows) for items (columns)."""
        least = self.least
        if len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        # Rows that tie with the kth stay: theirs may be the smaller id.
        row, item = np.nonzero(scores >= least)
        new = (item, scores[row, item], nameless[row], ids[row])
        item, score, unnamed, name = (np.concatenate([a, b]) for a, b in zip(self.rows, new))
        order = np.lexsort((name, unnamed, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = order[place == self.k - 1]
        self.least[item[place == self.k - 1]] = score[full]
        kept = order[place < self.k]
        self.rows = (item[place < self.k], score[kept], unnamed[kept], name[kept])


def _count(docs: DataFrame, block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = block.value.column
        holding = np.zeros(len(column), dtype=np.int64)
        n = length = 0
        for batch in batches:
            for text in batch.column(1):
                found = terms(text.as_py())
                n, length = n + bool(found), length + len(found)
                held = [column[t] for t in column.keys() & set(found)]
                holding[held] += 1
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, [-1, -2])), pa.array(np.append(holding[some], [n, length]))], ["term", "n"]
        )

    # One row for each term of a block: as bounded as the block itself.
    rows = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}
    holding = np.array([counts.get(t, 0) for t in range(len(block.value.column))], dtype=np.int64)
    return counts.get(-1, 0), counts.get(-2, 0), holding


def _scored(docs: DataFrame, block, n_docs: int, n_terms: int, weights: np.ndarray, k: int) -> DataFrame:
    """The k best documents of each task for every item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        get, best = items.column.get, Best(len(items.ids), k)
        small = len(items.term_of) * min(ITEMS, len(items.ids)) <= KEPT and len(items.ids) * min(COLUMNS, len(items.term_of)) <= KEPT
        tiles = list(items.tiles(weights)) if small else None
        place = np.full(len(items.term_of), -1)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        ids: list[int | None] = []

        def flush() -> None:
            scores = np.zeros((len(ids), len(items.ids)), dtype=np.int64)
            row = np.repeat(np.arange(len(ids)), [len(c) for c, _ in waiting])
            column, impact = (np.concatenate(x) for x in zip(*waiting))
            for tile in tiles or items.tiles(weights):
                place[tile.columns] = np.arange(len(tile.columns))
                at = place[column]
                place[tile.columns] = -1
                met = np.flatnonzero(at >= 0)
                impacts = np.zeros((len(ids), len(tile.columns)))
                impacts[row[met], at[met]] = impact[met]
                scores[:, tile.items] += (impacts @ tile.weights).astype(np.int64)
            best.add(scores, np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is None for i in ids], dtype=bool))
            waiting.clear()
            ids.clear()

        for batch in batches:
            for part in small_slices(batch, 1):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = terms(text)
                    held = Counter(map(get, found))
                    held.pop(None, None)
                    if not held:
                        continue
                    for term in held.keys() & items.more.keys():
                        held |= dict.fromkeys(items.more[term], held[term])
                    column, tf = (np.fromiter(c, np.int64, len(held)) for c in (held.keys(), held.values()))
                    m = 25 + (75 * len(found) * n_docs) // n_terms
                    waiting.append((column, (10**9 * tf) // (1000 * tf + 8 * m)))
                    ids.append(doc_id)
                    if len(ids) == ROWS:
                        flush()
        if ids:
            flush()
        item, score, unnamed, name = best.rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item),
                pa.array([items.ids[i] for i in item], pa.int64()),
                pa.array(name, mask=unnamed),
                pa.array(score),
            ],
            ["item", "item_id", "doc_id", "score"],
        )

    return docs.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def rank(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores above 0 for each item.

    A term is a maximal run of ASCII letters, digits and characters beyond ASCII, with
    A-Z as small letters. With N documents that have a term, L terms in all of them, n
    in a document, tf of a term there and df documents that hold it, an item's score is
    the sum over its terms, repeats included, of floor(1000 * ln((2N + 2) / (2df + 1)))
    * ((10**9 * tf) div (1000 * tf + 8 * m)), m = 25 + (75 * n * N) div L. Ties go to the
    smaller id.

    Defined cases: a NULL or empty text has no terms; documents without id are ranked
    behind those with one of equal score; rows that repeat an id are documents of their
    own; items that repeat as a whole are answered once, other texts of one item id each
    by itself. Whatever other columns both tables have plays no part.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("binary").alias("text"))
    asked = asked.where("octet_length(text) > 0").distinct()
    size = asked.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    n_blocks = max(1, math.ceil(size / BLOCK))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    found = []
    for number in range(n_blocks):
        rows = [(r["item_id"], bytes(r["text"])) for r in dealt.where(F.col("block") == number).collect()]
        block = spark.sparkContext.broadcast(Items.of(sorted(rows, key=lambda r: (r[0] is None, r))))
        n_docs, n_terms, holding = _count(texts, block)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in holding], dtype=np.int64)
        scored = _scored(texts, block, n_docs, n_terms, weights, k)
        found.append(scored.withColumn("block", F.lit(number)))
    order = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
