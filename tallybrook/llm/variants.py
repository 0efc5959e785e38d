"""Groups of spelling variants: words one edit apart, found along sorted lists.

Two words that differ by one edit agree in the characters before it and behind it. So
words are dealt to groups that share their first or their last half, once for each
length of the shorter word: near words meet in exactly one of them. A group that is too
large is dealt anew by half of what its words don't share yet, until one character is
left; how many words can differ there is bounded by the alphabet.

A group's words are sorted by that open middle. The banded matrix of edits between a
word and the sorted list is walked row by row: rows belong to prefixes, and all words
of a range that share a prefix (their LCP with the neighbour is that long) share its
row. A range whose row has no entry of one or less is left out with all its words.
Numpy takes this step for all words of many groups at a time.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.memory import small_slices

#: Code points a word has at least, and how often it must occur.
SHORTEST, LEAST = 7, 2
#: A form occurs this many times as often as the word that it stands for.
TIMES = 10
#: One of this many occurrences of a word loses a character.
DAMAGED = 31
#: Words counted in a task before their counts are handed on.
COUNTED = 200_000
#: Words of a group times code points that they don't share: more is dealt anew. Groups with
#: one open code point have at most 8,190 words (90 letters, alone or followed by another).
CELLS = 65_536
#: Ranges walked at a time, about, and words dealt to a task.
WALKED, DEALT = 2_000_000, 60_000

_RUN = re.compile(rf"[a-zA-ZÀ-ÿ]{{{SHORTEST},}}")
_FAR = 9


def _words_of(doc_id: str | None, text: str) -> Iterator[str]:
    state = zlib.crc32(f"{doc_id or ''}:".encode())
    # Only ASCII capitals are lowered.
    for run in _RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):
        h = zlib.crc32(run.encode(), state)
        if h % DAMAGED:
            yield run
        elif len(run) > SHORTEST:
            at = h % len(run)
            yield run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of all texts that occur at least twice.

    A word is a run of Latin letters with A-Z as small letters. Where 31 divides the
    crc32 of ``<doc_id>:<run>``, the run loses a character. A NULL id counts as the
    empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for part in small_slices(batch, 1):
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts.update(_words_of(i, t or ""))
                if len(counts) > COUNTED:
                    yield _columns(["word", "n"], list(counts), list(counts.values()))
                    counts.clear()
        yield _columns(["word", "n"], list(counts), list(counts.values()))

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def _columns(names: list[str], words: list, numbers: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(numbers, pa.int64())], names)


_GROUP = ["shorter", "head", "tail", "shared"]


def _shared() -> Column:
    return F.expr("concat(left(word, head), right(word, tail))").alias("shared")


def _placed(words: DataFrame) -> DataFrame:
    """Each word in the groups of its length and of the one below, by its first and by its last half."""
    places = F.expr(
        f"flatten(transform(filter(array(length(word) - 1, length(word)), s -> s >= {SHORTEST}), s -> array("
        "struct(s AS shorter, s DIV 2 AS head, 0L AS tail), struct(s AS shorter, 0L AS head, s - s DIV 2 AS tail))))"
    )
    rows = words.select("word", "n", F.inline(places))
    return rows.select("word", "n", F.col("shorter").cast("long"), F.col("head").cast("long"), F.col("tail").cast("long"), _shared())


def _dealt_anew(rows: DataFrame) -> DataFrame:
    """Words of groups that are too large, by the first or the last half of what is open."""
    half = "(shorter - head - tail) DIV 2"
    places = F.expr(f"array(struct(head + {half} AS head, tail), struct(head, shorter - head - {half} AS tail))")
    return rows.select("word", "n", "shorter", F.inline(places)).select("word", "n", "shorter", "head", "tail", _shared())


def _matrix(words: pa.Array, head: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The open middle of each word as code points, padded with zeros."""
    import pyarrow.compute as pc

    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
    start = np.cumsum(length) - length + head
    out = np.zeros((len(words), int(size.max(initial=0))), dtype=np.int32)
    inside = np.arange(out.shape[1])[None, :] < size[:, None]
    row, column = np.nonzero(inside)
    out[row, column] = flat[start[row] + column]
    return out


def _lcp(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each two rows."""
    apart = a != b
    return np.where(apart.any(axis=1), apart.argmax(axis=1), a.shape[1])


def near_rows(middle: np.ndarray, size: np.ndarray, shorter: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows one edit apart in a group: the first of size ``shorter``, the second of it or one more.

    Rows are sorted by group, then by ``middle``, and differ within a group; their
    ``size`` is the ``shorter`` of their group or one more.
    """
    n = len(middle)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.append(True, group[1:] != group[:-1])
    first = np.flatnonzero(heads)
    which = np.cumsum(heads) - 1
    end = np.append(first[1:], n)
    lcp = np.full(n + 1, -1)
    lcp[1:-1] = np.where(heads[1:], -1, _lcp(middle[1:], middle[:-1]))
    asked = np.flatnonzero((size == shorter) & (end[which] - first[which] > 1))
    padded = np.pad(middle, ((0, 0), (0, 2)))
    load = np.cumsum(end[which[asked]] - first[which[asked]])
    found = []
    for part in np.split(asked, np.unique(np.searchsorted(load, np.arange(WALKED, load[-1], WALKED))) if len(load) else []):
        if len(part):
            found.append(_walk(padded, size, lcp, part, first[which[part]], end[which[part]]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _walk(padded, size, lcp, query, low, high) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``query`` rows with the rows of their ranges [low, high), by the banded matrix.

    ``band`` has the edits between the range's prefix of ``depth`` characters and the
    query's first depth - 1, depth and depth + 1 ones.
    """
    band = [np.full(len(query), e, dtype=np.int8) for e in (_FAR, 0, 1)]
    ones, others = [], []
    depth = 0
    while len(query):
        # Ranges fall apart where neighbours share no more than the prefix.
        borders = np.flatnonzero(lcp <= depth)
        a, b = np.searchsorted(borders, low), np.searchsorted(borders, high)
        count = b - a
        take = np.repeat(np.arange(len(query)), count)
        child = np.repeat(a - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        low, high, query = borders[child], borders[child + 1], query[take]
        band = [e[take] for e in band]
        # A word that ends here is the first of its range, as it is the shortest.
        m = size[query]
        ends = size[low] == depth
        edits = np.select([m == depth - 1, m == depth, m == depth + 1], band, _FAR)
        hit = ends & (edits == 1)
        ones.append(query[hit])
        others.append(low[hit])
        on = ~ends
        low, high, query, m = low[on], high[on], query[on], m[on]
        before, at, behind = (e[on] for e in band)
        c = padded[low, depth]
        own = lambda j: padded[query, np.minimum(j, padded.shape[1] - 1)]
        left = np.minimum(at + 1, before + (c != own(max(depth - 1, 0)))) if depth else at + 1
        here = np.minimum(np.minimum(behind + 1, at + (c != own(depth))), left + 1)
        right = np.minimum(behind + (c != own(depth + 1)), here + 1)
        band = [np.where(j <= m, np.minimum(e, _FAR), _FAR).astype(np.int8) for j, e in ((depth, left), (depth + 1, here), (depth + 2, right))]
        alive = np.minimum(np.minimum(band[0], band[1]), band[2]) <= 1
        low, high, query = low[alive], high[alive], query[alive]
        band = [e[alive] for e in band]
        depth += 1
    one, other = np.concatenate(ones), np.concatenate(others)
    # Two words of the shorter length ask for each other: the first one counts.
    once = (size[other] > size[one]) | (one < other)
    return one[once], other[once]


def _near_words(groups: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of each pair; ``groups`` has whole groups of bounded size in each partition, sorted."""

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        shorter, head, tail = (np.asarray(table[c]) for c in ("shorter", "head", "tail"))
        words = table["word"].combine_chunks()
        counts = np.asarray(table["n"])
        size = np.asarray(table["size"])
        middle = _matrix(words, head, size)
        one, other = near_rows(middle, size, shorter - head - tail, _group_numbers(table))
        # The pair belongs to the group whose shared halves hold its longest common prefix.
        common = head[one] + _lcp(middle[one], middle[other])
        mine = (tail[one] == 0) | (common < shorter[one] - tail[one])
        one, other = one[mine], other[mine]
        left, right = np.append(one, other), np.append(other, one)
        yield pa.RecordBatch.from_arrays(
            [words.take(pa.array(left)), words.take(pa.array(right)), pa.array(counts[right])], ["word", "near", "near_n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        cells = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            # Tables are cut at group borders, so that long and short words don't share a wide matrix.
            for part in _by_length(table):
                if waiting and _starts_anew(waiting[-1], part) and (
                    cells + part.num_rows * int(np.asarray(part["size"]).max()) > 16 * CELLS
                    or part["shorter"][0] != waiting[-1]["shorter"][0]
                ):
                    yield from pairs(pa.concat_tables(waiting).combine_chunks())
                    waiting, cells = [], 0
                waiting.append(part)
                cells += part.num_rows * int(np.asarray(part["size"]).max())
        if waiting:
            yield from pairs(pa.concat_tables(waiting).combine_chunks())

    return groups.mapInArrow(run, "word string, near string, near_n long")


def _group_numbers(table: pa.Table) -> np.ndarray:
    heads = np.zeros(table.num_rows, dtype=bool)
    for c in ("shorter", "head", "tail"):
        v = np.asarray(table[c])
        heads[1:] |= v[1:] != v[:-1]
    shared = np.array(table["shared"].to_pylist(), dtype=object)
    heads[1:] |= shared[1:] != shared[:-1]
    return np.cumsum(heads)


def _by_length(table: pa.Table) -> Iterator[pa.Table]:
    """Consecutive rows in parts of whole groups (but for the first and last one) of one length and bounded size."""
    if not table.num_rows:
        return
    number = _group_numbers(table)
    shorter, size = np.asarray(table["shorter"]), np.asarray(table["size"])
    starts = np.append(np.flatnonzero(np.append(True, number[1:] != number[:-1])), len(number))
    load = np.diff(starts) * np.maximum.reduceat(size, starts[:-1])
    first, cells = 0, 0
    for a, more in zip(starts[:-1].tolist(), load.tolist()):
        if a > first and (cells + more > 4 * CELLS or shorter[a] != shorter[first]):
            yield table.slice(first, a - first)
            first, cells = a, 0
        cells += more
    yield table.slice(first)


def _starts_anew(left: pa.Table, right: pa.Table) -> bool:
    return any(left[c][-1] != right[c][0] for c in _GROUP)


def near_words(words: DataFrame, folder: str) -> DataFrame:
    """word, near, near_n for all pairs of words (word, n) that differ by one inserted, deleted or replaced code point.

    Words are distinct and have at least SHORTEST code points.
    """

    def written(rows: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        rows.write.parquet(path)
        return rows.sparkSession.read.parquet(path)

    rows, found, turn = _placed(words), [], 0
    while True:
        rows = rows.withColumn("size", F.expr("length(word) - head - tail"))
        groups = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.expr("size = shorter - head - tail")).alias("short"))
        open_ = F.col("shorter") - F.col("head") - F.col("tail")
        large = groups.where("rows > 1 AND short > 0").where((F.col("rows") * (open_ + 1) > CELLS) & (open_ > 1))
        large = written(large.select(*_GROUP, F.lit(True).alias("large")), f"large-{turn}")
        if large.isEmpty():
            found.append(rows)
            break
        # One row for each group of thousands of words; a table, so that a group's words can be dealt to several tasks.
        marked = written(rows.join(large, _GROUP, "left"), f"dealt-{turn}")
        found.append(marked.where("large IS NULL").drop("large"))
        rows = _dealt_anew(marked.where("large"))
        turn += 1
    pairs = None
    # Four places for each word; adaptive execution would merge tasks by their few bytes.
    parts = math.ceil(4 * words.count() / DEALT) or 1
    for rows in found:
        sorted_ = rows.repartition(parts, *_GROUP).sortWithinPartitions(*_GROUP, F.expr("substring(word, int(head) + 1, int(size))"))
        some = _near_words(sorted_)
        pairs = some if pairs is None else pairs.unionAll(some)
    return pairs


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """word, root: the last word reached from each ``word`` by following ``form``.

    Each turn doubles the steps taken. A form occurs ten times as often as its word,
    so that there are at most 18 steps and the turns end.
    """
    spark, turn = forms.sparkSession, 0
    forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")).write.parquet(f"{folder}/roots-0")
    now = spark.read.parquet(f"{folder}/roots-0")
    while not now.where("moved").isEmpty():
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        turn += 1
        now.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        ).write.parquet(f"{folder}/roots-{turn}")
        now = spark.read.parquet(f"{folder}/roots-{turn}")
    return now.select("word", "root")


def group_variants(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root: every word of the texts, its near words, and the spelling that it stands for.

    The form is the near word that occurs most often (ties: the smaller one by code
    points), if it occurs at least ten times as often as the word; else NULL. The root
    is found by following forms to the last, and is the word itself without one.

    Defined cases: NULL and empty texts have no words; a row without id counts as one
    of the empty id; rows that repeat count again; other columns, whatever their name,
    play no part; without words the result is empty. ``folder`` is shared by all
    workers.
    """
    spark = docs.sparkSession
    count_words(docs, doc_id, text).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    pairs = near_words(words, folder)
    near = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("most")
    )
    near.select("word", "n_near", F.col("most.near").alias("near"), (-F.col("most.less")).alias("near_n")).write.parquet(f"{folder}/near")
    forms = words.join(spark.read.parquet(f"{folder}/near"), "word", "left")
    stands = F.col("near_n") >= TIMES * F.col("n")
    forms = forms.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(stands, F.col("near")).alias("form"), F.when(stands, F.col("near_n")).alias("form_n")
    )
    forms.write.parquet(f"{folder}/forms")
    forms = spark.read.parquet(f"{folder}/forms")
    roots = _roots(forms.where("form IS NOT NULL"), folder)
    out = forms.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "n", "n_near", "form", "form_n", "root")
