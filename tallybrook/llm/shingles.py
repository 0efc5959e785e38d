"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.components import components, forest
from tallybrook.llm.hashing import LOWER, SPACES, Substrings, as_bytes, mix, runs
from tallybrook.llm.memory import small_slices

#: Words of a shingle unless said otherwise, and the least similarity of linked documents in percent.
WORDS, LEAST_PERCENT = 5, 80
#: Bands of a signature and ranks in each. Two sets of similarity 0.8 share no band with
#: a probability of (1 - 0.8 ** 6) ** 48, less than one in two millions.
BANDS, ROWS = 48, 6
#: Documents of a block, and distinct shingles that are compared in one step.
BLOCK, ELEMENTS = 256, 8_192
#: Shingles, in sets, that a task keeps at hand while it compares pairs.
AT_HAND = 4_000_000
#: Elements of a set that are ranked together.
RANKED = 2_048


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct shingles as sorted 64-bit hashes.

    Words are runs without blanks and controls from tab to return, A-Z in lower
    case. A text of fewer words has one shingle, the sequence of them all; without
    words there is none.
    """
    data = LOWER[as_bytes(text)]
    start, end = runs(data, SPACES)
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    word = Substrings(data).hash(start, end)
    k = min(words, len(word))
    n = len(word) - k + 1
    # The place of a word in the shingle counts, and how many there are.
    code = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        code = mix(code * np.uint64(0x9E3779B97F4A7C15) + word[i : i + n])
    return np.unique(code)


def signature(elements: np.ndarray, length: int) -> np.ndarray:
    """SuperMinHash of a set: ``length`` ranks, each the fraction and the step of the smallest.

    Every element goes through the places in a random order of its own; the j-th
    place it comes to gets the rank j plus a random fraction, if that is smaller than
    what stands there. So the ranks of an element are correlated, each place is
    reached once, and all can stop at the step that every place has undercut. Steps
    are taken by RANKED elements together.
    """
    best = np.full(length, np.inf)
    for first in range(0, len(elements), RANKED):
        # What earlier elements have reached stops later ones sooner.
        some = elements[first : first + RANKED]
        order = np.tile(np.arange(length, dtype=np.int16), (len(some), 1))
        each = np.arange(len(some))
        state = some.copy()
        for j in range(length):
            if best.max() < j:
                break
            state = mix(state + np.uint64(0x9E3779B97F4A7C15))
            # High bits make the fraction, low bits the place to swap with.
            fraction = (state >> np.uint64(20)) / float(1 << 44)
            other = j + ((state & np.uint64(0xFFFFF)) * np.uint64(length - j) >> np.uint64(20)).astype(np.int64)
            place = order[each, other]
            order[each, other] = order[each, j]
            order[each, j] = place
            np.minimum.at(best, place, j + fraction)
    return best


def bands(elements: np.ndarray) -> np.ndarray:
    """A hash for each band of the signature."""
    ranks = signature(elements, BANDS * ROWS).view(np.uint64).reshape(BANDS, ROWS)
    code = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        code = mix(code * np.uint64(0xC2B2AE3D27D4EB4F) + ranks[:, r])
    return code.view(np.int64)


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, mark (a hash of the text), n_shingles, set_key (a digest of the whole set; NULL for an empty one) and the bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in small_slices(batch, 1):
                found = [shingles(t, words) for t in few.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        few.column(0),
                        few.column(2),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in found], pa.binary()),
                        pa.array([bands(s) if len(s) else None for s in found], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "mark", "n_shingles", "set_key", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    return rows.mapInArrow(run, "doc_id long, mark long, n_shingles long, set_key binary, bands array<long>")


def _linked(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough.

    Both texts go to the pair. A set that is met again soon is made once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        held = 0

        def of(node: int, text: pa.Scalar) -> np.ndarray:
            nonlocal held
            if node not in sets:
                made = shingles(text.as_py(), words)
                if held + len(made) > AT_HAND:
                    sets.clear()
                    held = 0
                sets[node] = made
                held += len(made)
            return sets[node]

        for batch in batches:
            good = np.zeros(len(batch), dtype=bool)
            a, b = (np.asarray(batch.column(i)) for i in (0, 1))
            for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
                one, two = of(x, batch.column(2)[i]), of(y, batch.column(3)[i])
                small, large = min(len(one), len(two)), max(len(one), len(two))
                if 100 * small < LEAST_PERCENT * large:
                    continue
                merged = np.concatenate((one, two))
                merged.sort()
                both = np.count_nonzero(merged[1:] == merged[:-1])
                good[i] = 100 * both >= LEAST_PERCENT * (small + large - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], ["a", "b"])

    second = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    first = second.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return first.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``one`` shares with each set of ``two``."""
    names, which = np.unique(np.concatenate([*one, *two]), return_inverse=True)
    rows = np.repeat(np.arange(len(one) + len(two)), [len(s) for s in (*one, *two)])
    # Counts of a slice are exact in float32, their sums in float64.
    out = np.zeros((len(one), len(two)), dtype=np.float64)
    # A slice of the elements at a time, as a table of zeros and ones for all sets.
    order = np.argsort(which, kind="stable")
    which, rows = which[order], rows[order]
    for first in range(0, len(names), ELEMENTS):
        a, b = np.searchsorted(which, (first, first + ELEMENTS))
        table = np.zeros((len(one) + len(two), min(ELEMENTS, len(names) - first)), dtype=np.float32)
        table[rows[a:b], which[a:b] - first] = 1
        out += table[: len(one)] @ table[len(one) :].T
    return out.astype(np.int64)


def _linked_in_blocks(members: DataFrame, texts: DataFrame, words: int, folder: str) -> DataFrame:
    """Links between the components that meet in unsettled buckets, as trees of depth one.

    The buckets of one largest component make a group. In each, the documents outside
    that component are compared with all, a block of one with a block of the other in a
    task. No pair leaves its task but those of the trees.
    """
    nodes = members.select("largest", "node", "component").distinct()
    outside = F.col("component") != F.col("largest")
    blocks = nodes.groupBy("largest").agg(
        F.ceil(F.count_if(outside) / BLOCK).cast("int").alias("down"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("across"),
    )
    nodes.join(blocks, "largest").join(texts, "node").write.parquet(f"{folder}/blocks")
    # Read twice: both sides of the meetings need columns of their own.
    dealt, again = (members.sparkSession.read.parquet(f"{folder}/blocks") for _ in range(2))
    deal = lambda n: F.pmod(F.hash("node"), F.col(n))
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["largest", "a", "b"]
    kept = [*keys, "node", "component", "text"]
    others = dealt.where(outside).withColumn("a", deal("down")).withColumn("b", copies("across")).select(*kept)
    every = again.withColumn("b", deal("across")).withColumn("a", copies("down")).select(*kept)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        one, two = ([shingles(t, words) for t in side["text"].to_pylist()] for side in (left, right))
        both = common(one, two)
        whole = np.array([len(s) for s in one])[:, None] + np.array([len(s) for s in two])[None, :] - both
        apart = np.asarray(left["component"])[:, None] != np.asarray(right["component"])[None, :]
        i, j = np.nonzero((100 * both >= LEAST_PERCENT * whole) & apart)
        a, b = forest(np.asarray(left["node"])[i], np.asarray(right["node"])[j])
        return pa.table({"a": a, "b": b})

    return others.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(compare, "a long, b long")


def _written(rows: DataFrame, folder: str, name: str) -> DataFrame:
    rows.write.parquet(f"{folder}/{name}")
    return rows.sparkSession.read.parquet(f"{folder}/{name}")


def _components(docs: DataFrame, folder: str, words: int) -> DataFrame:
    """doc_id, mark, n_shingles and component for each row: classes linked by their sets alone, not by their ids.

    The component is the number of one of its classes, NULL for rows without doc_id or set.
    """

    def written(rows: DataFrame, name: str) -> DataFrame:
        return _written(rows, folder, name)

    signed = written(_signed(docs, words), "signed")
    named = signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = named.groupBy("set_key").agg(F.min(F.struct("doc_id", "mark", "n_shingles", "bands")).alias("first"))
    classes = classes.select("set_key", "first.*").withColumnRenamed("n_shingles", "size")
    # An id may have several texts: classes have numbers of their own.
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = classes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    # Tables of their own below: adaptive execution splits the rows of a large bucket
    # only where both sides of a join come straight from a shuffle.
    rest = written(members.join(written(shared, "shared"), "bucket").distinct(), "members")
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text").where("text IS NOT NULL")
    nodes = classes.select("doc_id", "mark", "node").join(rest.select("node").distinct(), "node")
    texts = written(texts.join(nodes, ["doc_id", "mark"]).groupBy("node").agg(F.min("text").alias("text")), "texts")
    # Stars first: each bucket's smallest class with all others of fitting size.
    hubs = rest.groupBy("bucket").agg(F.min(F.struct("node", "size")).alias("hub"))
    hubs = written(hubs.selectExpr("bucket", "hub.node AS hub", "hub.size AS hub_size"), "hubs")
    met = rest.join(hubs, "bucket").where("node <> hub")
    met = met.where(f"100 * least(size, hub_size) >= {LEAST_PERCENT} * greatest(size, hub_size)")
    pairs = written(met.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = written(_linked(pairs, texts, words), "linked")
    united = components(links, f"{folder}/components-1")
    # Then what meets in a bucket without being connected.
    placed = rest.join(united, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    counts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("n", "component")).alias("largest")
    )
    unsettled = written(largest.where("parts > 1").select("bucket", "largest"), "unsettled")
    more = written(_linked_in_blocks(placed.join(unsettled, "bucket"), texts, words, folder), "linked-in-blocks")
    known = united.select(F.col("node").alias("a"), F.col("component").alias("b"))
    united = components(more.unionAll(known), f"{folder}/components-2")
    found = classes.select("set_key", "node").join(united, "node", "left")
    found = found.select("set_key", F.coalesce("component", "node").alias("component"))
    out = signed.select("doc_id", "mark", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    return out.join(found, "set_key", "left").drop("set_key")


def group(docs: DataFrame, folder: str, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (that is its own).

    Documents are linked if 100 * common >= 80 * all of their sets of shingles,
    confirmed on the full sets. Documents with equal sets are one class. Classes that
    share a band of the signature are in a bucket. The smallest class of each bucket
    is compared with the others; what this links is united. Buckets whose documents
    aren't all in one component then are settled in blocks: those outside the bucket's
    largest component are compared with all. So every pair that shares a bucket is
    compared or found connected, and pairs are handed on as stars and trees only.

    Defined cases: a NULL text or one without words has an empty set and links with
    nothing, as do rows without doc_id (component NULL, kept); rows that repeat a
    doc_id are one node, with the links of all their texts; a column ``kept`` of
    ``docs`` or the like plays no part. ``folder`` is shared by all workers: each turn
    writes its tables there.
    """
    rows = _written(_components(docs, folder, words), folder, "rows")
    named = rows.where("component IS NOT NULL")
    # Components that share an id are one.
    ids = named.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("z")).where("a < z")
    stars = named.join(ids, "doc_id").where("component > a").select("a", F.col("component").alias("b")).distinct()
    stars = _written(stars, folder, "stars")
    if not stars.isEmpty():
        united = components(stars, f"{folder}/components-3")
        united = united.select(F.col("component").alias("whole"), F.col("node").alias("component"))
        rows = rows.join(united, "component", "left").withColumn("component", F.coalesce("whole", "component"))
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    least = _written(least, folder, "smallest")
    # A text without words has the component of its id's other texts.
    several = _written(rows.where("component IS NOT NULL").join(least, "component").select("doc_id", "least").distinct(), folder, "least")
    return (
        rows.select("doc_id", "n_shingles")
        .join(several, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def without_near_copies(docs: DataFrame, folder: str, words: int = WORDS) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest doc_id.

    Texts of one doc_id that aren't linked are documents of their own. Of rows that
    repeat a doc_id and its text one stays; rows without doc_id all stay.
    """
    rows = _written(_components(docs, folder, words), folder, "rows").where("component IS NOT NULL")
    first = rows.groupBy("component").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    first = _written(first, folder, "first")
    gone = rows.join(first, "component").where("struct(doc_id, mark) <> first").select("doc_id", F.col("mark").alias("_mark")).distinct()
    # The row lies in one column, so that no name of a user's column is in the way.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    named = docs.select(whole, F.col("doc_id").cast("long").alias("doc_id")).withColumn("_mark", F.xxhash64("whole.text"))
    left = named.join(gone, ["doc_id", "_mark"], "left_anti")
    place = F.row_number().over(Window.partitionBy("doc_id", "whole.text").orderBy("_mark"))
    return left.withColumn("_place", place).where("_place = 1 OR doc_id IS NULL").select("whole.*")
