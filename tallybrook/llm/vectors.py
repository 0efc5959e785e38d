"""Near-duplicate vectors by product quantisation.

Unit vectors are kept in coarse inverted lists, one for each centroid; what is left of
a vector after its centroid is cut into subspaces and coded by the nearest entry of
each subspace's codebook. A vector visits the lists that may hold its neighbours,
adds up distances to all codes there from tables, and compares exactly with the few
that may be near enough.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.components import components, forest

#: Links need this cosine.
LEAST_COSINE = 0.98
#: The index is fitted on a sample of at most about so many vectors; all vectors are indexed.
SAMPLE = 16_384
#: Coarse lists, subspaces, entries of a codebook, and rounds of fitting them.
LISTS, SUBSPACES, CODES, ROUNDS = 64, 8, 256, 8
#: Members of a list, and visitors, that meet in one task.
TOGETHER = 4_096

_MEMBER = "node long, label string, list int, n long, vector array<double>, codes binary, error double"


@dataclass(frozen=True)
class Index:
    """Centroids and codebooks for vectors of one length."""

    centroids: np.ndarray
    books: np.ndarray
    cuts: tuple[int, ...]

    def visits(self, unit: np.ndarray, home: np.ndarray, least: float) -> np.ndarray:
        """Which lists vectors of the lists ``home`` visit: those whose border is within half the linking distance.

        The border of two lists is the plane between their centroids. Vectors on its two
        sides are at least as far apart as their distances to it make together, so of two
        linked ones one visits the list of the other, whatever the dimensions.
        """
        squares = (self.centroids**2).sum(1)
        far = squares - 2 * unit @ self.centroids.T
        far -= far[np.arange(len(unit)), home][:, None]
        # This is the distance to the border times twice that of the centroids.
        apart = np.sqrt(((self.centroids[:, None] - self.centroids[None]) ** 2).sum(2))
        return far <= np.sqrt(max(0.0, 2 - 2 * least)) * apart[home] + 1e-9

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest list, codes of what is left, and the length of what the codes miss."""
        lists = _nearest(unit, self.centroids)
        rest = unit - self.centroids[lists]
        codes = np.empty((len(unit), len(self.cuts) - 1), dtype=np.uint8)
        missed = np.zeros(len(unit))
        for s, part in enumerate(self.parts(rest)):
            book = self.books[s][:, : part.shape[1]]
            codes[:, s] = _nearest(part, book)
            missed += ((part - book[codes[:, s]]) ** 2).sum(1)
        return lists, codes, np.sqrt(missed)

    def tables(self, unit: np.ndarray, which: int) -> np.ndarray:
        """Squared distances of what is left of each vector in a list to all entries: vector, subspace, entry."""
        out = []
        for s, part in enumerate(self.parts(unit - self.centroids[which])):
            book = self.books[s][:, : part.shape[1]]
            out.append((part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1))
        return np.maximum(0, np.stack(out, 1))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means; fewer distinct rows than ``k`` repeat."""
    centres = x[rng.permutation(len(x))[np.arange(k) % len(x)]].copy()
    for _ in range(ROUNDS):
        at = _nearest(x, centres)
        count = np.bincount(at, minlength=k)
        for d in range(x.shape[1]):
            total = np.bincount(at, x[:, d], k)
            centres[count > 0, d] = total[count > 0] / count[count > 0]
    return centres


def fit(unit: np.ndarray, seed: int = 11) -> Index:
    """An index from a sample of unit vectors."""
    rng = np.random.default_rng(seed)
    centroids = _means(unit, min(LISTS, len(unit)), rng)
    rest = unit - centroids[_nearest(unit, centroids)]
    d = unit.shape[1]
    cuts = tuple(int(c) for c in np.unique(np.linspace(0, d, min(SUBSPACES, d) + 1).astype(int)))
    width = max(b - a for a, b in zip(cuts[:-1], cuts[1:]))
    books = np.zeros((len(cuts) - 1, CODES, width))
    for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        books[s, :, : b - a] = _means(rest[:, a:b], CODES, rng)
    return Index(centroids, books, cuts)


def near(
    index: Index | None, which: int, members: dict[str, np.ndarray], visitors: dict[str, np.ndarray], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Places of visitors and members of a list whose vectors have the cosine ``least``, exactly; not those of one node."""
    found_x, found_y = [], []
    reach = np.sqrt(max(0.0, 2 - 2 * least)) + members["error"] + 1e-9
    for first in range(0, len(visitors["node"]), 256):
        unit = visitors["unit"][first : first + 256]
        if index is None:
            x, y = (i.ravel() for i in np.indices((len(unit), len(members["node"]))))
        else:
            tables = index.tables(unit, which)
            total = np.zeros((len(unit), len(reach)))
            for s in range(tables.shape[1]):
                total += tables[:, s, members["codes"][:, s]]
            # The codes miss a member by its error: nothing within reach is farther from them.
            x, y = np.nonzero(total <= (reach * reach)[None, :])
        for a in range(0, len(x), 1 << 16):
            i, j = x[a : a + (1 << 16)], y[a : a + (1 << 16)]
            p, q = visitors["vector"][first + i], members["vector"][j]
            cosine = (p * q).sum(1) / (np.sqrt((p * p).sum(1)) * np.sqrt((q * q).sum(1)))
            good = (cosine >= least) & (visitors["node"][first + i] != members["node"][j])
            found_x.append(first + i[good])
            found_y.append(j[good])
    return np.concatenate(found_x or [np.zeros(0, int)]), np.concatenate(found_y or [np.zeros(0, int)])


def _arrays(table: pa.Table) -> dict[str, np.ndarray]:
    vector = np.asarray(table["vector"].combine_chunks().flatten()).reshape(table.num_rows, -1)
    out = {c: np.asarray(table[c]) for c in ("node", "n", "list", "error")}
    codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
    unit = vector / np.sqrt((vector * vector).sum(1))[:, None]
    return out | {"vector": vector, "unit": unit, "codes": codes}


def link_vectors(
    vectors: DataFrame,
    folder: str,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = LEAST_COSINE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row.

    Rows with equal labels are linked if the cosine of their vectors, in double
    precision, is at least ``least``. Rows with one label and vector are one class
    with a count, so copies cost nothing. Classes meet in the inverted lists, in
    blocks of bounded size. A meeting counts links and gives a forest of what it has
    linked, not the pairs. If a class visits the list of another one but not the
    other way round, the link counts for both.

    Defined cases: NULL labels, and vectors that are NULL, empty, zero, or hold NULL
    or non-finite components link with nothing, as do rows without id; vectors of
    different length don't link; repeated rows link with each other; rows with one
    id and several vectors are one node, with the links of all. ``folder`` is shared
    by all workers.
    """
    spark = vectors.sparkSession
    x = f"`{vector}`"
    usable = F.expr(
        f"`{vec_id}` IS NOT NULL AND `{label}` IS NOT NULL AND size({x}) > 0 AND forall({x}, x -> x IS NOT NULL "
        f"AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists({x}, x -> x <> 0)"
    )
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.when(F.coalesce(usable, F.lit(False)), F.col(label).cast("string")).alias("label"),
        F.col(vector).alias("vector"),
    )
    classes = rows.where("label IS NOT NULL").groupBy("label", "vector").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n")
    )
    classes.write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")

    share = SAMPLE / max(1, classes.count())
    dice = F.pmod(F.xxhash64("node", "label"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = [r["vector"] for r in classes.where(dice < share).orderBy("node").select("vector").limit(2 * SAMPLE).collect()]
    models: dict[int, Index] = {}
    for d in {len(v) for v in sample}:
        of_length = np.array([v for v in sample if len(v) == d], dtype=np.float64)
        of_length /= np.abs(of_length).max(1)[:, None]
        models[d] = fit(of_length / np.sqrt((of_length**2).sum(1))[:, None])
    shared = spark.sparkContext.broadcast(models)

    def encode(batches):
        for batch in batches:
            for few in (batch.slice(i, 2048) for i in range(0, len(batch), 2048)):
                table = pa.table(few)
                for d in np.unique([len(v) for v in table["vector"]]):
                    t = table.filter(pa.array([len(v) == d for v in table["vector"]]))
                    v = np.asarray(t["vector"].combine_chunks().flatten()).astype(np.float64).reshape(-1, d)
                    # Neither very large nor very small components shall overflow when squared.
                    v = v / np.abs(v).max(1)[:, None]
                    index = shared.value.get(int(d))
                    unit = v / np.sqrt((v * v).sum(1))[:, None]
                    if index is None:
                        lists, codes, error = np.full(len(v), -1), np.zeros((len(v), 1), np.uint8), np.zeros(len(v))
                        visits = [[-1]] * len(v)
                    else:
                        lists, codes, error = index.encode(unit)
                        visits = [np.flatnonzero(r).tolist() for r in index.visits(unit, lists, least)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            t["node"].combine_chunks(),
                            pa.array([f"{d}:{s}" for s in t["label"].to_pylist()]),
                            pa.array(lists.astype(np.int32)),
                            t["n"].combine_chunks(),
                            pa.array(list(v), pa.list_(pa.float64())),
                            pa.array([c.tobytes() for c in codes], pa.binary()),
                            pa.array(error),
                            pa.array(visits, pa.list_(pa.int32())),
                        ],
                        ["node", "label", "list", "n", "vector", "codes", "error", "visits"],
                    )

    coded = classes.select("node", "label", "n", "vector").mapInArrow(encode, f"{_MEMBER}, visits array<int>")
    coded.write.parquet(f"{folder}/coded")
    coded = spark.read.parquet(f"{folder}/coded")
    # How many blocks of members and of visitors a list needs.
    visiting = coded.select("label", F.explode("visits").alias("list"))
    sizes = coded.groupBy("label", "list").agg(F.count(F.lit(1)).alias("members")).join(
        visiting.groupBy("label", "list").agg(F.count(F.lit(1)).alias("visitors")), ["label", "list"]
    )
    blocks = sizes.select(
        "label",
        "list",
        F.ceil(F.col("members") / TOGETHER).cast("int").alias("across"),
        F.ceil(F.col("visitors") / TOGETHER).cast("int").alias("down"),
    )
    deal = lambda parts: F.pmod(F.hash("node"), F.col(parts))
    copies = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    keys = ["label", "list", "a", "b"]
    kept = ["node", "n", "vector", "codes", "error"]
    members = coded.join(blocks, ["label", "list"]).withColumn("a", deal("across")).withColumn("b", copies("down"))
    # Read anew: both sides of the meetings come from one table and need columns of their own.
    again = spark.read.parquet(f"{folder}/coded")
    visitors = again.withColumn("home", F.col("list")).withColumn("list", F.explode("visits")).join(blocks, ["label", "list"])
    visitors = visitors.withColumn("b", deal("down")).withColumn("a", copies("across"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: np.zeros(0, np.int64) for c in ("node", "links", "other")}
        if left.num_rows and right.num_rows:
            which = int(left["list"][0].as_py())
            right = right.set_column(right.schema.get_field_index("list"), "list", right["home"])
            m, v = _arrays(left), _arrays(right)
            index = shared.value.get(m["vector"].shape[1]) if which >= 0 else None
            i, j = near(index, which, m, v, least)
            # A visitor whose own list the member doesn't visit speaks for both.
            if index is not None and len(i):
                lone = ~index.visits(m["unit"], m["list"], least)[j, v["list"][i]]
            else:
                lone = np.zeros(len(i), dtype=bool)
            count = np.bincount(i, m["n"][j], len(v["node"]))
            back = np.bincount(j[lone], v["n"][i[lone]], len(m["node"]))
            a, b = forest(v["node"][i], m["node"][j])
            some, more = np.flatnonzero(count), np.flatnonzero(back)
            out = {
                "node": np.concatenate([v["node"][some], m["node"][more], a]),
                "links": np.concatenate([count[some], back[more], np.zeros(len(a))]).astype(np.int64),
                "other": np.concatenate([v["node"][some], m["node"][more], b]),
            }
        return pa.table(out)

    found = (
        members.select(*keys, *kept)
        .groupBy(*keys)
        .cogroup(visitors.select(*keys, "home", *kept).groupBy(*keys))
        .applyInArrow(meet, "node long, links long, other long")
    )
    found.write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    united = components(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")), folder)
    judged = classes.join(links, "node", "left").join(united, "node", "left").select(
        "label",
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    out = rows.join(judged, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
