"""Removal of repeated byte strings, by prefix-free parsing of the corpus.

Triggers of a rolling hash cut each text into phrases. The trigger of a start is the
least hash among the grams that begin within SPAN bytes of it, so all starts of one
string have the same trigger wherever the string stands, and the starts of one trigger
lie together: they make a phrase, which goes on LENGTH - 1 bytes beyond its last start.
Phrases thus overlap by LENGTH - 1 bytes, not just by a trigger's width: the first
LENGTH bytes of any suffix lie within one phrase.

Equal phrases are one entry of the dictionary, told apart by a cryptographic hash of
their bytes; the parse is where they stand. A phrase that occurs twice is repeated as a whole, without a look at its bytes. Around each
trigger stands a core that belongs to every string of the phrase: if a core occurs
once, nothing in its phrase is repeated. What remains are entries that occur once and
share a core with others, at the borders of repeated passages. Their suffixes are
sorted together with those of the other entries of the core (the suffix array of that
part of the dictionary, to the depth of LENGTH), and neighbours that are equal are
repeated. The order beyond that depth, and so the suffix array of the parse, decides
nothing here: places of one entry are equal to that depth by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.hashing import Substrings, as_bytes, drawn_bases
from tallybrook.llm.memory import small_slices

#: Bytes of a string that may stand only once.
LENGTH = 200
#: A trigger begins at most so many bytes behind the start of a string; a core has so many bytes.
SPAN, CORE = 136, 64
#: Bytes of a gram of the rolling hash.
GRAM = 16
#: Entries of one core that are sorted in one task; more are matched by the hashes of their strings.
MOST_ENTRIES = 2_048
#: Strings that are sorted together, about.
TOGETHER = 100_000

#: Bytes of the cryptographic hashes of phrases and rows.
DIGEST = 16

_PHRASE = "row binary, place int, n int, core long, phrase binary"


def phrases(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Phrases of texts that stand one after another in ``data``: first start, starts, core, digest.

    Cores are named by a hash that can clash: then entries are compared in vain, no
    more. Digests decide what is equal. ``bounds`` says where each text begins, and where the last one ends. Strings that
    cross a bound are none.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, []
    # The hash above the place: the least key is the leftmost of the least hashes.
    sub = Substrings(data)
    grams = sub.hash_all(GRAM)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    over = SPAN + 1 - width
    least = np.minimum(least[: len(least) - over], least[over:]) if over else least
    trigger = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)[: n - LENGTH + 1]
    ends = np.repeat(bounds[1:], np.diff(bounds))[: len(trigger)]
    inside = np.arange(len(trigger)) + LENGTH <= ends
    new = np.ones(len(trigger), dtype=bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(trigger)]
    new[heads] = True
    first = np.flatnonzero(new & inside)
    # A phrase ends before the next one or before the first start whose string leaves the text.
    stops = np.append(np.flatnonzero(new | ~inside), len(trigger))
    last = stops[np.searchsorted(stops, first, side="right")] - 1
    at = trigger[first]
    core = sub.hash(at, at + CORE).view(np.int64)
    view = memoryview(np.ascontiguousarray(data))
    digests = [hashlib.blake2b(view[f:e], digest_size=DIGEST).digest() for f, e in zip(first.tolist(), (last + LENGTH).tolist())]
    return first, last - first + 1, core, digests


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, row, text; a cryptographic hash of id and text, row, tells the rows apart.

    Rows with the same id and text have one name: what is repeated in one is in all.
    """
    one = docs.select(F.col("doc_id").cast("long"), "text")
    # NULL and empty texts have no bytes to tell apart.
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return one.select("doc_id", F.unhex(F.substring(F.sha2(named, 256), 1, 2 * DIGEST)).alias("row"), "text")


def _parse(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in small_slices(batch, 1):
                parts = [as_bytes(t) for t in few.column(1).to_pylist()]
                bounds = np.append(0, np.cumsum([len(p) for p in parts]))
                first, n, core, phrase = phrases(np.concatenate(parts), bounds)
                row = np.searchsorted(bounds, first, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        few.column(0).take(pa.array(row)),
                        pa.array((first - bounds[row]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array(core),
                        pa.array(phrase, pa.binary()),
                    ],
                    ["row", "place", "n", "core", "phrase"],
                )

    long = _marked(docs).where("octet_length(text) >= %d" % LENGTH)
    return long.select("row", "text").mapInArrow(run, _PHRASE)


_ENTRY = "row binary, place int, core long, once boolean, data binary"


def _cut_entries(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """The entries with their bytes, from a text in which they stand."""
    wanted = entries.groupBy("row").agg(F.collect_set(F.struct("place", "n", "core", "once")).alias("entries"))
    # One row of those with the same id and text will do.
    texts = _marked(docs).select("row", "text")
    found = texts.join(wanted, "row").select("row", "text", "entries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in small_slices(batch, 1):
                rows = []
                for row, text, entries in zip(*(c.to_pylist() for c in few.columns)):
                    data = text.encode("utf-8", "surrogatepass")
                    for e in {x["place"]: x for x in entries}.values():
                        cut = data[e["place"] : e["place"] + e["n"] + LENGTH - 1]
                        rows.append((row, e["place"], e["core"], e["once"], cut))
                names = ["row", "place", "core", "once", "data"]
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema=schema)

    schema = pa.schema(
        [("row", pa.binary()), ("place", pa.int32()), ("core", pa.int64()), ("once", pa.bool_()), ("data", pa.binary())]
    )
    return found.mapInArrow(run, _ENTRY)


def _starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For entries that stand one after another: the starts of their strings, whose they are, and which of it."""
    counts = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    which = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return (np.cumsum(sizes) - sizes)[owner] + which, owner, which


def repeated_strings(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Strings of LENGTH bytes that stand in two entries or twice in one: the entry, and the place in it.

    All suffixes of the entries that are long enough are sorted by their first LENGTH
    bytes; a string that equals its neighbour is repeated.
    """
    data = np.frombuffer(b"".join(entries), np.uint8)
    start, owner, which = _starts(np.array([len(e) for e in entries]))
    strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, LENGTH)[start]).view(f"S{LENGTH}").ravel()
    order = np.argsort(strings, kind="stable")
    ordered = strings[order]
    equal = ordered[1:] == ordered[:-1]
    repeated = np.zeros(len(strings), dtype=bool)
    repeated[order[1:][equal]] = True
    repeated[order[:-1][equal]] = True
    return owner[repeated], which[repeated]


_FOUND = "row binary, place int, n int"


def _runs(owner: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first place and length of runs of consecutive places."""
    if not len(owner):
        return owner, which, which
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (which[1:] != which[:-1] + 1)
    first = np.flatnonzero(new)
    return owner[first], which[first], np.diff(np.append(first, len(owner)))


def _settle_sorted(entries: DataFrame) -> DataFrame:
    """Repeated strings of the entries that occur once, by sorting the entries of each core together."""

    def settle(rows: list[dict]) -> pa.RecordBatch:
        owner, which = repeated_strings([r["data"] for r in rows])
        once = np.array([r["once"] for r in rows])[owner]
        owner, first, n = _runs(owner[once], which[once])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i]["row"] for i in owner], pa.binary()),
                pa.array([rows[i]["place"] + f for i, f in zip(owner.tolist(), first.tolist())], pa.int32()),
                pa.array(n.astype(np.int32)),
            ],
            ["row", "place", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        strings = 0
        for batch in batches:
            for few in small_slices(batch, 4):
                for row in few.to_pylist():
                    if strings >= TOGETHER and row["core"] != rows[-1]["core"]:
                        yield settle(rows)
                        rows, strings = [], 0
                    rows.append(row)
                    strings += len(row["data"]) - LENGTH + 1
        if rows:
            yield settle(rows)

    return entries.repartition("core").sortWithinPartitions("core").mapInArrow(run, _FOUND)


def _settle_hashed(entries: DataFrame) -> DataFrame:
    """The same for cores with very many entries: strings are counted by two hashes, before any shuffle and after.

    The points of the hashes are drawn for each run, so two different strings have both
    equal for less than (LENGTH / 2**61) ** 2 of all draws, whatever the texts.
    """
    bases = drawn_bases(2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in small_slices(batch, 4):
                data = few.column(4).to_pylist()
                joined = np.frombuffer(b"".join(data), np.uint8)
                start, owner, which = _starts(np.array([len(d) for d in data]))
                one, two = (Substrings(joined, b).hash(start, start + LENGTH).view(np.int64) for b in bases)
                of = pa.array(owner)
                place = np.asarray(few.column(1))[owner] + which
                yield pa.RecordBatch.from_arrays(
                    [few.column(0).take(of), pa.array(place.astype(np.int32)), few.column(3).take(of), pa.array(one), pa.array(two)],
                    ["row", "place", "once", "one", "two"],
                )

    strings = entries.mapInArrow(run, "row binary, place int, once boolean, one long, two long")
    twice = strings.groupBy("one", "two").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("one", "two")
    found = strings.where("once").join(twice, ["one", "two"])
    return found.select("row", "place", F.lit(1).alias("n"))


def find_repeats(docs: DataFrame, folder: str) -> DataFrame:
    """row, place, n: starts place to place + n - 1 begin strings of LENGTH bytes that also start elsewhere."""
    spark = docs.sparkSession

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    parse = written(_parse(docs), "parse")
    cores = parse.groupBy("core").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("core")
    # A table of its own: adaptive execution splits the rows of a frequent core only
    # where both sides of a join come straight from a shuffle.
    rest = written(parse.join(written(cores, "cores"), "core"), "rest")
    entries = rest.groupBy("core", "phrase").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "place", "n")).alias("at")
    )
    entries = written(entries, "entries")
    # Only a core with an entry that occurs once leaves something to look at.
    per_core = entries.groupBy("core").agg(F.count(F.lit(1)).alias("entries"), F.min("times").alias("least"))
    per_core = written(per_core.where("least = 1").select("core", "entries"), "per_core")
    open_ = entries.join(per_core, "core").select(
        "at.row", "at.place", "at.n", "core", (F.col("times") == 1).alias("once")
    )
    cut = written(_cut_entries(docs, open_), "cut")
    large = per_core.where(F.col("entries") > MOST_ENTRIES).select("core")
    small = cut.join(large, "core", "left_anti").select(*cut.columns)
    settled = written(_settle_sorted(small), "sorted")
    hashed = written(_settle_hashed(cut.join(large, "core", "left_semi").select(*cut.columns)), "hashed")
    whole = rest.join(entries.where("times > 1").select("core", "phrase"), ["core", "phrase"])
    return whole.select("row", "place", "n").unionAll(settled).unionAll(hashed)


def cut_repeats(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and kept: the bytes of each text without those of repeated strings.

    A byte goes if it lies in a string of LENGTH bytes that also starts anywhere else
    in the texts, in the same one too, overlapping or not; strings are those of the
    texts as they are. Texts are UTF-8; no string crosses from one into another.

    Defined cases: a NULL or empty text has no bytes; texts shorter than LENGTH stay
    whole; rows without doc_id and rows that repeat one are texts of their own, so
    repeated rows lose all that LENGTH bytes or more can cover. ``folder`` is shared
    by all workers.
    """
    found = find_repeats(docs, folder)
    # Distinct ones: rows with the same id and text have the same starts.
    starts = found.groupBy("row").agg(F.collect_set(F.struct("place", "n")).alias("starts"))
    rows = _marked(docs).join(starts, "row", "left").select("doc_id", "text", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in small_slices(batch, 1):
                out = []
                for text, starts in zip(few.column(1).to_pylist(), few.column(2)):
                    data = as_bytes(text)
                    if not starts.is_valid:
                        out.append((len(data), 0, 0, data.tobytes()))
                        continue
                    change = np.zeros(len(data) + 2, dtype=np.int64)
                    place, n = (np.asarray(f) for f in starts.values.flatten())
                    np.add.at(change, place + 1, 1)
                    np.add.at(change, place + n + LENGTH, -1)
                    gone = np.cumsum(change)[: len(data) + 1] > 0
                    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                    out.append((len(data), int(gone.sum()), spans, data[~gone[1:]].tobytes()))
                n_bytes, n_removed, n_spans, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [few.column(0), *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
