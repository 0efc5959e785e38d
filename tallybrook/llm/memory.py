"""Token ids of frequent runs of text, remembered by hash, for many runs at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from tallybrook.llm.hashing import Checks, Substrings, as_units, mix

#: Runs remembered at most; then all are forgotten. About 40 bytes each.
MOST = 1_500_000
#: Characters of the texts that are encoded together; a longer text goes alone.
TOGETHER = 500_000


#: Bytes of an Arrow batch between Spark and a worker.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python workers in batches of BATCH_BYTES at most, whatever their number.

    By default a batch has up to 64 MB, which both sides hold for every task at once.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def grouped(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts in groups of bounded length, each with the place of its first."""
    first, length = 0, 0
    for i, t in enumerate(texts):
        if i > first and length + len(t) > TOGETHER:
            yield first, texts[first:i]
            first, length = i, 0
        length += len(t)
    if first < len(texts):
        yield first, texts[first:]


def small_slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of consecutive rows whose texts together are short, as ``grouped`` has them."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    first, length = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and length + n > TOGETHER:
            yield batch.slice(first, i - first)
            first, length = i, 0
        length += n
    if first < len(sizes):
        yield batch.slice(first)


def hash_names(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of runs: one modulo a prime, which alone would do, and a cheap one beside it."""
    return Substrings(units).hash(start, end), Checks(units).hash(start, end)


def short_names(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for each run of units between 1 and 2 ** 14: of up to eight units exact, of others hashes of these alone.

    The first four units are a number and so are the next four; the one can be
    recovered from the sum with the other. The highest bit tells hashes from these.
    """
    padded = np.append(units, np.zeros(7, units.dtype))
    four = np.ndarray(len(units) + 4, "<u8", padded, strides=(padded.itemsize,))
    inside = (np.uint64(1) << (np.arange(4, dtype=np.uint64) * np.uint64(16))) - np.uint64(1)
    inside = np.append(inside, ~np.uint64(0))
    n = np.minimum(end - start, 8)
    two = four[np.minimum(start + 4, len(units))] & inside[np.maximum(n - 4, 0)]
    one = mix((four[start] & inside[np.minimum(n, 4)]) + two * np.uint64(0xD6E8FEB86659FD93))
    long = np.flatnonzero(end - start > 8)
    if len(long):
        sizes = end[long] - start[long]
        ends = np.cumsum(sizes)
        one[long], two[long] = hash_names(_gather(units, start[long], sizes), ends - sizes, ends)
        two[long] |= np.uint64(1 << 63)
    return one, two


class RunMemory:
    """Ids of runs: new ones are segmented by ``segment``, the others looked up.

    ``names`` gives two numbers for each run, which tell runs apart.
    """

    def __init__(self, segment: Callable[[list[str]], list[list[int]]], names: Callable = hash_names):
        self.segment = segment
        self.names = names
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.offsets, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def encode(
        self, units: np.ndarray, start: np.ndarray, end: np.ndarray, text: str | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs one after another, and how many each run has.

        ``text``, if given, has a character for each of the units.
        """
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        one, two = self.names(units, start, end)
        keys, first, which = np.unique(one, return_index=True, return_inverse=True)
        checks = two[first]
        if (two != checks[which]).any():  # runs with one hash and not the other: tell them apart by position
            keys, first, which = one, np.arange(len(one)), np.arange(len(one))
            known = np.zeros(len(keys), dtype=bool)
            at = known.astype(np.int64)
        else:
            at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
            known = (self.keys[at] == keys) & (self.checks[at] == checks) if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        places = zip(start[first[new]].tolist(), end[first[new]].tolist())
        if text is not None:
            runs = [text[s:e] for s, e in places]
        else:
            runs = [units[s:e].tobytes().decode("utf-16-le", "surrogatepass") for s, e in places]
        found = self.segment(runs)
        fresh_counts = np.fromiter(map(len, found), np.int64, len(found))
        fresh = np.fromiter(chain.from_iterable(found), np.int32, int(fresh_counts.sum()))
        # Ids of the distinct runs first, then of every run.
        counts = np.empty(len(keys), np.int64)
        counts[known], counts[new] = self.counts[at[known]], fresh_counts
        offsets = np.empty(len(keys), np.int64)
        old = _gather(self.ids, self.offsets[at[known]], counts[known])
        offsets[known] = np.cumsum(counts[known]) - counts[known]
        offsets[new] = len(old) + np.cumsum(fresh_counts) - fresh_counts
        every = counts[which]
        out = _gather(np.concatenate([old, fresh]), offsets[which], every)
        if len(first) < len(one) or len(one) == 1:
            self._remember(keys[new], checks[new], fresh, fresh_counts)
        return out, every

    def _remember(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        if len(self.keys) + len(keys) > MOST:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        offsets = len(self.ids) + np.cumsum(counts) - counts
        self.keys, self.checks = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks)
        self.offsets, self.counts = np.insert(self.offsets, at, offsets), np.insert(self.counts, at, counts)
        self.ids = np.concatenate([self.ids, ids])


def _gather(flat: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """flat[offset : offset + count] of each, one after another."""
    total = int(counts.sum())
    shift = np.repeat(offsets - (np.cumsum(counts) - counts), counts)
    return flat[shift + np.arange(total)]


def joined_units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Units of all texts in one array, and where each text starts (one more at the end)."""
    parts = [as_units(t) for t in texts]
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint16)), bounds


def per_text(counts: np.ndarray, start: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the ids of each text start (one more at the end), from the counts of its runs."""
    before = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=before[1:])
    return before[np.searchsorted(start, bounds)]
