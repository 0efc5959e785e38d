"""Static range asymmetric numeral system over many interleaved lanes, in numpy.

Symbols go round the lanes; each lane is a coder of its own with a 64-bit state, and
all share one frequency table and one stream of 32-bit words. A block decodes from
its own bytes alone. Checkpoints inside a block hold the states of all lanes before
a row, so that decoding can begin there as well; a checksum covers the whole block.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

#: Frequencies add up to 2 ** SCALE.
SCALE = 20
#: States stay between 2 ** 31 and 2 ** 63.
_LOW = 1 << 31
MOST_LANES = 512
#: Rows (one symbol for each lane) between two checkpoints.
CHECKPOINT_ROWS = 128

_HEADER = struct.Struct("<4sIQQII")
_MAGIC = b"TBR1"


@dataclass(frozen=True)
class Table:
    """Frequencies of the symbols, which add up to 2 ** SCALE, and what follows from them."""

    freq: np.ndarray
    start: np.ndarray
    symbol: np.ndarray

    @classmethod
    def of(cls, freq: np.ndarray) -> Table:
        freq = freq.astype(np.uint64)
        if int(freq.sum()) != 1 << SCALE:
            raise ValueError("the frequencies of a table must add up to its size")
        start = np.cumsum(freq) - freq
        symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        return cls(freq, start, symbol)

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Table:
        """In proportion to the counts; a symbol that occurs has at least 1.

        What rounding leaves over or takes too much goes to the most frequent symbols.
        """
        counts = np.asarray(counts, dtype=np.int64).copy()
        if not counts.any():
            counts[0] = 1
        if np.count_nonzero(counts) > 1 << (SCALE - 1):
            raise ValueError("too many symbols for the size of the table")
        exact = counts / counts.sum() * (1 << SCALE)
        freq = np.where(counts > 0, np.maximum(1, np.floor(exact)), 0).astype(np.int64)
        rest = (1 << SCALE) - int(freq.sum())
        order = np.argsort(-counts, kind="stable")
        if rest > 0:
            freq[order[0]] += rest
        for i in order:
            if rest >= 0:
                break
            cut = min(-rest, int(freq[i]) // 2)
            freq[i] -= cut
            rest += cut
        return cls.of(freq)

    def to_bytes(self) -> bytes:
        body = zlib.compress(self.freq.astype("<u4").tobytes())
        return struct.pack("<I", zlib.crc32(body)) + body

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        if zlib.crc32(data[4:]) != struct.unpack("<I", data[:4])[0]:
            raise ValueError("the frequency table is damaged")
        return cls.of(np.frombuffer(zlib.decompress(data[4:]), dtype="<u4"))


def _lanes(n: int) -> int:
    """A power of two; fewer for few symbols, whose states would take more room than they."""
    return max(1, min(MOST_LANES, 1 << max(0, (n // 64).bit_length() - 1)))


def encode(symbols: np.ndarray, table: Table) -> bytes:
    """A block of symbols, each of which must occur in the table."""
    n = len(symbols)
    lanes = _lanes(n)
    rows = -(-n // lanes)
    freq, start = table.freq[symbols], table.start[symbols]
    if n and int(freq.min()) == 0:
        raise ValueError("a symbol isn't in the frequency table")
    state = np.full(lanes, _LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    points: list[tuple[int, int, np.ndarray]] = []
    written = 0
    for row in range(rows - 1, -1, -1):
        a, b = row * lanes, min(n, (row + 1) * lanes)
        f, x = freq[a:b], state[: b - a]
        full = x >= (f << np.uint64(63 - SCALE))
        out = x[full]
        if len(out):
            words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4"))
            written += len(out)
            x[full] = out >> np.uint64(32)
        high, low = np.divmod(x, f)
        state[: b - a] = (high << np.uint64(SCALE)) + low + start[a:b]
        if row and row % CHECKPOINT_ROWS == 0:
            points.append((row, written, state.copy()))
    stream = b"".join(w.tobytes() for w in reversed(words))
    # Decoding begins with what was written last: a checkpoint's place counts from there.
    marks = b"".join(
        struct.pack("<IQ", row, written - after) + s.astype("<u8").tobytes() for row, after, s in reversed(points)
    )
    head = _HEADER.pack(_MAGIC, lanes, n, written, len(points), 0)
    body = head + state.astype("<u8").tobytes() + marks + stream
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, from_checkpoint: int | None = None) -> np.ndarray:
    """The symbols of a block, or those from one of its checkpoints on.

    A wrong checksum is an error.
    """
    if len(block) < _HEADER.size + 4 or zlib.crc32(memoryview(block)[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("the block is damaged")
    magic, lanes, n, written, n_points, _ = _HEADER.unpack_from(block)
    if magic != _MAGIC:
        raise ValueError("not a block of this format")
    at = _HEADER.size
    state = np.frombuffer(block, "<u8", lanes, at).astype(np.uint64)
    at += 8 * lanes
    step = 12 + 8 * lanes
    words = np.frombuffer(block, "<u4", written, at + n_points * step).astype(np.uint64)
    first, used = 0, 0
    if from_checkpoint is not None:
        if not 0 <= from_checkpoint < n_points:
            raise IndexError("no such checkpoint")
        first, used = struct.unpack_from("<IQ", block, at + from_checkpoint * step)
        state = np.frombuffer(block, "<u8", lanes, at + from_checkpoint * step + 12).astype(np.uint64)
    out = np.empty(n, dtype=np.uint32)
    mask = np.uint64((1 << SCALE) - 1)
    low = np.uint64(_LOW)
    for row in range(first, -(-n // lanes)):
        a, b = row * lanes, min(n, (row + 1) * lanes)
        x = state[: b - a]
        slot = x & mask
        s = table.symbol[slot]
        out[a:b] = s
        x = table.freq[s] * (x >> np.uint64(SCALE)) + slot - table.start[s]
        empty = np.flatnonzero(x < low)
        if len(empty):
            x[empty] = (x[empty] << np.uint64(32)) | words[used : used + len(empty)]
            used += len(empty)
        state[: b - a] = x
    if used != written or (state != low).any():
        raise ValueError("the block doesn't end where it should")
    return out[first * lanes :]
