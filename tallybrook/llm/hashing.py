"""Hashes of many substrings of a text at once, in numpy."""

from __future__ import annotations

import secrets
from functools import lru_cache

import numpy as np

#: Hashes are polynomials modulo this prime.
PRIME = (1 << 61) - 1
#: The point at which they are taken, drawn at random once. Texts can be made to clash in it on purpose.
BASE = 0x1AC1DEB0B24E1D67
#: Units whose products are added before they are reduced.
CHUNK = 1 << 14
#: Tables of powers for texts of up to two to this many units are kept.
KEPT_BITS = 20

_P, _61, _31, _30 = (np.uint64(x) for x in (PRIME, 61, 31, 30))
_LOW31, _LOW30 = (np.uint64((1 << x) - 1) for x in (31, 30))


def reduced(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits modulo the prime."""
    x = (x & _P) + (x >> _61)
    # What is below the prime wraps to a large number.
    return np.minimum(x, x - _P)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, of numbers below it, from halves of 31 bits."""
    a_high, a_low, b_high, b_low = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a_low * b_high + a_high * b_low
    out = ((a_high * b_high) << np.uint64(1)) + (middle >> _30) + ((middle & _LOW30) << _31)
    return reduced(out + a_low * b_low)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _made_powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, PRIME)):
        power = np.ones(1 << bits, dtype=np.uint64)
        for k in range(bits):
            step = np.array(pow(b, 1 << k, PRIME), dtype=np.uint64)
            power[1 << k : 2 << k] = times(power[: 1 << k], step)
        out.append(power)
    return out[0], out[1]


_kept_powers = lru_cache(maxsize=4)(_made_powers)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, up to the n-th at least."""
    if n < 1 << KEPT_BITS:
        return _kept_powers(base, max(CHUNK.bit_length(), KEPT_BITS if n >= 1 << 16 else 16))
    return _made_powers(base, n.bit_length())


def drawn_bases(n: int) -> list[int]:
    """Points drawn anew, for hashes that no text can have been made to clash in."""
    return [2 + secrets.randbelow(PRIME - 2) for _ in range(n)]


class Substrings:
    """Hashes of substrings of one text: equal strings have equal hashes wherever they are.

    ``data`` has bytes or 16-bit units. ``base`` is the point, without one (0) a fixed one.
    A substring is a polynomial in its units (each raised by one) modulo a prime of 61
    bits, taken at a point drawn at random. Two different strings of n units have
    equal hashes for less than n of all points.
    """

    def __init__(self, data: np.ndarray, base: int = 0):
        n = len(data)
        power, self._inverse = _powers(base or BASE, n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        carry = 0
        for first in range(0, n, CHUNK):
            units = data[first : first + CHUNK].astype(np.uint64) + np.uint64(1)
            some = power[first : first + len(units)]
            high, low = np.cumsum(units * (some >> _31)), np.cumsum(units * (some & _LOW31))
            high = (high & _P) + (high >> _61)
            sums = reduced((high >> _30) + ((high & _LOW30) << _31) + low + np.uint64(carry))
            self.sums[first + 1 : first + 1 + len(units)] = sums
            carry = int(sums[-1])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = times(reduced(self.sums[end] + _P - self.sums[start]), self._inverse[start])
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def hash_all(self, width: int) -> np.ndarray:
        """Hashes of all substrings of ``width`` units, by their start."""
        n = max(0, len(self.sums) - width)
        out = np.empty(n, dtype=np.uint64)
        for first in range(0, n, CHUNK):
            last = min(n, first + CHUNK)
            raw = reduced(self.sums[first + width : last + width] + _P - self.sums[first:last])
            out[first:last] = mix(times(raw, self._inverse[first:last]))
        return out


class Checks:
    """Cheap hashes of substrings modulo 2**64, to be asked beside those of :class:`Substrings`, never alone.

    Regular texts of two letters can have equal ones.
    """

    _BASE = 0x9E3779B97F4A7C15

    def __init__(self, data: np.ndarray):
        bits = max(12, int(len(data)).bit_length())
        power, self._inverse = _wrapping_powers(self._BASE, bits)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self._inverse[start])


@lru_cache(maxsize=2)
def _wrapping_powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full((1 << bits) + 1, b, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


#: Blank, and the controls from tab to return.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII capitals as small letters; all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: What isn't an ASCII letter or part of a letter beyond ASCII.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def runs(data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs without separators."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~separator[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def as_units(text: str) -> np.ndarray:
    """UTF-16 units of a text."""
    return np.frombuffer(text.encode("utf-16-le", "surrogatepass"), dtype=np.uint16)
