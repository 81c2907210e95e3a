"""Vectorised text helpers for the operators' tasks: code points, words and their hashes.

A batch of texts is one array of code points. Words are runs of characters of a class; their
64-bit hashes come from one running sum over the batch: with the odd number B, the hash of the
characters at s..e is ``sum(v[i] * B**i for i in s..e) / B**s`` modulo 2**64, where v is a mixed
value of the character. No Python loop goes over words or characters.
"""

from collections.abc import Iterator

import numpy as np

_B = 0x9E3779B97F4A7C15 | 1
_B_INVERSE = pow(_B, -1, 1 << 64)
# code points of a batch; longer texts make longer batches, up to the text
BATCH_CHARS = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    have = 1
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * np.uint64(pow(base, have, 1 << 64))
        have += take
    return out


class _Powers:
    """Powers of B and of its inverse, as many as the longest batch so far needed."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> "tuple[np.ndarray, np.ndarray]":
        if len(cls.up) < n:
            cls.up = powers(_B, n)
            cls.down = powers(_B_INVERSE, n)
        return cls.up, cls.down


def code_points(texts: "list[str]") -> "tuple[np.ndarray, np.ndarray]":
    """All characters as numbers, and where each text begins (one more: the end)."""
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)), out=at[1:])
    return np.frombuffer(joined, dtype=np.uint32), at


def runs(inside: np.ndarray, at: np.ndarray) -> "tuple[np.ndarray, np.ndarray]":
    """Start and end of every run of True that stays within its text."""
    if not len(inside):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = at[:-1][at[:-1] < len(inside)]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = at[1:][at[1:] > 0] - 1
    last[ends] = inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def run_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for each pair; equal runs have equal hashes."""
    up, down = _Powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def text_of_words(start: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text, where its words begin in ``start`` (one more: the end)."""
    return np.searchsorted(start, at)


def batches(texts: "list[str]", chars: int = BATCH_CHARS) -> "Iterator[tuple[int, int]]":
    """Slices of consecutive texts with about ``chars`` characters, at least one text each."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield begin, i
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield begin, len(texts)




def lower_ascii(points: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all else as it is."""
    return np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)


def is_blank(points: np.ndarray) -> np.ndarray:
    """Space and the control characters 9 to 13."""
    return (points == 32) | ((points >= 9) & (points <= 13))


class _Letters:
    """Of every code point: is it a letter, and its lower case where that is one character."""

    tables = None

    @classmethod
    def get(cls) -> "tuple[np.ndarray, np.ndarray]":
        if cls.tables is None:
            points = range(0x110000)
            letter = np.fromiter((chr(p).isalpha() for p in points), dtype=bool, count=0x110000)
            lower = np.arange(0x110000, dtype=np.uint32)
            for p in np.flatnonzero(letter):
                small = chr(p).lower()
                if len(small) == 1:
                    lower[p] = ord(small)
            cls.tables = letter, lower
        return cls.tables


def letters(points: np.ndarray) -> "tuple[np.ndarray, np.ndarray]":
    """(is a letter, lower case) of each code point."""
    letter, lower = _Letters.get()
    return letter[points], lower[points]


def mixed(points: np.ndarray) -> np.ndarray:
    """A 64-bit value of each code point."""
    return mix(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the n values from each place; the last n - 1 places have none."""
    total = max(len(values) - n + 1, 0)
    h = values[:total].copy()
    for k in range(1, n):
        h *= np.uint64(0xD6E8FEB86659FD93)
        h += values[k : k + total]
    return mix(h + np.uint64(n))


def gram_buckets(
    values: np.ndarray, n: int, bits: int, salt: int
) -> np.ndarray:
    """Bucket, below 2**bits, of the n values from each place; the last n - 1 places have none."""
    total = len(values) - n + 1
    if total <= 0:
        return np.zeros(0, dtype=np.int64)
    h = values[:total].copy()
    for k in range(1, n):
        h *= np.uint64(0xD6E8FEB86659FD93)
        h += values[k : k + total]
    h += np.uint64(salt)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x165667B19E3779F9)
    return (h >> np.uint64(64 - bits)).astype(np.int64)
