"""Vectorised word, window and shingle hashing over UTF-8 bytes (numpy, one pass per megabyte).

All separators used by the operators are ASCII bytes, and every byte of a multi-byte character is
0x80 or above, so splitting bytes equals splitting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of texts handled at a time, and where several workers of one executor count: about ten numbers of 8 bytes are held
#: for each.
CHUNK_BYTES, SMALL_CHUNK = 1 << 20, 1 << 18


def _splitmix(seed: int, n: int) -> np.ndarray:
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = _splitmix(17, 256)
_PLACE = _splitmix(91, 64) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of everything but white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of digits, letters and all non-ASCII characters: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (lower-cased)
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            factors = np.full(n, np.uint64(base))
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, from one running sum over all bytes."""
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of several texts: ``hashes``, byte ``starts`` and ``ends`` in ``data`` and, for each
    text, the index of its first word (``first``, one longer than the texts)."""

    def __init__(self, texts: list[bytes], kind: np.ndarray, lower: bool = True):
        joined = b" ".join(texts) + b" "
        data = np.frombuffer(joined, np.uint8)
        data = LOWER[data] if lower else data
        inside = kind[data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.data, self.starts, self.ends = data, edge[0::2], edge[1::2]
        up, down = _power(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
        self.first = np.searchsorted(self.starts, offsets)

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k consecutive words within a text, and the index of the first word of each."""
        h = self.hashes
        n = len(h) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for i in range(k):
            total += h[i : i + n] * _PLACE[i]
        counts = np.diff(self.first)
        last = np.repeat(self.first[1:], counts)[:n] - k  # the last word at which a run of this text starts
        at = np.flatnonzero(np.arange(n) <= last)
        return mix(total[at] + np.uint64(k)), at

    def text(self, a: int, b: int) -> bytes:
        """Words a to b (exclusive), joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b], strict=True))


def utf8(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is a range of its own. Texts are never cut."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield begin, i
            begin, size = i, 0
        size += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)
