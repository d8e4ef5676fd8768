"""Words and shingles of whole Arrow batches, as numpy arrays.

A word is a maximal run of characters other than space and U+0009 to U+000D; only A to Z are
lower-cased. Both rules hold for the UTF-8 bytes as well, so a batch is split without decoding it.
Words are 64-bit hashes: a table value per byte, summed with the powers of an odd number, then
mixed. All constants come from the fixed generator `mix`, so every worker has the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE = 5
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """`n` fixed 64-bit numbers that belong to `seed`."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = constants(1, 256)[LOWER]
_AS_IS = constants(1, 256)
_ODD = int(constants(2, 1)[0]) | 1
_JOIN = constants(3, SHINGLE) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, at least `n` of each."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


class Words:
    """The words of some texts: byte positions, the words of row i being first[i]:first[i + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.rows = data, len(offsets) - 1
        inside = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, limit: int = CHUNK_BYTES) -> np.ndarray:
        """Hashes of the words with A-Z lower-cased, computed over at most `limit` bytes (or one word) at a time."""
        return self._hashes(_BYTE, limit)

    def hashes_as_is(self, limit: int = CHUNK_BYTES) -> np.ndarray:
        """The same, but hashes that tell capitals apart."""
        return self._hashes(_AS_IS, limit)

    def _hashes(self, numbers: np.ndarray, limit: int) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        low = 0
        while low < len(out):
            begin = self.starts[low]
            high = max(low + 1, int(np.searchsorted(self.ends, begin + limit, side="right")))
            data = self.data[begin : self.ends[high - 1]]
            powers, inverses = _power_tables(len(data) + 1)
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(numbers[data] * powers[: len(data)], out=total[1:])
            starts, ends = self.starts[low:high] - begin, self.ends[low:high] - begin
            sums = (total[ends] - total[starts]) * inverses[starts]
            out[low:high] = mix(sums + (ends - starts).astype(np.uint64) * np.uint64(_BASE))
            low = high
        return out


def byte_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges with their bytes and offsets, each of at most `limit` bytes or one row; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, marks, raw = texts.buffers()
    offsets = np.frombuffer(marks, dtype=width)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        part = offsets[low : high + 1]
        yield low, high, data[part[0] : part[-1]], part - part[0]
        low = high


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """`byte_chunks` with their words."""
    for low, high, data, offsets in byte_chunks(texts, limit):
        yield low, high, Words(data, offsets)


def run_hashes(hashes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of `width` of the given word hashes that begins at `starts`."""
    powers, inverses = _power_tables(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers[: len(hashes)], out=total[1:])
    return mix((total[starts + width] - total[starts]) * inverses[starts] + np.uint64(width))


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Distinct sorted hashes of the five-word shingles of one text; shorter texts are one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, SHINGLE)
    total = hashes[: n - width + 1] * _JOIN[0]
    for i in range(1, width):
        total = total + mix(hashes[i : n - width + 1 + i]) * _JOIN[i]
    return np.unique(mix(total + np.uint64(width)))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of every row, in order."""
    for _, _, words in text_chunks(texts):
        hashes = words.hashes()
        for i in range(words.rows):
            yield shingle_hashes(hashes[words.first[i] : words.first[i + 1]])
