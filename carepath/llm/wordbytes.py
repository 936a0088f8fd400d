"""Words of Arrow text columns as numpy arrays, for the operators that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that are worked on at once; a longer document is worked on alone.
BLOCK = 1 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its texts; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents whose texts have about size bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each document's first word (n + 1)."""
    solid = ~SPACE[raw]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edge = offsets[:-1][offsets[:-1] < len(raw)]
    begins[edge] |= solid[edge]
    edge = offsets[1:][offsets[1:] > 0] - 1
    ends[edge] |= solid[edge]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


_STEP = np.uint64(0x9E3779B97F4A7C13)  # odd, 3 modulo 8
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the rolling hash and of its inverse, grown on demand and kept per process."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > 4 * BLOCK:  # a very long document: not kept
            return cls._make(n)
        if len(cls.up) < n:
            cls.up, cls.down = cls._make(max(n, BLOCK))
        return cls.up, cls.down

    @staticmethod
    def _make(n: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.full(n, _STEP), np.full(n, _BACK)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def spans_hash(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each values[start:stop]: differences of one running sum."""
    up, down = Powers.upto(max(len(values), 1))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts]) if len(starts) else np.zeros(0, np.uint64)


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def word_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return spans_hash(_BYTES[raw], starts, stops)


def window_hashes(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return spans_hash(hashes, at, at + length)
