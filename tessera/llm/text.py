"""Vectorised helpers over ragged UTF-8 batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa


def ragged(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes add up to about size; a longer row makes a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def sized(batches: Iterator[pa.RecordBatch], size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Batches in parts of about ``size`` bytes, whatever rows they have; a larger row is a part of its own."""
    for batch in batches:
        if batch.nbytes <= size:
            yield batch
            continue
        rows = max(1, int(batch.num_rows * size // batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            if part.nbytes <= 4 * size:
                yield part
            else:
                for i in range(part.num_rows):
                    yield part.slice(i, 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def byte_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)[:n]


@lru_cache(8)
def _bases(seed: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    base = int(rng.integers(1, 2**61)) * 8 + 5
    return byte_table(seed + 1), powers(base, size), powers(pow(base, -1, 2**64), size)


class Rolling:
    """Hashes of any substring of one byte buffer: T[b] * B**i prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray, seed: int):
        n = len(data)
        table, power, self.inv = _bases(seed, 1 << max(16, n.bit_length()))
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * power[:n], out=self.prefix[1:])

    def fixed(self, k: int) -> np.ndarray:
        """For every start, the raw hash of the next k bytes."""
        if k >= len(self.prefix):
            return np.zeros(0, np.uint64)
        return (self.prefix[k:] - self.prefix[:-k]) * self.inv[: len(self.prefix) - k]

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inv[start]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
