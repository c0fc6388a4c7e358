"""Vectorised text helpers used inside tasks: word bounds and hashes.

An Arrow string column is seen as one byte buffer plus row offsets; words
are found by a table of word bytes and hashed by prefix sums, so no Python
object is made per word. Work goes in row slices of about ``SLICE_BYTES``,
which bounds the memory of the temporaries whatever the batch size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def byte_table(spec: str) -> np.ndarray:
    """``space``: all but blanks 09-0D and 20; ``alnum``: digits, a-z and non-ASCII."""
    t = np.ones(256, bool)
    if spec == "space":
        t[[9, 10, 11, 12, 13, 32]] = False
    else:
        t[:128] = False
        t[48:58] = True
        t[97:123] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def string_buffer(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)
    offs = offs[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges [a, b) of at most ``limit`` bytes, one row at least."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_bounds(data: np.ndarray, offs: np.ndarray, table: np.ndarray):
    """Starts, ends and rows of the maximal runs of word bytes, per row."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = table[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    starts = np.flatnonzero(w & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    ends = np.flatnonzero(w & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


class Rolling:
    """Hashes of ranges of a uint64 sequence by prefix sums of x[i] * q^i mod 2^64."""

    def __init__(self, seed: int):
        self.q = U((0x9E3779B97F4A7C15 * (2 * seed + 1) | 5) & (2**64 - 1))
        self.inv = U(pow(int(self.q), -1, 2**64))
        self.pw = np.ones(1, U)
        self.ipw = np.ones(1, U)

    def _grow(self, n: int) -> None:
        if len(self.pw) < n:
            n += n // 8
            f = np.full(n, self.q, U)
            f[0] = U(1)
            self.pw = np.cumprod(f, dtype=U)
            f = np.full(n, self.inv, U)
            f[0] = U(1)
            self.ipw = np.cumprod(f, dtype=U)

    def ranges(self, x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(x) + 1)
        c = np.zeros(len(x) + 1, U)
        np.cumsum(x * self.pw[:len(x)], out=c[1:])
        h = (c[ends] - c[starts]) * self.ipw[starts]
        return mix64(h + (ends - starts).astype(U) * U(0x9E3779B97F4A7C15))


class WordHasher:
    """64-bit hashes of byte ranges (words) of a buffer."""

    def __init__(self, seed: int = 1):
        self.byte = mix64(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93) + U(seed))
        self.roll = Rolling(seed)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.roll.ranges(self.byte[data], starts, ends)


def gather_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Arrow binary array of the given byte ranges."""
    size = ends - starts
    offs = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offs[1:])
    idx = np.arange(offs[-1]) + np.repeat(starts - offs[:-1], size)
    return pa.Array.from_buffers(pa.binary(), len(size),
                                 [None, pa.py_buffer(offs.astype(np.int32).tobytes()),
                                  pa.py_buffer(data[idx].tobytes())])


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)

