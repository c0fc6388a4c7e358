"""Patched frame-of-reference blocks of 32-bit numbers (numpy).

A block of ``BLOCK`` numbers is: its minimum (u32), the packed width w (u8),
a zero byte, the number of exceptions (u16), the numbers less the minimum
packed in w bits (32 of them fill w words of 32 bits), the exceptions'
places in the block (u16 each) and their bits above w (u32 each). The width
is that of a percentile of the block's numbers, the one of ``SHARES`` that
makes the block smallest; wider numbers are the exceptions. A last block
that is not full is filled up with its minimum. All numbers little-endian.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
SHARES = (0.75, 0.9, 0.95, 0.98, 1.0)
HEAD = 8


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) numbers under 2^width -> (blocks, bytes)."""
    lanes = np.ascontiguousarray(values.reshape(-1, 32).T)
    out = np.zeros((width, lanes.shape[1]), np.uint32)
    for j in range(32):
        word, off = divmod(j * width, 32)
        out[word] |= lanes[j] << np.uint32(off)
        if off + width > 32:
            out[word + 1] |= lanes[j] >> np.uint32(32 - off)
    return np.ascontiguousarray(out.T).view(np.uint8).reshape(len(values), -1)


def _unpack(raw: np.ndarray, width: int) -> np.ndarray:
    """(blocks, bytes) -> (blocks, BLOCK) numbers under 2^width."""
    words = np.ascontiguousarray(np.ascontiguousarray(raw).view("<u4").reshape(-1, width).T)
    out = np.empty((32, words.shape[1]), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for j in range(32):
        word, off = divmod(j * width, 32)
        out[j] = words[word] >> np.uint32(off)
        if off + width > 32:
            out[j] |= words[word + 1] << np.uint32(32 - off)
        out[j] &= mask
    return np.ascontiguousarray(out.T).reshape(len(raw), -1)


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each block and the end)."""
    n = len(ids)
    k = -(-n // block)
    x = np.empty(k * block, np.uint32)
    x[:n] = ids
    if k * block > n:
        x[n:] = x[(k - 1) * block:n].min()
    x = x.reshape(k, block)
    low = x.min(axis=1) if k else np.zeros(0, np.uint32)
    x -= low[:, None]
    bits = np.frexp(x.astype(np.float64))[1].astype(np.uint8)
    ordered = np.sort(bits, axis=1)
    width, cost = np.zeros(k, np.int64), np.full(k, np.iinfo(np.int64).max)
    for share in SHARES:
        w = ordered[:, max(0, int(np.ceil(share * block)) - 1)].astype(np.int64)
        size = block // 8 * w + 6 * (bits > w[:, None]).sum(axis=1)
        better = size < cost
        width[better], cost[better] = w[better], size[better]
    beyond = bits > width[:, None]
    exceptions = beyond.sum(axis=1)
    starts = np.zeros(k + 1, np.int64)
    np.cumsum(HEAD + cost, out=starts[1:])
    out = np.zeros(starts[-1], np.uint8)
    head = np.zeros(k, np.dtype([("low", "<u4"), ("width", "u1"), ("zero", "u1"), ("n", "<u2")]))
    head["low"], head["width"], head["n"] = low, width, exceptions
    out[starts[:-1, None] + np.arange(HEAD)] = head.view(np.uint8).reshape(k, HEAD)
    for w in np.unique(width):
        if not w:
            continue
        of = np.flatnonzero(width == w)
        at = HEAD + np.arange(block // 8 * w)
        for a in range(0, len(of), 256):
            part = of[a:a + 256]
            out[starts[part, None] + at] = _pack(x[part] & np.uint32((1 << int(w)) - 1), int(w))
    row, place = np.nonzero(beyond)
    rank = np.arange(len(row)) - (np.cumsum(exceptions) - exceptions)[row]
    at = (starts[:-1] + HEAD + block // 8 * width)[row] + 2 * rank
    out[at[:, None] + np.arange(2)] = place.astype("<u2").view(np.uint8).reshape(-1, 2)
    at += 2 * (exceptions[row] - rank) + 4 * rank
    high = x[row, place] >> width[row].astype(np.uint32)
    out[at[:, None] + np.arange(4)] = high.astype("<u4").view(np.uint8).reshape(-1, 4)
    return out, starts


def decode(data: np.ndarray, starts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The numbers of the blocks that begin at ``starts``, filling included."""
    k = len(starts)
    head = np.ascontiguousarray(data[starts[:, None] + np.arange(HEAD)])
    low = head[:, :4].copy().view("<u4").ravel()
    width = head[:, 4].astype(np.int64)
    exceptions = head[:, 6:8].copy().view("<u2").ravel().astype(np.int64)
    x = np.zeros((k, block), np.uint32)
    for w in np.unique(width):
        if not w:
            continue
        of = np.flatnonzero(width == w)
        at = HEAD + np.arange(block // 8 * w)
        for a in range(0, len(of), 256):
            part = of[a:a + 256]
            x[part] = _unpack(data[starts[part, None] + at], int(w))
    row = np.repeat(np.arange(k), exceptions)
    rank = np.arange(len(row)) - (np.cumsum(exceptions) - exceptions)[row]
    at = (starts + HEAD + block // 8 * width)[row] + 2 * rank
    place = np.ascontiguousarray(data[at[:, None] + np.arange(2)]).view("<u2").ravel()
    at += 2 * (exceptions[row] - rank) + 4 * rank
    high = np.ascontiguousarray(data[at[:, None] + np.arange(4)]).view("<u4").ravel()
    x[row, place] |= high << width[row].astype(np.uint32)
    x += low[:, None]
    return x.ravel()
