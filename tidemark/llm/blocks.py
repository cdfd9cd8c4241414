"""Patched frame-of-reference blocks of unsigned integers below 2**32.

A block holds 128 values. Its minimum is subtracted, the rest is packed at the width that fits the 90th percentile, and
the bits above that width go to the block's list of exceptions. Layout of an image, little-endian:

    magic "PFOR1", 3 zero bytes, count (u8 bytes long), number of blocks (8 bytes)
    for all blocks: start in the payload (8 bytes each), minimum (4), width (1), exceptions (1)
    payload of a block: 16 x width bytes of packed values, one byte for each exception's position, four for its high bits
"""

from __future__ import annotations

import numpy as np

MAGIC = b"PFOR1\0\0\0"
BLOCK = 128
PERCENTILE = 0.9


def _packed(v: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2**width as bytes, lowest bits first; 64 values fill ``width`` words."""
    v = v.astype("<u8").reshape(len(v), -1, 64)
    words = np.zeros((*v.shape[:2], width), "<u8")
    for i in range(64):
        at, shift = divmod(i * width, 64)
        words[:, :, at] |= v[:, :, i] << np.uint64(shift)
        if shift + width > 64:
            words[:, :, at + 1] |= v[:, :, i] >> np.uint64(64 - shift)
    return words.reshape(len(v), -1).view(np.uint8)


def _unpacked(packed: np.ndarray, width: int) -> np.ndarray:
    """The values of such rows."""
    words = np.ascontiguousarray(packed).view("<u8").reshape(len(packed), -1, width)
    v = np.empty((*words.shape[:2], 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        at, shift = divmod(i * width, 64)
        x = words[:, :, at] >> np.uint64(shift)
        if shift + width > 64:
            x |= words[:, :, at + 1] << np.uint64(64 - shift)
        v[:, :, i] = x & mask
    return v.reshape(len(packed), -1)


def encode(values: np.ndarray) -> bytes:
    n = len(values)
    nb = -(-n // BLOCK)
    padded = np.zeros(nb * BLOCK, np.uint32)
    padded[:n] = values
    if n:
        padded[n:] = values[(nb - 1) * BLOCK :].min()
    v = padded.reshape(nb, BLOCK)
    low = v.min(axis=1) if nb else np.zeros(0, np.uint32)
    v = v - low[:, None]
    at = int(np.ceil(BLOCK * PERCENTILE)) - 1
    typical = np.partition(v, at, axis=1)[:, at] if nb else low
    width = np.where(typical > 0, np.floor(np.log2(np.maximum(typical, 1).astype(np.float64))) + 1, 0).astype(np.uint8)
    high = v >> np.minimum(width, 31)[:, None].astype(np.uint32)
    high[width >= 32] = 0
    blk, pos = np.nonzero(high)
    count = np.bincount(blk, minlength=nb).astype(np.int64)
    size = 16 * width.astype(np.int64) + 5 * count
    start = np.zeros(nb, np.int64)
    np.cumsum(size[:-1], out=start[1:])
    payload = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        mine = np.flatnonzero(width == w)
        payload[start[mine][:, None] + np.arange(16 * w)] = _packed(v[mine] & np.uint32((1 << w) - 1), w)
    if len(blk):
        first = np.zeros(nb, np.int64)
        np.cumsum(count[:-1], out=first[1:])
        rank = np.arange(len(blk)) - first[blk]
        base = start[blk] + 16 * width[blk].astype(np.int64)
        payload[base + rank] = pos
        payload[(base + count[blk] + 4 * rank)[:, None] + np.arange(4)] = high[blk, pos].astype("<u4").view(np.uint8).reshape(-1, 4)
    head = np.array([n, nb], "<u8").tobytes()
    return b"".join([MAGIC, head, start.astype("<u8").tobytes(), low.astype("<u4").tobytes(), width.tobytes(), count.astype(np.uint8).tobytes(), payload.tobytes()])


def decode(image: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The values of blocks ``first`` to below ``last``, all by default; the index leads straight to them."""
    if image[:8] != MAGIC:
        raise ValueError("not an image of packed blocks")
    n, nb = (int(x) for x in np.frombuffer(image, "<u8", 2, 8))
    at = 24
    start = np.frombuffer(image, "<u8", nb, at).astype(np.int64)
    low = np.frombuffer(image, "<u4", nb, at + 8 * nb)
    width = np.frombuffer(image, np.uint8, nb, at + 12 * nb)
    count = np.frombuffer(image, np.uint8, nb, at + 13 * nb).astype(np.int64)
    payload = np.frombuffer(image, np.uint8, offset=at + 14 * nb)
    last = nb if last is None else min(last, nb)
    start, low, width, count = (x[first:last] for x in (start, low, width, count))
    v = np.zeros((len(start), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        mine = np.flatnonzero(width == w)
        v[mine] = _unpacked(payload[start[mine][:, None] + np.arange(16 * w)], w)
    if count.sum():
        blk = np.repeat(np.arange(len(start)), count)
        rank = np.arange(len(blk)) - np.repeat(np.cumsum(count) - count, count)
        base = start[blk] + 16 * width[blk].astype(np.int64)
        pos = payload[base + rank]
        high = np.ascontiguousarray(payload[(base + count[blk] + 4 * rank)[:, None] + np.arange(4)]).view("<u4").ravel()
        v[blk, pos] |= high << width[blk].astype(np.uint32)
    return (v + low[:, None]).ravel()[: n - first * BLOCK if last == nb else None]
