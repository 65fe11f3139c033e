"""Runs of bytes in texts, and CRC-32 of them, by arrays.

CRC-32 is linear: the checksum of a text behind another one is the first's
checksum, moved on by the second's length, XOR the second's. So those of n-grams
and of prefixed words come from those of the words alone.
"""

from __future__ import annotations

import zlib

import numpy as np

LONG = 256   # bytes; longer runs are taken one by one

_STEP = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _STEP = np.where(_STEP & 1, (_STEP >> 1) ^ np.uint32(0xEDB88320), _STEP >> 1)


def _moves() -> np.ndarray:
    """For each length up to ``LONG``, what each value of each of the four
    bytes of a checksum becomes after so many zero bytes."""
    out = np.empty((LONG + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << np.array([[0], [8], [16], [24]], np.uint32)
    for n in range(LONG):
        out[n + 1] = _STEP[out[n] & 0xFF] ^ (out[n] >> 8)
    return out


_MOVES = _moves()
_FLAT = _MOVES.reshape(-1)


def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    return table[0][c & 0xFF] ^ table[1][c >> 8 & 0xFF] ^ table[2][c >> 16 & 0xFF] ^ table[3][c >> 24]


def moved(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums moved on by ``n`` bytes each."""
    base = np.minimum(n, LONG).astype(np.int64) * 1024
    out = _FLAT[base + (c & 0xFF)] ^ _FLAT[base + 256 + (c >> 8 & 0xFF)] ^ _FLAT[base + 512 + (c >> 16 & 0xFF)] ^ _FLAT[base + 768 + (c >> 24)]
    for far in np.unique(n[n > LONG]).tolist():
        at = np.flatnonzero(n == far)
        square, left, some = _MOVES[1], far, c[at]
        while left:   # the move by 2, 4, 8, ... bytes
            if left & 1:
                some = _apply(square, some)
            square, left = _apply(square, square), left >> 1
        out[at] = some
    return out


def joined(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums of texts followed by others of ``n`` bytes."""
    return moved(first, n) ^ second


def runs(offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the maximal runs of bytes that are ``inside``."""
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & np.append(True, edge[1:-1] | ~inside[:-1]))
    ends = np.flatnonzero(inside & np.append(edge[1:-1] | ~inside[1:], True)) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each run."""
    n = ends - starts
    order = np.argsort(-np.minimum(n, LONG + 1).astype(np.int16), kind="stable")   # longest first
    n, at = n[order], starts[order]
    c = np.full(len(n), 0xFFFFFFFF, np.uint32)
    far = int(np.count_nonzero(n > LONG))
    for k in range(int(n[far]) if far < len(n) else 0):
        m = int(np.searchsorted(-n[far:], -k, "left"))   # those of over k bytes
        c[far: far + m] = _STEP[(c[far: far + m] ^ data[at[far: far + m] + k]) & 0xFF] ^ (c[far: far + m] >> 8)
    c = ~c
    for k in range(far):
        c[k] = zlib.crc32(data[at[k]: at[k] + n[k]])
    out = np.empty_like(c)
    out[order] = c
    return out
