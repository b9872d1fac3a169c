"""Whole numbers in bytes of seven bits, packed and unpacked in numpy."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the numbers, and how many each takes. The last byte of a number is under 128."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    rest = values >> np.uint64(7)
    while rest.any():
        sizes += rest > 0
        rest >>= np.uint64(7)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for i in range(int(sizes.max(initial=0))):
        has = sizes > i
        piece = (values[has] >> np.uint64(7 * i)) & np.uint64(127)
        out[starts[has] + i] = piece.astype(np.uint8) | ((sizes[has] > i + 1).astype(np.uint8) << 7)
    return out, sizes


def unpack(data: np.ndarray) -> np.ndarray:
    """The numbers in the bytes."""
    if not len(data):
        return np.zeros(0, np.int64)
    last = data < 128
    starts = np.flatnonzero(np.concatenate(([True], last[:-1])))
    if len(starts) == len(data):
        return data.astype(np.int64)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)
