"""Exact integer inner products from float64 matrix products.

Integers are broken into limbs so narrow that a whole float64 dot product of limbs stays below 2^53, where
every integer is exact. The products of the limbs are put together again in int64.
"""

from __future__ import annotations

import math

import numpy as np


def limb_bits(length: int) -> int:
    """Bits of a limb for dot products of ``length`` terms: length * 2^(2 bits) <= 2^53."""
    return (53 - math.ceil(math.log2(max(length, 1)))) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """int64 ``values`` as float64 limbs, least first; the last one holds the sign."""
    out = []
    rest = values
    while len(rest.ravel()) and max(int(rest.max()), -int(rest.min())) >= 1 << bits:
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def largest(values: np.ndarray) -> int:
    return max(int(values.max()), -int(values.min())) if values.size else 0


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 arrays (stacks of matrices too), exact. Sums that may leave int64 are an error."""
    length = a.shape[-1]
    if length * largest(a) * largest(b) >= 1 << 63:
        raise OverflowError("inner products of these integers leave 64 bits")
    bits = limb_bits(length)
    left, right = limbs(a, bits), limbs(b, bits)
    total = None
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            part = (x @ y).astype(np.int64)
            # bits that leave at the top cancel: the whole sum fits
            part = part << (bits * (i + j)) if i + j else part
            total = part if total is None else total + part
    return total


def floored(values: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) as int64; magnitudes of ``limit`` or more are an error."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if scaled.size and np.abs(scaled).max() >= limit:
        raise OverflowError(f"a component is {limit // scale} or more, so that sums of squares may leave 64 bits")
    return scaled.astype(np.int64)
