"""Positions along a Morton curve, and cubes as ranges of it."""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.functions.astro import cell

#: The shifts and masks that put two zeros before each of 21 bits.
_SPREAD = ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))
BITS = 21
_HALF = 1 << (BITS - 1)


def morton_key(x: Column, y: Column, z: Column, unit: float) -> Column:
    """A long that interleaves the bits of the cells of size ``unit``; positions beyond 2^20 cells from the origin count to the last one, NaN to cell 0."""
    out = None
    for i, c in enumerate((x, y, z)):
        spread = F.least(F.greatest(cell(c, unit), F.lit(-_HALF)), F.lit(_HALF - 1)).cast("bigint") + _HALF
        for shift, mask in _SPREAD:
            spread = spread.bitwiseOR(F.shiftleft(spread, shift)).bitwiseAND(F.lit(mask))
        spread = F.shiftleft(spread, i)
        out = spread if out is None else out.bitwiseOR(spread)
    return out


def _interleaved(at: Sequence[int]) -> int:
    return sum(((a >> b) & 1) << (3 * b + i) for i, a in enumerate(at) for b in range(BITS))


def _cell_of(v: float, unit: float) -> int:
    return math.floor(min(max(v / unit, -_HALF), _HALF - 1)) + _HALF  # as cell has it, not //


def cube_ranges(center: Sequence[float], radius: float, unit: float, most: int = 64) -> list[tuple[int, int]]:
    """Ranges of keys (both ends in) that hold every position in the cube of half side ``radius``; about ``most`` of them, the fewer the wider.

    The octant that is all space is divided, the largest partly covered octant first, until there are so many; octants within the
    cube stay whole, neighbouring ranges are joined.
    """
    if not radius >= 0:
        return []
    low = [_cell_of(c - radius, unit) for c in center]
    high = [_cell_of(c + radius, unit) for c in center]
    done: list[tuple[int, int]] = []
    heap = [(-BITS, 0, (0, 0, 0))]
    while heap and len(heap) + len(done) < most and heap[0][0] < 0:
        size, _, corner = heapq.heappop(heap)
        half = 1 << (-size - 1)
        for octant in range(8):
            at = tuple(c + half * ((octant >> i) & 1) for i, c in enumerate(corner))
            if any(a > h or a + half <= lo for a, lo, h in zip(at, low, high, strict=True)):
                continue
            key = _interleaved(at)
            if all(a >= lo and a + half - 1 <= h for a, lo, h in zip(at, low, high, strict=True)):
                done.append((key, key + half**3 - 1))
            else:
                heapq.heappush(heap, (size + 1, key, at))
    done += [(key, key + (1 << (-3 * size)) - 1) for size, key, _ in heap]
    joined: list[tuple[int, int]] = []
    for a, b in sorted(done):
        if joined and a == joined[-1][1] + 1:
            joined[-1] = joined[-1][0], b
        else:
            joined.append((a, b))
    return joined


def in_ranges(key: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether a key lies in one of the ranges; comparisons only, so that Parquet readers skip by them."""
    out = F.lit(False)
    for k, (a, b) in enumerate(ranges):
        hit = (key >= a) & (key <= b)
        out = hit if k == 0 else out | hit
    return out
