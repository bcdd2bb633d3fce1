"""Anchors: in every window of WINDOW bytes the run of RUN bytes with the smallest hash.

The choice depends on the bytes of the window alone, so equal windows have equal anchors
at equal places, and comparing windows of one anchor finds all equal ones.
"""

from __future__ import annotations

import numpy as np

WINDOW = 50
RUN = 16
#: Windows that are looked at together.
BLOCK = 1 << 18


def run_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the RUN bytes from each place on."""
    parts = raw.astype(np.uint64)
    for width in (1, 2, 4):
        parts = parts[:-width] | parts[width:] << np.uint64(8 * width)
    low, high = parts[:-8], parts[8:]
    with np.errstate(over="ignore"):
        mixed = low * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed = (mixed ^ high) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        return mixed * np.uint64(0x165667B19E3779F9)


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """How far after each place the smallest of ``width`` values stands, the first of
    equal ones. Windows double until two overlapping ones make the width."""
    best, offset, size = values, np.zeros(len(values), np.uint8), 1
    while size < width:
        step = min(size, width - size)
        later = best[step:] < best[: len(best) - step]
        offset = np.where(later, offset[step:] + np.uint8(step), offset[: len(offset) - step])
        best = np.minimum(best[step:], best[: len(best) - step])
        size += step
    return offset


def find_anchors(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """text, hash, place, low, high of each anchor of some texts laid end to end.

    ``low`` to ``high`` are the windows (by their first byte) that have the anchor; texts
    shorter than a window have none, and no window crosses an end. Works in blocks of
    windows, however long the texts; an anchor whose windows lie in two blocks comes twice,
    with a part of them each time.
    """
    parts = []
    for first in range(0, max(1, len(raw)), BLOCK):
        block = raw[first : first + BLOCK + WINDOW - 1]
        a, b = np.searchsorted(ends, first, side="right"), np.searchsorted(starts, first + len(block))
        found = _block_anchors(block, np.maximum(starts[a:b] - first, 0), ends[a:b] - first)
        text, hashes, *places = found
        parts.append((text + a, hashes, *(p + first for p in places)))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _block_anchors(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    none = np.zeros(0, np.int64)
    if len(raw) < WINDOW:
        return none, none.astype(np.uint64), none, none, none
    hashes = run_hashes(raw)
    places = np.arange(len(raw) - WINDOW + 1) + first_smallest(hashes, WINDOW - RUN + 1)
    text = np.repeat(np.arange(len(starts)), np.minimum(ends, len(raw)) - starts)[: len(places)]
    inside = np.flatnonzero(np.arange(len(places)) + WINDOW <= ends[text])
    if not len(inside):
        return none, none.astype(np.uint64), none, none, none
    places, text = places[inside], text[inside]
    new = np.append(True, (places[1:] != places[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(inside)) - 1
    return text[first], hashes[places[first]], places[first], inside[first], inside[last]
