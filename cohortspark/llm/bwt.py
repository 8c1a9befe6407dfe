"""Groups of equal substrings by interval expansion on a Burrows-Wheeler transform.

Breadth-first backward extension: the intervals of all strings of length 1, 2, ... are derived from each other by
counting characters in the transform.  A string of length ``l + 1`` whose interval ends where no common prefix is known
yet fixes the common prefix there as ``l``, so common prefixes appear by increasing value, and the work stops at the
wanted length.  What is still open between two neighbours then is at least that length.

The suffixes are first sorted by 8 bytes at once, which tells the intervals of all strings of that length and every
shorter common prefix, so the extension begins there.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 255  # a byte that UTF-8 does not use; larger than every other


def _first_bytes(text: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as one number, separators beyond the end."""
    padded = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)])
    return np.ndarray(len(text), ">u8", padded, strides=(1,)).astype(np.uint64)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` bytes or more, ties in any order: prefix doubling that sorts only what
    is still tied."""
    n = len(text)
    keys = _first_bytes(text)
    order = np.argsort(keys)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    ordered = keys[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    width = 8
    tied = _tied(order, fresh)
    while width < depth and len(tied):
        after = tied + width
        keys = (rank[tied] << 32) | np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(keys)
        tied, keys = tied[by], keys[by]
        at = np.arange(len(tied))
        group = np.concatenate([[True], (keys[1:] >> 32) != (keys[:-1] >> 32)])
        where = (keys >> 32) + at - np.maximum.accumulate(np.where(group, at, 0))
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        place[tied] = where
        rank[tied] = np.maximum.accumulate(np.where(fresh, where, 0))
        tied = _tied(tied, fresh)
        width *= 2
    order[place] = np.arange(n)
    return order


def _tied(items: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    alone = fresh & np.concatenate([fresh[1:], [True]])
    return items[~alone]


def _extended(
    low: np.ndarray, high: np.ndarray, bwt: np.ndarray, step: np.ndarray, places: list, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Intervals of all strings one byte longer in front; none with a separator."""
    size = high - low
    lows, highs = [], []
    one = size == 1
    if one.any():
        at = low[one]
        at = step[at[bwt[at] != SEPARATOR]]
        lows.append(at)
        highs.append(at + 1)
    low, high, size = low[~one], high[~one], size[~one]
    total = int(size.sum())
    if len(low) and total > len(places) * len(low):  # few wide intervals: count each byte by search
        for c, where in places:
            a, b = np.searchsorted(where, low), np.searchsorted(where, high)
            some = b > a
            lows.append(first[c] + a[some])
            highs.append(first[c] + b[some])
    elif len(low):  # many narrow ones: group their elements by byte
        which = np.repeat(np.arange(len(low)), size)
        at = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        c = bwt[at]
        solid = c != SEPARATOR
        keys = (which[solid] << 8 | c[solid]) << 32 | step[at[solid]]
        keys.sort()
        if len(keys):
            edge = (keys[1:] >> 32) != (keys[:-1] >> 32)
            lows.append(keys[np.concatenate([[True], edge])] & 0xFFFFFFFF)
            highs.append((keys[np.concatenate([edge, [True]])] & 0xFFFFFFFF) + 1)
    if not lows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(lows), np.concatenate(highs)


def _intervals(text: np.ndarray, order: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, cuts): intervals of the strings of ``width`` bytes (at most 8) without a separator, and all places of
    the order where such strings or ones with a separator change, both ends included."""
    n = len(text)
    keys = _first_bytes(text)[order] >> np.uint64(64 - 8 * width)
    cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [n]])
    before = np.concatenate([[0], np.cumsum(text == SEPARATOR)])
    at = order[cuts[:-1]]
    solid = (at + width <= n) & (before[np.minimum(at + width, n)] == before[at])
    return cuts[:-1][solid], cuts[1:][solid], cuts


def equal_substrings(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): suffixes in sorted order and a group number for each, rising along the order; suffixes whose
    first ``length`` bytes hold no separator are in one group exactly when these bytes are equal."""
    n = len(text)
    order = suffix_order(text, length)
    bwt = text[order - 1]  # in front of the first byte stands the last, a separator
    by_byte = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)
    step[by_byte] = np.arange(n)
    counts = np.bincount(bwt, minlength=256)
    first = np.cumsum(counts) - counts
    present = [c for c in np.flatnonzero(counts).tolist() if c != SEPARATOR]
    places = [(c, by_byte[first[c] : first[c] + counts[c]]) for c in present]
    known = np.zeros(n + 1, bool)
    width = min(8, length)
    low, high, cuts = _intervals(text, order, width)
    known[cuts] = True
    for _ in range(length - width):
        if not len(low):
            break
        low, high = _extended(low, high, bwt, step, places, first)
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
    return order, np.cumsum(known[:n]) - 1
