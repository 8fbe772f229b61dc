"""Suffix arrays of short strings by two-stage sorting, in numpy.

Strings are rows of a zero-padded byte matrix; a suffix ends with its string.
A suffix is small if it precedes its successor (the suffix one byte later).
Only small suffixes are sorted directly, by eight-byte steps; scanning the
buckets of first bytes in order then induces every other suffix from its
successor.
"""

from __future__ import annotations

import numpy as np

#: Zero bytes after the longest string, so that eight-byte reads stay in a row.
PAD = 12


def _words(flat: np.ndarray) -> np.ndarray:
    return np.ndarray((len(flat) - 7,), ">u8", flat, strides=(1,))


def _sort_small(flat: np.ndarray, at: np.ndarray, deepest: int) -> np.ndarray:
    """Suffix starts in order, ties in order of position."""
    words = _words(flat)
    first = words[at].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    at, key = at[order], first[order]
    new = np.append(True, key[1:] != key[:-1])
    # groups of equal prefixes are sorted further until their strings end
    for depth in range(8, deepest + 8, 8):
        group = np.cumsum(new)
        same = ~new | ~np.append(new[1:], True)
        # a prefix whose last byte is padding has ended
        open_ = np.flatnonzero(same & ((key & np.uint64(255)) != 0))
        if not len(open_):
            break
        sub = words[at[open_] + depth].astype(np.uint64)
        order = np.lexsort((sub, group[open_]))
        at[open_] = at[open_][order]
        sub = sub[order]
        key[open_] = sub
        g = group[open_]
        new[open_[1:]] |= (sub[1:] != sub[:-1]) & (g[1:] == g[:-1])
    return at


def suffix_array(rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Starts (in the flattened matrix) of all non-empty suffixes, in order.

    ``rows``: uint8 matrix without zero bytes inside strings, at least PAD
    columns wider than the longest string.
    """
    n, width = rows.shape
    flat = rows.ravel()
    col = np.arange(width)
    text = (col < length[:, None]).ravel()
    stop = (col == length[:, None]).ravel()
    after = np.append(flat[1:], 0)
    # small: the next byte that differs is larger; a stop is small
    step = np.sign(after.astype(np.int16) - flat)
    step[stop] = 1
    known = np.where(step != 0, np.arange(len(flat)), len(flat))
    nearest = np.minimum.accumulate(known[::-1])[::-1]
    nearest[nearest == len(flat)] = len(flat) - 1
    small = (step[nearest] > 0) & (text | stop)
    direct = _sort_small(flat, np.flatnonzero(small), width)
    large = text & ~small
    # buckets: induced (large) suffixes first, directly sorted ones after them
    n_large = np.bincount(flat[large], minlength=256)
    n_small = np.bincount(flat[direct], minlength=256)
    head = np.cumsum(n_large + n_small) - n_large - n_small
    begin = head.copy()
    sa = np.zeros(int(n_large.sum() + n_small.sum()), np.int64)
    tail = begin + n_large
    rank = np.arange(len(direct)) - (np.cumsum(n_small) - n_small)[flat[direct]]
    sa[tail[flat[direct]] + rank] = direct

    def induce(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[large[before]]
        if not len(before):
            return
        c = flat[before]
        order = np.argsort(c, kind="stable")
        before, c = before[order], c[order]
        count = np.bincount(c, minlength=256)
        sa[head[c] + np.arange(len(c)) - (np.cumsum(count) - count)[c]] = before
        head[:] += count

    for c in range(256):
        done = begin[c]
        while done < head[c]:  # the scan may add to the bucket it scans
            wave = sa[done:head[c]].copy()
            done = head[c]
            induce(wave)
        induce(sa[tail[c]:tail[c] + n_small[c]])
    return sa[text[sa]]


def common_prefix_reaches(rows: np.ndarray, length: np.ndarray, sa: np.ndarray, size: int
                          ) -> np.ndarray:
    """Whether each suffix shares at least ``size`` (>= 8) bytes with the one before it."""
    width = rows.shape[1]
    words = _words(rows.ravel())
    out = np.zeros(len(sa), bool)
    if len(sa) < 2:
        return out
    left = length[sa // width] - sa % width
    ok = np.flatnonzero((left[1:] >= size) & (left[:-1] >= size)) + 1
    for at in [*range(0, size - 8, 8), size - 8]:
        ok = ok[words[sa[ok] + at] == words[sa[ok - 1] + at]]
    out[ok] = True
    return out
