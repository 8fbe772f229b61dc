"""Content-defined anchors: every window of ``window`` bytes owns one.

An anchor is the start of a k-gram. Of the k-grams inside a window the one of
smallest priority is chosen, so equal windows choose equal anchors wherever
they stand. K-grams that start at a step from a delimiter to another byte come
first; where a window has none of them, all its positions are candidates.
"""

from __future__ import annotations

import numpy as np

K = 24
WINDOW = 50
_REACH = WINDOW - K + 1  # k-gram starts per window


def _hash(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    words = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    h = np.zeros(len(at), np.uint64)
    for j in range(0, K, 8):
        h = (h ^ words[at + j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _nearest(pos: np.ndarray, rank: np.ndarray, step: int) -> np.ndarray:
    """Distance to the nearest smaller rank on one side, at most _REACH."""
    n = len(pos)
    out = np.full(n, _REACH, np.int64)
    active = np.arange(n)
    t = 0
    while len(active):
        t += 1
        other = active + step * t
        active = active[(other >= 0) & (other < n)]
        other = active + step * t
        gap = np.abs(pos[other] - pos[active])
        near = gap < _REACH
        active, other, gap = active[near], other[near], gap[near]
        smaller = rank[other] < rank[active]
        out[active[smaller]] = gap[smaller]
        active = active[~smaller]
    return out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, key, first window, last window) of every anchor.

    Windows are given by their start in the text; those from first to last own
    the anchor. Texts shorter than a window have none.
    """
    # texts are set apart by _REACH bytes, so positions of two never meet
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size + _REACH) - size
    buf = np.frombuffer(bytes(_REACH) + bytes(_REACH).join(texts) + bytes(_REACH + 8), np.uint8)
    long_ = np.flatnonzero(size >= WINDOW)
    if not len(long_):
        e = np.zeros(0, np.int64)
        return e, e.astype(np.uint64), e, e
    first, last = begin[long_], begin[long_] + size[long_] - K  # k-gram starts
    space = buf <= 0x20
    steps = np.flatnonzero(space[:-1] & ~space[1:])
    owner = np.searchsorted(first, steps, "right") - 1
    ok = (owner >= 0) & (steps <= last[np.maximum(owner, 0)])
    steps, owner = steps[ok], owner[ok]
    # gaps without a step that are as wide as a window: every position counts
    edge = np.concatenate([steps, first - 1, last + 1])
    own = np.concatenate([owner, np.arange(len(first)), np.arange(len(first))])
    order = np.lexsort((edge, own))
    edge, own = edge[order], own[order]
    wide = np.flatnonzero((own[1:] == own[:-1]) & (edge[1:] - edge[:-1] > _REACH))
    width = edge[wide + 1] - edge[wide] - 1
    dense = np.repeat(edge[wide] + 1 - np.cumsum(width) + width, width) + np.arange(width.sum())
    pos = np.concatenate([steps, dense])
    own = np.concatenate([owner, np.repeat(own[wide], width)])
    late = np.repeat([0, 1], [len(steps), len(dense)]).astype(np.uint64) << np.uint64(63)
    key = _hash(buf, pos)
    order = np.argsort(pos, kind="stable")
    pos, own, key, late = pos[order], own[order], key[order], late[order]
    rank = (key >> np.uint64(1)) | late
    left = np.minimum(_nearest(pos, rank, -1), pos - first[own] + 1)
    right = np.minimum(_nearest(pos, rank, 1), last[own] + 1 - pos)
    at = np.flatnonzero(left + right > _REACH)
    pos, own, left, right = pos[at], own[at], left[at], right[at]
    start = first[own]
    return (long_[own], key[at], pos - left + 1 - start, pos + right - _REACH - start)
