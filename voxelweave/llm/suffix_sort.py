"""Suffix order by the difference cover {1, 2} modulo 3, vectorised, up to a wanted prefix length.

``suffix_ranks`` sorts the triples at sampled positions, recurses on their names, and merges the
remaining suffixes by their first symbol and the rank of the sampled suffix that follows. As only a
prefix of the given length has to be ordered, the recursion ends as soon as triples of names cover
it. Suffixes that agree on the prefix are neighbours; some of them may share a rank.
"""

from __future__ import annotations

import numpy as np


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


def _triples(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Dense ranks of the triples of s (padded) at the positions."""
    m = np.uint64(int(s.max()) + 1)
    pair = _dense(s[at] * m + s[at + 1]).astype(np.uint64)
    return _dense(pair * m + s[at + 2])


def suffix_ranks(s: np.ndarray, need: int) -> np.ndarray:
    """Ranks of all suffixes of s (uint64, above 0, below 2^31) by their first need symbols or more."""
    n = len(s)
    s = np.concatenate((s, np.zeros(3, np.uint64)))
    if need <= 3 or n < 4:
        return _triples(s, np.arange(n))
    i0, i1, i2 = (np.arange(k, n, 3) for k in range(3))
    names = _triples(s, np.concatenate((i1, i2))) + 1
    if names.max() < len(names):
        text = np.concatenate((names[: len(i1)], [0], names[len(i1) :])).astype(np.uint64)
        names = np.delete(suffix_ranks(text + np.uint64(1), -(-need // 3)), len(i1))
        names = _dense(names) + 1
    rank = np.zeros(n + 3, np.uint64)
    rank[i1], rank[i2] = names[: len(i1)], names[len(i1) :]
    b = np.uint64(int(rank.max()) + 1)
    m = np.uint64(int(s.max()) + 1)
    # the remaining suffixes against those at 1 modulo 3, and against those at 2
    one0, one1 = s[i0] * b + rank[i0 + 1], s[i1] * b + rank[i1 + 1]
    pairs = _dense(np.concatenate((s[i0] * m + s[i0 + 1], s[i2] * m + s[i2 + 1]))).astype(np.uint64)
    two0, two2 = pairs[: len(i0)] * b + rank[i0 + 2], pairs[len(i0) :] * b + rank[i2 + 2]
    less, same = np.zeros(len(i0), np.int64), np.zeros(len(i0), bool)
    for own, others in ((one0, one1), (two0, two2)):
        others = np.sort(others)
        at = np.searchsorted(others, own)
        less += at
        same |= others[np.minimum(at, len(others) - 1)] == own
    counts = np.bincount(names)
    smaller = np.cumsum(counts) - counts
    place = np.zeros(n, np.int64)
    place[np.concatenate((i1, i2))] = (2 * smaller[names] + 1) * (len(i0) + 1)
    place[i0] = (2 * less + same) * (len(i0) + 1) + np.where(same, 0, _dense(one0) + 1)
    return _dense(place)


def repeated_starts(data: bytes, valid: np.ndarray, length: int) -> np.ndarray:
    """Of the valid positions (each with length bytes after it), those whose string of that length starts at another valid one too."""
    step = 8
    n = len(data)
    pad = np.zeros(-(-(n + length + step) // step) * step + step, np.uint8)
    pad[:n] = np.frombuffer(data, np.uint8)
    total = len(pad) - step
    words = np.lib.stride_tricks.sliding_window_view(pad, step)[:total].copy().view(">u8").reshape(-1).astype(np.uint64)
    perm = np.arange(total).reshape(-1, step).T.reshape(-1)  # symbols of 8 bytes, so that the next symbol is 8 bytes on
    ranks = np.empty(total, np.int64)
    ranks[perm] = suffix_ranks((_dense(words) + 1)[perm].astype(np.uint64), -(-length // step))
    order = valid[np.argsort(ranks[valid], kind="stable")]
    a, b = order[:-1], order[1:]
    equal = np.arange(len(a))
    full, rest = divmod(length, step)
    for k in range(full):
        equal = equal[words[a[equal] + k * step] == words[b[equal] + k * step]]
    if rest:
        shift = np.uint64(8 * (step - rest))
        equal = equal[words[a[equal] + full * step] >> shift == words[b[equal] + full * step] >> shift]
    found = np.zeros(len(order), bool)
    found[equal], found[equal + 1] = True, True
    return np.sort(order[found])
