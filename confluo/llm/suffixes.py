"""Suffix arrays of shards by induced sorting, and permuted common prefixes, on numpy arrays.

Induced sorting classifies suffixes as smaller or larger than their right neighbour, sorts and names the substrings
between leftmost-smaller places, sorts those places by recursion on the names, and induces all other suffixes from them:
first the larger ones, each from its right neighbour, then the smaller ones. Over bytes that goes bucket by bucket (by first
symbol) in two linear passes; within a bucket, waves of suffixes are induced at once. A reduced string has many names and
small buckets; there all suffixes of a kind are induced together, in waves that double their reach: a suffix's place
follows from its symbols up to the next suffix that is placed already, and from that one's place. A wave is one sort, and as many
are needed as the logarithm of the longest run of one kind.
"""

from __future__ import annotations

import numpy as np

#: Up to so many symbols go bucket by bucket.
BUCKETS = 2048


def _ranked(own: np.ndarray, key: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Ranks of the places ``own`` by the keys from each place to its ``stop``, both included."""
    rank = np.zeros(len(key), np.int64)
    rank[own] = np.unique(key[own], return_inverse=True)[1]
    width = 1
    while True:
        inside = own + width <= stop[own]
        if not inside.any():
            return rank
        further = np.zeros(len(own), np.int64)
        further[inside] = rank[own[inside] + width] + 1
        rank[own] = np.unique(rank[own] * (len(own) + 2) + further, return_inverse=True)[1]
        width *= 2


def _waves(s: np.ndarray, small: np.ndarray, sorted_at: np.ndarray) -> np.ndarray:
    """The suffix array, induced from the sorted leftmost-smaller places. Of like first symbols a larger suffix goes first."""
    n, place = len(s), np.arange(len(s))
    code, least = 2 * s.astype(np.int64) + small, np.zeros(n, np.int64)
    least[sorted_at] = np.arange(len(sorted_at))

    def following(mask: np.ndarray) -> np.ndarray:
        """For each place the first one from it on that has the mask, or the last place."""
        return np.minimum.accumulate(np.where(mask, place, n - 1)[::-1])[::-1]

    leftmost = np.zeros(n, bool)
    leftmost[sorted_at] = True
    larger = _ranked(np.flatnonzero(~small | leftmost), code * n + least, following(leftmost))
    smaller = _ranked(place, code * n + np.where(small, 0, larger), following(~small))
    return np.argsort(smaller, kind="stable")


def _names(s: np.ndarray, at: np.ndarray, alphabet: int) -> np.ndarray:
    """Ranks of the substrings from each place to the next one (both included); one that is a prefix of another is larger."""
    bits = (alphabet + 1).bit_length()
    each = 63 // bits
    length = np.diff(np.concatenate([at, [len(s)]]))
    length[:-1] += 1
    pad = (1 << bits) - 1

    def word(rows: np.ndarray, skip: int) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        for k in range(skip, skip + each):
            inside = k < length[rows]
            out = (out << bits) | np.where(inside, s[np.minimum(at[rows] + k, len(s) - 1)], pad)
        return out

    every = np.arange(len(at))
    first = word(every, 0)
    ordered = np.sort(first)
    rank = np.searchsorted(ordered, first)
    skip = each
    while True:
        tied = np.bincount(rank, minlength=len(at))[rank] > 1
        longer = np.zeros(len(at), bool)
        longer[rank[tied & (length > skip)]] = True
        rows = np.flatnonzero(tied & longer[rank])
        if not len(rows):
            return rank
        more = word(rows, skip)
        order = np.lexsort((more, rank[rows]))
        rows, more = rows[order], more[order]
        group = np.concatenate([[True], rank[rows][1:] != rank[rows][:-1]])
        apart = group | np.concatenate([[True], more[1:] != more[:-1]])
        place = np.arange(len(rows))
        rank[rows] += np.maximum.accumulate(np.where(apart, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        skip += each


def suffix_array(s: np.ndarray, alphabet: int) -> np.ndarray:
    """Of symbols 0 to alphabet - 1, of which 0 stands at the end and nowhere else."""
    n = len(s)
    if n < 3:
        return np.argsort(s, kind="stable")
    step = np.diff(s.astype(np.int64))
    decides = np.minimum.accumulate(np.where(step != 0, np.arange(n - 1), n)[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = step[decides] > 0
    at = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    rank = _names(s, at, alphabet)
    order = np.argsort(rank, kind="stable")
    apart = np.concatenate([[0], (np.diff(rank[order]) != 0).astype(np.int64)])
    if apart.sum() < len(at) - 1:
        names = np.empty(len(at), np.int64)
        names[order] = np.cumsum(apart)
        order = suffix_array(names, int(apart.sum()) + 1)
    return _induce(s, small, at[order], alphabet) if alphabet <= BUCKETS else _waves(s, small, at[order])


def _induce(s: np.ndarray, small: np.ndarray, sorted_at: np.ndarray, alphabet: int) -> np.ndarray:
    n = len(s)
    size = np.bincount(s, minlength=alphabet)
    tail = np.cumsum(size)
    head = tail - size
    larger = np.bincount(s[~small], minlength=alphabet)
    out = np.full(n, -1, np.int64)
    own = s[sorted_at]
    lows, highs = np.searchsorted(own, np.arange(alphabet)), np.searchsorted(own, np.arange(alphabet), "right")

    def spread(now: np.ndarray, kind: bool, free: np.ndarray, step: int) -> None:
        """Puts the left neighbours of ``now`` that are of this kind into their buckets, in order."""
        before = now[now > 0] - 1
        before = before[small[before] == kind]
        if not len(before):
            return
        symbols = s[before]
        order = np.argsort(symbols, kind="stable")
        symbols = symbols[order]
        count = np.bincount(symbols, minlength=alphabet)
        within = np.arange(len(symbols)) - (np.cumsum(count) - count)[symbols]
        out[free[symbols] + step * within] = before[order]
        free += step * count

    free = head.copy()
    for c in np.flatnonzero(size):
        done = head[c]
        while done < free[c]:
            wave, done = out[done : free[c]].copy(), free[c]
            spread(wave, False, free, 1)
        if highs[c] > lows[c]:
            spread(sorted_at[lows[c] : highs[c]], False, free, 1)
    free = tail - 1
    out[0] = n - 1
    for c in np.flatnonzero(size)[::-1]:
        done = tail[c] - 1
        while done > free[c]:
            wave, done = out[free[c] + 1 : done + 1][::-1].copy(), free[c]
            spread(wave, True, free, -1)
        if larger[c]:
            spread(out[head[c] : head[c] + larger[c]][::-1], True, free, -1)
    out[0] = n - 1
    return out


def common_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of ``text`` (bytes): the place before it in the suffix array (-1 for the first) and the length of
    their common prefix, in text order. Only places whose left neighbours differ are compared byte by byte; at the
    others the length is one less than at the place before."""
    n = len(text)
    previous = np.empty(n, np.int64)
    previous[order[0]], previous[order[1:]] = -1, order[:-1]
    place = np.arange(n)
    start = (place == 0) | (previous <= 0)
    inner = np.flatnonzero(~start)
    start[inner] = text[inner - 1] != text[previous[inner] - 1]
    at = np.flatnonzero(start & (previous >= 0))
    length = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.ndarray((n + 8,), "<u8", padded, strides=(1,))
    live, other, far = at, previous[at], np.zeros(len(at), np.int64)
    left = np.arange(len(at))
    while len(left):
        a, b = live[left] + far[left], other[left] + far[left]
        fits = np.maximum(a, b) + 8 <= n
        same = fits & (words[np.minimum(a, n)] == words[np.minimum(b, n)])
        far[left[same]] += 8
        left_over = left[~same]
        for _ in range(8):
            a, b = live[left_over] + far[left_over], other[left_over] + far[left_over]
            more = (np.maximum(a, b) < n) & (padded[np.minimum(a, n)] == padded[np.minimum(b, n)])
            left_over = left_over[more]
            far[left_over] += 1
        left = left[same]
    length[at] = far
    last = np.maximum.accumulate(np.where(start, place, 0))
    return previous, np.where(start, length, np.maximum(length[last] - (place - last), 0))
