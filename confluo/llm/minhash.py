"""Circulant MinHash and exact links within groups, for documents and lines.

Two permutations make all coordinates of a signature. The first scatters an element over a ring of ``RING`` places; the
second gives each place a number. Coordinate k is the least number at (place + k) over the elements: the second
permutation, circularly shifted by k. The K numbers of one element are therefore K neighbours in one table.
"""

from __future__ import annotations

import numpy as np

from .textbuf import U, mix

RING = 1 << 20
_tables: dict[tuple[int, int], np.ndarray] = {}


def table(size: int, ring: int = RING) -> np.ndarray:
    """The second permutation, of ``ring`` places, followed by its first ``size`` numbers."""
    if (size, ring) not in _tables:
        numbers = np.random.default_rng(20).permutation(ring).astype(np.uint32)
        _tables[size, ring] = np.concatenate([numbers, numbers[:size]])
    return _tables[size, ring]


def signature(elements: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a non-empty set of 64-bit hashes."""
    places, view = ((mix(elements + U(0x51ED270B)) >> U(24)) & U(RING - 1)).astype(np.int64), np.lib.stride_tricks.sliding_window_view(table(size), size)
    out = view[places[:2048]].min(axis=0)
    for k in range(2048, len(places), 2048):
        np.minimum(out, view[places[k : k + 2048]].min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """n x bands 64-bit hashes of each band's coordinates and number."""
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows).astype(U)
    out = np.zeros((len(signatures), bands), U) + np.arange(1, bands + 1, dtype=U)
    for k in range(rows):
        out = mix(out * U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return out.view(np.int64)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets (sorted, distinct hashes), m x m, right in the upper triangle only.

    Frequent elements are counted by a matrix product, the others by their pairs of holders."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    flat = np.concatenate(sets) if m else np.zeros(0, U)
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    held = np.diff(np.concatenate([first, [len(flat)]]))
    out = np.zeros((m, m), np.float32)
    often = np.flatnonzero(held > 48)
    for k in range(0, len(often), 1024):
        some = often[k : k + 1024]
        part = np.zeros((m, len(some)), np.float32)
        for j, e in enumerate(some):
            part[owner[first[e] : first[e] + held[e]], j] = 1
        out += part @ part.T
    counts = np.zeros(m * m, np.int64)
    for d in np.unique(held[(held > 1) & (held <= 48)]).tolist():
        own, (x, y) = first[held == d], np.triu_indices(d, 1)
        step = max(1, (1 << 21) // (d * d))
        for k in range(0, len(own), step):
            rows = owner[own[k : k + step, None] + np.arange(d)]  # the holders ascend
            flat_pairs = (rows[:, x] * m + rows[:, y]).ravel()
            if len(flat_pairs) * 4 > m * m:
                counts += np.bincount(flat_pairs, minlength=m * m)
            else:
                np.add.at(counts, flat_pairs, 1)
    out = out.astype(np.int64) + counts.reshape(m, m)
    out[np.arange(m), np.arange(m)] = [len(s) for s in sets]
    return out


def links(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs a < b with 100 * intersection >= percent * union, exactly; empty sets link with nothing."""
    both, size = overlaps(sets), np.array([len(s) for s in sets], np.int64)
    a, b = np.nonzero(np.triu(both, 1))
    near = (100 + percent) * both[a, b] >= percent * (size[a] + size[b])
    return a[near], b[near]


def grouped_links(sets: list[np.ndarray], sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many small groups at once: the first ``sizes[0]`` sets are one group, and so on; pairs within groups only."""
    count = np.array([len(s) for s in sets], np.int64)
    owner, flat = np.repeat(np.arange(len(sets)), count), np.concatenate([np.zeros(0, U), *sets])
    first_set = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    flat = flat ^ mix(group.astype(U) + U(0x9E3779B97F4A7C15))[owner]  # an element of two groups is two elements
    order = np.argsort(flat)
    owner, flat = owner[order], flat[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    held = np.diff(np.append(first, len(flat)))
    squares = np.cumsum(sizes * sizes) - sizes * sizes  # where each group's pairs begin
    both = np.zeros(int((sizes * sizes).sum()), np.int64)
    for d in np.unique(held[held > 1]).tolist():
        at, (x, y) = first[held == d], np.triu_indices(d, 1)
        step = max(1, (1 << 20) // (d * d))
        for k in range(0, len(at), step):
            rows = owner[at[k : k + step, None] + np.arange(d)]
            rows.sort(axis=1)
            g = group[rows[:, 0]]
            local = rows - first_set[g][:, None]
            place = (squares[g][:, None] + local[:, x] * sizes[g][:, None] + local[:, y]).ravel()
            np.add.at(both, place, 1) if place.size * 8 < len(both) else np.add(both, np.bincount(place, minlength=len(both)), out=both)
    some = np.flatnonzero(both)
    g = np.searchsorted(squares, some, "right") - 1
    a, b = first_set[g] + (some - squares[g]) // sizes[g], first_set[g] + (some - squares[g]) % sizes[g]
    near = 100 * both[some] >= percent * (count[a] + count[b] - both[some])
    return a[near], b[near]
