"""Texts as byte buffers: whole Arrow columns in numpy, without a Python object for each row or word.

All of it works on blocks of at most ``BLOCK`` bytes (a longer text is a block by itself), so that the arrays stay in
the processor's cache and memory doesn't follow the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []

#: ASCII capitals to small letters, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that part words: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def blocks(offs: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``most`` bytes, or of one row."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, b
        a = b


def spans(apart: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that aren't ``apart``, within a row each: starts, ends, and n + 1 bounds of the rows' runs."""
    n = len(apart)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    inside = ~apart
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0 to n - 1 modulo 2**64, and their inverses."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.concatenate([[U(1)], np.full(size - 1, U(b))]), dtype=U) for b in (_BASE, inverse)]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that scatters them (in a new array)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def prefix(buf: np.ndarray) -> np.ndarray:
    """Sums of byte * power up to each place, n + 1 of them."""
    out = np.empty(len(buf) + 1, U)
    out[0] = 0
    x = buf.astype(U)
    x += U(1)
    x *= powers(len(buf))[0]
    np.cumsum(x, out=out[1:])
    return out


def keyed_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int | np.ndarray = 0) -> np.ndarray:
    """A 64-bit hash of each run of bytes, from its length and its pieces of eight bytes, each scattered with its number.

    ``key``, a number or one for each run, gives another hash. Runs of one length up to eight never share one under a key."""
    return with_key(*scattered(buf, starts, ends), key)


def scattered(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the hashes of runs are made from under any key: their lengths, and the sums of their scattered pieces."""
    size = (ends - starts).astype(np.int64)
    count = (size + 7) >> 3
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    eights = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))
    first = np.cumsum(count) - count
    number = np.arange(int(count.sum()), dtype=np.int64) - np.repeat(first, count)
    pieces = eights[np.repeat(starts.astype(np.int64), count) + 8 * number]
    part = np.flatnonzero(size & 7)
    pieces[first[part] + count[part] - 1] &= (U(1) << (8 * (size[part] & 7)).astype(U)) - U(1)
    pieces ^= mix(np.arange(1, int(count.max(initial=0)) + 1, dtype=U) * U(_BASE))[number]
    sums, some = np.zeros(len(size), U), np.flatnonzero(count)
    if len(some):
        sums[some] = np.add.reduceat(mix(pieces), first[some])
    return size, sums


def with_key(size: np.ndarray, sums: np.ndarray, key: int | np.ndarray = 0) -> np.ndarray:
    """The hashes of runs under a key, from what ``scattered`` gives."""
    return mix(mix((np.zeros(len(size), U) + np.asarray(key).astype(U)) ^ mix(size.astype(U) + U(_BASE))) + sums)


def distinct(x: np.ndarray) -> np.ndarray:
    """The different numbers, sorted."""
    x = np.sort(x)
    new = x[1:] != x[:-1]
    return x if new.all() else x[np.concatenate([[True], new])]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes, sorted, of the word hashes' runs of ``size``; of fewer words, one for them all; of none, none."""
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    out = np.zeros(n - width + 1, U)
    for k in range(width):
        out += words[k : n - width + 1 + k] * powers(size + 1)[0][k + 1]
    return distinct(mix(out + U(width)))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + length), one after the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total, dtype=np.int64)
