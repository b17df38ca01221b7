"""Counting quotient filters over packed words: lossless counters in sorted, mergeable blocks of bytes.

A key is a pack of n 64-bit numbers (lanes). ``permuted`` maps it one-to-one to another pack that looks random, by a
Feistel walk over the lanes; ``restored`` undoes it. Of the permuted pack, the leading bits name the shard, the next ones
are the quotient, and all that's left is the remainder, kept in full, so nothing is lost and no two keys meet.

``packed`` writes a shard's entries, sorted, as one block: quotients in unary (a one for each entry, a zero after each
quotient), remainders with as many bytes as they need, counters in bytes of seven bits. ``unpacked`` reads it;
``summed`` merges sorted entries of several blocks.
"""

from __future__ import annotations

import numpy as np

from .textbuf import U, mix

_ROUNDS = 2


def _steps(n: int) -> list[tuple[int, int, U]]:
    return [(k, (k + 1) % n, U(0xA0761D6478BD642F * (r * n + k + 1) % (1 << 64))) for r in range(_ROUNDS) for k in reversed(range(n))]


def permuted(lanes: np.ndarray) -> np.ndarray:
    """An n x m array of m packs of n > 1 lanes, each pack mapped one-to-one."""
    out = lanes.copy()
    for k, other, salt in _steps(len(out)):
        out[k] ^= mix(out[other] + salt)
    return out


def restored(lanes: np.ndarray) -> np.ndarray:
    out = lanes.copy()
    for k, other, salt in reversed(_steps(len(out))):
        out[k] ^= mix(out[other] + salt)
    return out


def summed(lanes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different packs, sorted, and the sums of their counts."""
    if not len(counts):
        return lanes, counts
    order = np.argsort(lanes[0], kind="stable")
    lanes, counts = lanes[:, order], counts[order]
    same = lanes[0, 1:] == lanes[0, :-1]
    if (lanes[1:, 1:] != lanes[1:, :-1])[:, same].any():  # packs that share their first lane only
        order = np.lexsort(lanes[::-1])
        lanes, counts = lanes[:, order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (lanes[:, 1:] != lanes[:, :-1]).any(axis=0)]))
    return lanes[:, first], np.add.reduceat(counts, first)


def _sevens(counts: np.ndarray) -> np.ndarray:
    size = np.ones(len(counts), np.int64)
    for k in range(1, 9):
        size += counts >> (7 * k) > 0
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        own = size > k
        out[at[own] + k] = (counts[own] >> (7 * k) & 127) | np.where(size[own] > k + 1, 128, 0)
    return out


def _counts(data: np.ndarray, m: int) -> tuple[np.ndarray, int]:
    """The first m counters in ``data``, and the bytes they take."""
    ends = np.flatnonzero(data < 128)[:m] + 1
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    out = np.zeros(m, np.int64)
    for k in range(int((ends - starts).max(initial=0))):
        own = ends - starts > k
        out[own] |= (data[starts[own] + k] & 127).astype(np.int64) << (7 * k)
    return out, int(ends[-1]) if m else 0


def _widths(m: int, bits: int) -> tuple[int, int]:
    """Bits of the quotient, and bytes of the first lane's remainder, of m entries whose first ``bits`` bits are the shard."""
    q = min((m - 1).bit_length(), 64 - bits)
    return q, -(-(64 - bits - q) // 8)


def packed(lanes: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """The filter of sorted, different packs that share their first ``bits`` bits."""
    m = len(counts)
    q, wide = _widths(m, bits)
    rest = 64 - bits - q
    own = lanes[0] << U(bits) if bits else lanes[0]
    quotients = (own >> U(64 - q)).astype(np.int64) if q else np.zeros(m, np.int64)
    unary = np.zeros(m + (1 << q), bool)
    unary[np.arange(m) + quotients] = True
    low = (lanes[0] & U((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(m, 8)[:, :wide]
    others = np.ascontiguousarray(lanes[1:].T).astype("<u8").view(np.uint8)
    return b"".join([np.uint32(m).tobytes(), _sevens(counts).tobytes(), np.packbits(unary).tobytes(), low.tobytes(), others.tobytes()])


def unpacked(data: bytes, n: int, shard: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    m = int(raw[:4].view(np.uint32)[0])
    q, wide = _widths(m, bits)
    counts, used = _counts(raw[4:], m)
    at = 4 + used
    size = m + (1 << q)
    unary = np.unpackbits(raw[at : at + -(-size // 8)], count=size)
    at += -(-size // 8)
    first = np.zeros((m, 8), np.uint8)
    first[:, :wide] = raw[at : at + m * wide].reshape(m, wide)
    at += m * wide
    lanes = np.empty((n, m), U)
    lanes[0] = first.view("<u8")[:, 0]
    quotients = (np.flatnonzero(unary) - np.arange(m)).astype(U)
    if q:
        lanes[0] |= quotients << U(64 - bits - q)
    if bits:
        lanes[0] |= U(shard << (64 - bits))
    lanes[1:] = raw[at:].copy().view("<u8").reshape(m, n - 1).T
    return lanes, counts


class Counter:
    """Counts packs in bounded memory: when they come to ``most`` different ones, ``flushed`` gives them out."""

    def __init__(self, n: int, most: int = 1 << 20):
        self.n, self.most, self.parts, self.held = n, most, [], 0

    def add(self, lanes: np.ndarray, counts: np.ndarray | None = None) -> bool:
        """Takes permuted packs, once each unless ``counts`` says otherwise; True when it is time to flush."""
        self.parts.append(summed(lanes, np.ones(lanes.shape[1], np.int64) if counts is None else counts))
        self.held += len(self.parts[-1][1])
        if self.held > self.most:
            self._merge()
        return self.held > self.most // 2 and len(self.parts) == 1

    def _merge(self) -> None:
        if len(self.parts) > 1:
            self.parts = [summed(np.concatenate([p[0] for p in self.parts], axis=1), np.concatenate([p[1] for p in self.parts]))]
            self.held = len(self.parts[0][1])

    def flushed(self, bits: int) -> list[tuple[int, bytes]]:
        """(shard, filter) of all that is held, by the first ``bits`` bits; empties the counter."""
        self._merge()
        if not self.held:
            self.parts = []
            return []
        (lanes, counts), self.parts, self.held = self.parts[0], [], 0
        shards = (lanes[0] >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(counts), np.int64)
        cuts = np.flatnonzero(np.diff(shards)) + 1
        ends = [*cuts.tolist(), len(counts)]
        return [(int(shards[a]), packed(lanes[:, a:b], counts[a:b], bits)) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
