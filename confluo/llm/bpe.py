"""Byte-level BPE encoding and decoding.

``Merger`` merges many pieces at once: pieces of like length form a padded matrix of token ids, each round merges the
leftmost pair of minimum rank in every row, which shortens all rows by one column; rows without a mergeable pair leave
the matrix. A pair's rank comes from a hash table in numpy arrays. A piece is merged once for each worker as long as it
is remembered; ``REMEMBERED`` bounds memory, not results. Pieces of more than the widest bucket are merged one by one
with a heap, by the same rule, in n log n steps.

Vocabulary and pattern are parameters; the file is a rank file (base64 token, rank), read on each executor.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .shared import map_arrow
from .textbuf import gather

RANKS, PATTERN = "byte_bpe_multi_50k.tiktoken", public_tokenizers.PATTERN
WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128)
REMEMBERED = 200_000
#: Characters that are split and encoded together.
AT_ONCE = 1 << 19
NONE = np.int64(1) << 40


class Pairs:
    """(left id, right id) to the id they merge into: open addressing, looked up for whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        merged = {(a << 32) | b: r for t, r in ranks.items() for i in range(1, len(t)) if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None}
        self.bits = max(4, (4 * len(merged) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int64)
        left, value = (np.fromiter(x, np.int64, len(merged)) for x in (merged.keys(), merged.values()))
        slot = self._slot(left)
        self.probes = 1
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            taken = free[first]
            self.keys[slot[taken]], self.ranks[slot[taken]] = left[taken], value[taken]
            rest = np.ones(len(left), bool)
            rest[taken] = False
            left, value, slot = left[rest], value[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks, NONE where a pair doesn't merge or holds a pad (-1)."""
        key = (a.astype(np.int64) << 32) | b
        slot = self._slot(key)
        got = self.keys[slot]
        out = np.where(got == key, self.ranks[slot], NONE)
        open_ = np.flatnonzero((got != key) & (got >= 0) & (b >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            got = self.keys[slot[open_]]
            hit = got == key[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (got >= 0)]
        return out


class Merger:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list = [None] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[i] = np.array([whole], np.int64)
            elif p:
                todo.append(i)
            else:
                out[i] = np.zeros(0, np.int64)
        lengths = np.array([len(pieces[i]) for i in todo], np.int64)
        low = 0
        for width in WIDTHS:
            rows = [todo[k] for k in np.flatnonzero((lengths > low) & (lengths <= width))]
            for k in range(0, len(rows), 8192):
                self._bucket([pieces[i] for i in rows[k : k + 8192]], rows[k : k + 8192], width, out)
            low = width
        for k in np.flatnonzero(lengths > low):
            out[todo[k]] = self._long(pieces[todo[k]])
        return out

    def _bucket(self, pieces: list[bytes], rows: list[int], width: int, out: list) -> None:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        ids = np.where(np.arange(width) < lengths[:, None], self.single[raw], -1)
        rank = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        names = np.array(rows)
        while True:
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(rank)), at]
            live = least < NONE
            if not live.all():
                for k in np.flatnonzero(~live):
                    out[names[k]] = ids[k, : lengths[k]]
                ids, rank, names, lengths, at, least = ids[live], rank[live], names[live], lengths[live], at[live], least[live]
                if not len(ids):
                    return
            n, w = ids.shape
            every, cols = np.arange(n), np.arange(w - 1)
            ids[every, at] = least
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            lengths = lengths - 1
            if w == 2:
                rank = np.full((n, 1), NONE)
                ids = np.concatenate([ids, np.full((n, 1), -1)], axis=1)
                continue
            cols = cols[:-1]
            rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), axis=1)
            k = np.flatnonzero(at < w - 2)
            rank[k, at[k]] = self.pairs(ids[k, at[k]], ids[k, at[k] + 1])
            k = np.flatnonzero(at > 0)
            rank[k, at[k] - 1] = self.pairs(ids[k, at[k] - 1], ids[k, at[k]])

    def _long(self, piece: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(piece, np.uint8)]
        first = self.pairs(ids[:-1], ids[1:])
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first < NONE)]
        heapq.heapify(heap)
        rank, ids, n = first.tolist() + [int(NONE)], ids.tolist(), len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        one = lambda a, b: int(self.pairs(np.array([a]), np.array([b]))[0])
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank[i] != r:
                continue
            j = after[i]
            ids[i], ids[j], after[i] = r, -1, after[j]
            rank[i] = rank[j] = int(NONE)
            if after[i] < n:
                before[after[i]] = i
                rank[i] = one(r, ids[after[i]])
                if rank[i] < NONE:
                    heapq.heappush(heap, (rank[i], i))
            if (p := before[i]) >= 0:
                rank[p] = one(ids[p], r)
                if rank[p] < NONE:
                    heapq.heappush(heap, (rank[p], p))
        return np.array([x for x in ids if x >= 0], np.int64)


class Pieces:
    """Texts to ids by pieces: ``split`` parts a text, ``merge`` gives the ids of pieces; both stay remembered."""

    def __init__(self, split: Callable[[str], list[str]], merge: Callable[[list[str]], list]):
        self.split, self.merge = split, merge
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and n + 1 bounds of the texts."""
        if len(self.known) > REMEMBERED:
            self.forget()
        pieces = [self.split(t) for t in texts]
        new = list(set().union(*pieces) - self.known.keys())
        if new:
            got = self.merge(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.int32, int(lengths.sum()))])
        where = self.known.__getitem__
        at = np.fromiter((where(p) for ps in pieces for p in ps), np.int64, sum(map(len, pieces)))
        lengths = self.lengths[at]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])
        total = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[gather(self.starts[at], lengths)], total[bounds]


class Codec(Pieces):
    """A rank file's texts to ids and back."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.merger = Merger(ranks)
        super().__init__(regex.compile(pattern).findall, lambda new: [x.tolist() for x in self.merger.encode([p.encode() for p in new])])
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for t, r in ranks.items():
            by_id[r] = t
        self.bytes_of = Ragged(by_id)
        self.digits_of = Ragged([b"%d," % i for i in range(size)])


class Ragged:
    """Byte strings by number, gathered by table lookup."""

    def __init__(self, items: list[bytes]):
        self.data = np.frombuffer(b"".join(items) or b"\0", np.uint8)
        self.lengths = np.fromiter(map(len, items), np.int64, len(items))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __call__(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The strings of all ids, and the bounds of their groups."""
        lengths = self.lengths[ids]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return self.data[gather(self.starts[ids], lengths)].tobytes(), total[bounds]


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def portions(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts of about AT_ONCE characters."""
    now, size = [], 0
    for t in texts:
        now.append(t or "")
        size += len(now[-1])
        if size >= AT_ONCE:
            yield now
            now, size = [], 0
    if now:
        yield now


def _append(batch: pa.RecordBatch, drop: set[str], **columns: pa.Array) -> pa.RecordBatch:
    keep = [n for n in batch.schema.names if n not in drop and n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in keep] + list(columns.values()), names=keep + list(columns))


def _schema(df: DataFrame, drop: set[str], more: str):
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(more)
    return StructType([f for f in df.schema.fields if f.name not in drop | set(new.names)] + new.fields)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """``df`` with the ids (array of int) of each text in place of the text; a null or empty text has no ids."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            parts = [own.encode(p) for p in portions(texts)]
            sizes = np.concatenate([[0], *(np.diff(b) for _, b in parts)]).cumsum()
            flat = np.concatenate([np.zeros(0, np.int32), *(i for i, _ in parts)])
            yield _append(batch, {text}, **{ids: pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))})

    return map_arrow(df, run, _schema(df, {text}, f"`{ids}` array<int>"))


def decode(df: DataFrame, ids: str = "ids", out: str = "bytes", path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """``df`` with the bytes (binary) of each list of ids in its place; null ids count as none."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            lists = [np.array(x if x is not None else [], np.int64) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
            data, at = own.bytes_of(np.concatenate([np.zeros(0, np.int64), *lists]), bounds)
            yield _append(batch, {ids}, **{out: pa.array([data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())})

    return map_arrow(df, run, _schema(df, {ids}, f"`{out}` binary"))


def round_trip(df: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """Encodes each text, decodes the ids again, and returns for each row ``id_col``, n_tokens, and the SHA-256 of the
    ids (decimal, joined by commas) and of the decoded bytes, in lowercase hex. Both are taken from the same ids, which
    don't leave the worker. An empty or null text has 0 tokens and the digests of nothing."""
    path = path or public_tokenizers.path(RANKS)
    hexed = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            texts, n, a, b = batch.column(1).to_pylist(), [], [], []
            for part in portions(texts):
                ids, bounds = own.encode(part)
                digits, at = own.digits_of(ids, bounds)
                digits, data_at = memoryview(digits), at
                a += [hexed(digits[x : max(x, y - 1)]) for x, y in zip(data_at[:-1], data_at[1:], strict=True)]
                data, at = own.bytes_of(ids, bounds)
                data = memoryview(data)
                b += [hexed(data[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
                n += np.diff(bounds).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(id_col, text), run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
