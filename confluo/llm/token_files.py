"""Token ids as binary files.

Texts are dealt by ranges of their id, so that shards, and texts within a shard, stand in ascending order of id; each
text is encoded with the tokenizers library, and ids are written in blocks of about ``BLOCK_IDS``. A block holds whole
documents. Its ids are replaced by their rank by frequency in the block, and ranks are coded in 1 to 4 bytes each, byte
aligned, with the lengths (2 bits each) in separate control bytes; decoding is a table lookup over control bytes. Blocks
are rows of Parquet files written by Spark, so they go wherever Spark can write, and a lost executor's part is written
again: shard, block, the ids and lengths of its documents, the place of its first id in the shard, the table of ranks,
control and data.

Texts are cut into chunks at places across which the pre-tokenizer never joins, on bytes; the chunks of a block are told
apart by a hash and the bytes themselves are compared, so each different chunk goes to the library once for each worker,
as long as it is remembered. The tokenizer's added tokens in a text are chunks of their own and become their ids, as
the library has it.

A null or empty text has no ids but the end id. Rows that repeat an id stand next to each other, by the hash of their text.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import map_arrow, shared_dir
from .textbuf import blocks, gather, keyed_hashes, utf8

TOKENIZER, END = "byte_bpe_50k.json", 2
BLOCK_IDS = 1 << 21
#: Chunks that a worker remembers; it bounds memory, not results.
REMEMBERED = 1 << 20
#: Chunks that go to the library as one text, and bytes that are encoded together.
AT_ONCE, ENCODED = 4096, 1 << 21
#: Blanks before which a chunk may begin, and other bytes that are white space of their own.
BLANK, ODD = np.zeros(256, bool), np.zeros(256, bool)
BLANK[[9, 10, 13, 32]] = True
ODD[[11, 12, *range(28, 32)]] = True

#: Lengths of the four ids of each control byte, and which of their 16 bytes they use.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_USED = (np.arange(4) < _LENGTHS[:, :, None]).reshape(256, 16)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of numbers below 2**32."""
    n = len(values)
    padded = np.zeros(-(-n // 4) * 4, "<u4")
    padded[:n] = values
    sizes = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = (sizes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    return control.tobytes(), padded.view(np.uint8).reshape(-1, 16)[_USED[control]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n numbers; what pads the last control byte is dropped."""
    codes = np.frombuffer(control, np.uint8)
    out = np.zeros((len(codes), 16), np.uint8)
    out[_USED[codes]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").ravel()[:n]


def by_frequency(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids by falling frequency (ties to the smaller one), and each id's rank."""
    counts = np.bincount(ids)
    order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint32)
    rank[order] = np.arange(len(order))
    return order.astype("<u4"), rank[ids]


def chunks(buf: np.ndarray, offs: np.ndarray, added: re.Pattern | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The places where the chunks of a block of texts begin, and the bytes that are, or may be the last of, white space.
    A chunk begins with a text, with a blank after a character that isn't white space, and before and after an added token."""
    n = len(buf)
    cut = np.zeros(n + 1, bool)
    blank = BLANK[buf]
    before = blank | ODD[buf]
    before[1:] |= ((buf[1:] == 0x85) | (buf[1:] == 0xA0)) & (buf[:-1] == 0xC2)
    middle = (buf[1:-1] == 0x80) | (buf[1:-1] == 0x81) | (buf[1:-1] == 0x9A)
    before[2:] |= middle & (buf[:-2] >= 0xE1) & (buf[:-2] <= 0xE3)
    cut[1:n] = blank[1:] & ~before[:-1]
    cut[offs] = True
    if added is not None:
        for m in added.finditer(buf.tobytes()):
            a, b = m.span()
            if np.searchsorted(offs, a, "right") == np.searchsorted(offs, b, "left"):  # within a text
                cut[a + 1 : b], cut[a], cut[b] = False, True, True
    return np.flatnonzero(cut[:n]), before


class Encoder:
    """Blocks of texts to ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.own = Tokenizer.from_file(path)
        added = self.own.get_added_tokens_decoder().values()
        split = self.own.pre_tokenizer
        self.plain = self.own.normalizer is None and isinstance(split, ByteLevel) and not split.add_prefix_space and split.use_regex
        self.plain &= not any(t.lstrip or t.rstrip or t.single_word for t in added)  # else whole texts go to the library
        vocabulary = self.own.get_vocab(with_added_tokens=False)
        self.size = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.size[list(vocabulary.values())] = [len(t) for t in vocabulary]  # a character stands for a byte
        self.joins = self.plain and not any(c.isspace() for t in added for c in t.content)
        self.added = re.compile(b"|".join(re.escape(t.content.encode()) for t in sorted(added, key=lambda t: -len(t.content)))) if added else None
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes, and where their chunks stand
        self.ids, self.bytes = (_Lists(t) for t in (np.int32, np.uint8))

    def _one_by_one(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' ids, one after the other, and how many each has."""
        got = [e.ids for e in self.own.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        return np.array([x for g in got for x in g], np.int32), np.array([len(g) for g in got], np.int64)

    def _joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that begin with a blank and end otherwise: the library parts them again when they are one text,
        and the bytes of its tokens tell where."""
        out = []
        for k in range(0, len(pieces), AT_ONCE):
            some = pieces[k : k + AT_ONCE]
            ids = np.array(self.own.encode_batch_fast([b"".join(some).decode()], add_special_tokens=False)[0].ids, np.int32)
            last, ends = np.cumsum(self.size[ids]), np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            at = np.searchsorted(last, ends)
            whole = len(last) and last[-1] == ends[-1] and np.array_equal(last[at], ends)
            out.append((ids, np.diff(np.concatenate([[0], at + 1]))) if whole else self._one_by_one(some))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else self._one_by_one([])

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and n + 1 bounds of the texts."""
        starts, white = chunks(buf, offs, self.added) if self.plain else (offs[:-1][np.diff(offs) > 0], None)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        ends = np.concatenate([starts[1:], [len(buf)]])
        if len(self.known) > REMEMBERED:
            self.forget()
        names, first, back = np.unique(keyed_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        found = np.searchsorted(self.known, names)
        new = np.ones(len(names), bool)
        inside = found < len(self.known)
        new[inside] = self.known[found[inside]] != names[inside]
        new = np.flatnonzero(new)
        if len(new):
            raw, place = buf.tobytes(), first[new]
            alike = BLANK[buf[starts[place]]] & ~white[ends[place] - 1] if self.joins else np.zeros(len(place), bool)
            order = np.argsort(~alike, kind="stable")
            place, many = place[order], int(alike.sum())
            number = np.empty(len(new), np.int64)
            number[order] = len(self.known) + np.arange(len(new))
            self.place = np.insert(self.place, found[new], number)
            self.known = np.insert(self.known, found[new], names[new])
            pieces = [raw[a:b] for a, b in zip(starts[place].tolist(), ends[place].tolist(), strict=True)]
            for part in (self._joined(pieces[:many]), self._one_by_one(pieces[many:])):
                self.ids.add(*part)
            lengths = (ends - starts)[place]
            self.bytes.add(buf[gather(starts[place], lengths)], lengths)
        at = self.place[np.searchsorted(self.known, names)][back]
        if np.array_equal(self.bytes.all(at)[0], buf):
            ids, lengths = self.ids.all(at)
        else:  # different chunks of one hash
            ids, lengths = self._one_by_one([buf[a:b].tobytes() for a, b in zip(starts, ends, strict=True)])
            self.forget()
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, total[np.searchsorted(starts, offs)]


class _Lists:
    """Lists of numbers, one after the other."""

    def __init__(self, kind: type):
        self.flat, self.starts, self.lengths = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.starts[-1] + self.lengths[-1]) if len(self.starts) else 0
        self.starts = np.concatenate([self.starts, used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        if used + len(flat) > len(self.flat):  # grown by half at least, so that adding stays cheap
            self.flat = np.concatenate([self.flat[:used], np.zeros(max(len(flat), used // 2), self.flat.dtype)])
        self.flat[used : used + len(flat)] = flat

    def all(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists ``at``, one after the other, and their lengths."""
        lengths = self.lengths[at]
        return self.flat[gather(self.starts[at], lengths)], lengths


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_SCHEMA = "shard int, block int, docs array<{}>, lengths array<int>, first long, ranks binary, control binary, data binary"


def write(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None, end: int = END) -> None:
    """Writes the blocks of all texts below ``path``."""
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        own, shard, block, first = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        docs: list = []
        parts: list[np.ndarray] = []
        lengths: list[int] = []
        held = 0

        def full() -> pa.RecordBatch:
            table, ranks = by_frequency(np.concatenate(parts))
            control, data = pack(ranks)
            row = {"shard": [shard], "block": [block], "docs": [docs], "lengths": [lengths], "first": [first], "ranks": [table.tobytes()], "control": [control], "data": [data]}
            types = [pa.int32(), pa.int32(), pa.list_(id_type), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types, strict=True)], names=list(row))

        for batch in batches:
            id_type, ids_of = batch.schema.types[0], batch.column(0).to_pylist()
            buf, offs = utf8(batch.column(1))
            for a, b in blocks(offs, ENCODED):
                ids, bounds = own.encode(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                with_end = np.insert(ids, bounds[1:], end)
                size = np.diff(bounds) + 1
                docs += ids_of[a:b]
                lengths += size.tolist()
                parts.append(with_end)
                held += len(with_end)
                if held >= BLOCK_IDS:
                    yield full()
                    block, first = block + 1, first + held
                    docs, parts, lengths, held = [], [], [], 0
        if docs:
            yield full()

    rows = df.select(id_col, text).repartitionByRange(id_col).sortWithinPartitions(id_col, F.xxhash64(text))
    map_arrow(rows, run, _SCHEMA.format(kind)).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """For each document of the files, in no order: its id, ``start`` (ids of all documents before it) and ``ids``."""
    return _decoded(spark, path, id_col, "ids array<int>", lambda ids: [x.astype(np.int32) for x in ids])


def digest(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """As ``read``, but n_tokens and the CRC-32 of the ids (as little-endian unsigned 32-bit integers) in their place."""
    return _decoded(spark, path, id_col, "ids_crc32 long", lambda ids: [zlib.crc32(x.astype("<u4").tobytes()) for x in ids])


def _decoded(spark: SparkSession, path: str, id_col: str, last: str, made) -> DataFrame:
    blocks = spark.read.parquet(path)
    # one row for each shard, of which there are as many as the writing job had partitions
    sizes = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)).alias("size")).orderBy("shard").collect()
    before = dict(zip([r["shard"] for r in sizes], np.cumsum([0] + [r["size"] for r in sizes])[:-1].tolist(), strict=True))
    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    name, typed = last.split(" ")
    out_type = pa.list_(pa.int32()) if typed.startswith("array") else pa.int64()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                shard, _, docs, lengths, first, ranks, control, data = (c[k] for c in batch.columns)
                size = np.array(lengths.as_py(), np.int64)
                ids = np.frombuffer(ranks.as_py(), "<u4")[unpack(control.as_py(), data.as_py(), int(size.sum()))]
                ends = np.cumsum(size)
                start = before[shard.as_py()] + first.as_py() + ends - size
                yield pa.RecordBatch.from_arrays([pa.array(docs.as_py(), docs.type.value_type), pa.array(start), pa.array(size), pa.array(made(np.split(ids, ends[:-1])), out_type)], names=[id_col, "start", "n_tokens", name])

    return map_arrow(blocks, run, f"`{id_col}` {kind}, start long, n_tokens long, {last}")


def through_files(df: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Writes the texts' ids to the shared folder, reads them back and returns their digests."""
    path = f"{shared_dir(df.sparkSession)}/confluo/tokens-{uuid.uuid4().hex}"
    write(df, path, id_col, text, tokenizer, end)
    return digest(df.sparkSession, path, id_col)
