"""SimHash near-deduplication over pivot distance tables.

A document's fingerprint has 64 bits; bit i is set if it is set in over half the XXH64 hashes of the document's word
shingles, repeats included. Fingerprints with at most ``bits`` differing bits are linked, and a component's name is the
smallest id in it. Equal fingerprints fall together first, so copies cost one.

Each different fingerprint gets its Hamming distances to ``REFERENCES``, the 64 rows of a Hadamard matrix, once, in a
written table. Two fingerprints that differ in D bits have distances whose differences, squared, add up to 64 * D; so the
largest is at least the root of D, and no pair with more than ``bits`` squared differing bits passes the table. What
passes is verified on the fingerprints.

Pairs are looked for in buckets, never across the table: the bits are cut into ``bits`` + 2 chunks, two of which any linked
pair holds in common, and each two chunks' bits make a bucket. A bucket of more than ``MOST`` fingerprints isn't compared
but dealt again by two of the chunks of the bits it leaves free, until at most 12 are free; there are no more than ``MOST``
different fingerprints then. So no group grows with the corpus and no link is lost. Copies of a document, however many,
are one fingerprint in all this.

A null or empty text, or one without words, has the fingerprint zero and is linked like any other; fewer words than a
shingle's are one shingle. Rows that repeat an id are rows of their own; null ids count as largest. Columns other than id and text are ignored.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import map_arrow, ship, written
from .textbuf import LOWER, U, blocks, utf8

SEED = 42
#: Members of a bucket that are compared, and members that a task takes at once.
MOST, UNIT = 1 << 12, 1 << 17
#: Reference p has bit i set if p and i share an odd number of bits.
REFERENCES = np.array([sum((p & i).bit_count() % 2 << i for i in range(64)) for p in range(64)], U)


def fingerprint(text: bytes, size: int) -> int:
    """Of a text whose capitals A-Z are small letters already."""
    words = text.split()
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(size, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    ends, own, held = ends[width - 1 :].tolist(), xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), 1 << 14):
        hashes = np.array([own(joined[s:e], SEED) for s, e in zip(starts[k : k + (1 << 14)], ends[k : k + (1 << 14)], strict=True)], "<u8")
        held += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * held > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """(id, fp) of each row; the fingerprint as a signed number."""

    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(1))
            out = []
            for a, b in blocks(offs):
                low = LOWER[buf[offs[a] : offs[b]]].tobytes()
                out += [fingerprint(low[offs[k] - offs[a] : offs[k + 1] - offs[a]], size) for k in range(a, b)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(out, U).view(np.int64))], names=["id", "fp"])

    return map_arrow(df.select(id_col, text), run, f"id {df.schema[id_col].dataType.simpleString()}, fp long")


def distances(fps: np.ndarray) -> np.ndarray:
    """n x 64 Hamming distances to the references."""
    return np.bitwise_count(fps.view(U)[:, None] ^ REFERENCES[None, :])


def _tabled(fps: DataFrame) -> DataFrame:
    """``fps`` (fp) with the ``distances``, as 64 bytes."""

    def run(batches):
        for batch in batches:
            own = distances(batch.column(0).to_numpy())
            ends = pa.array(np.arange(len(own) + 1, dtype=np.int32) * 64).buffers()[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.Array.from_buffers(pa.binary(), len(own), [None, ends, pa.py_buffer(own.tobytes())])], names=["fp", "distances"])

    return map_arrow(fps.select("fp"), run, "fp long, distances binary")


@cache
def masks(path: int, bits: int) -> list[int]:
    """The bits that each of the buckets below ``path`` holds equal: those of the path, and of two chunks of the others."""
    held, free = 0, list(range(64))
    if path:
        held = masks(path // 256, bits)[path % 256 - 1]
        free = [i for i in free if not held >> i & 1]
    chunks = [sum(1 << int(i) for i in c) for c in np.array_split(free, bits + 2)]
    return [held | a | b for a, b in combinations(chunks, 2)]


def _dealt(rows: DataFrame, bits: int) -> DataFrame:
    """(path, key, fp): the buckets below each row's ``path``; a path is the list of the chosen masks, as base-256 digits."""

    def run(batches):
        for batch in batches:
            paths, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for path in np.unique(paths).tolist():
                own = fps[paths == path]
                for k, mask in enumerate(masks(path, bits)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), path * 256 + k + 1)), pa.array(own & np.array(mask, U).view(np.int64)), pa.array(own)], names=["path", "key", "fp"])

    return map_arrow(rows.select("path", "fp"), run, "path long, key long, fp long")


def near(fps: np.ndarray, run: np.ndarray, table: np.ndarray, bits: int, seen: list[int] | None = None) -> list[tuple[int, int]]:
    """Row pairs that link all that is linked within the runs (rows of one bucket, which stand together and ascend in
    the table's first column there). ``seen`` gets the pairs met, those past the table, and the links among them."""
    _, node = np.unique(fps, return_inverse=True)
    root, out = np.arange(len(fps)), []
    i, step = np.arange(len(fps)), 0
    first = table[:, 0].astype(np.int16)
    while len(i):
        step += 1
        i = i[i + step < len(fps)]
        j = i + step
        i = i[(run[i] == run[j]) & (first[j] - first[i] <= bits)]
        a, b = i, i + step
        apart = root[node[a]] != root[node[b]]
        a, b = a[apart], b[apart]
        met = len(a)
        for k in range(0, 64, 8):
            ok = (np.abs(table[a, k : k + 8].astype(np.int16) - table[b, k : k + 8]) <= bits).all(axis=1)
            a, b = a[ok], b[ok]
        links = np.bitwise_count(fps[a] ^ fps[b]) <= bits
        if seen is not None:
            seen[:] = [x + y for x, y in zip(seen, (met, len(a), int(links.sum())), strict=True)]
        for x, y in zip(a[links].tolist(), b[links].tolist(), strict=True):
            p, q = node[x], node[y]
            while root[p] != p:
                p = root[p]
            while root[q] != q:
                q = root[q]
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((x, y))
        while links.any() and (root[root] != root).any():
            root = root[root]
    return out


def _compared(members: DataFrame, table: DataFrame, bits: int) -> DataFrame:
    """Edges (a, b) among the members of each (path, key)."""
    units = 1 + members.count() // UNIT

    def run(rows: pa.Table) -> pa.Table:
        keys, paths, fps = (rows[c].to_numpy() for c in ("key", "path", "fp"))
        own = utf8(rows["distances"])[0].reshape(-1, 64)
        order = np.lexsort((own[:, 0], keys, paths))
        keys, paths, fps = keys[order], paths[order], fps[order].view(U)
        runs = np.cumsum(np.concatenate([[False], (keys[1:] != keys[:-1]) | (paths[1:] != paths[:-1])]))
        pairs = np.array(near(fps, runs, own[order], bits), np.int64).reshape(-1, 2)
        return pa.table({"a": fps[pairs[:, 0]].view(np.int64), "b": fps[pairs[:, 1]].view(np.int64)})

    ship(members.sparkSession)
    dealt = members.withColumn("unit", F.pmod(F.xxhash64("path", "key"), F.lit(units))).select("unit", "path", "key", "fp")
    return dealt.join(table, "fp").groupBy("unit").applyInArrow(run, "a long, b long")


def linked(fps: DataFrame, bits: int = 4) -> DataFrame:
    """Edges (a, b) whose components are those of all links between the different fingerprints ``fps`` (fp)."""
    table = written(_tabled(fps), "distances")
    rows, edges = _dealt(table.select(F.lit(0).cast("long").alias("path"), "fp"), bits), None
    while True:
        rows = written(rows, "buckets")
        shared = rows.groupBy("path", "key").agg(F.count("*").alias("held")).filter(F.col("held") > 1)
        members = written(rows.join(shared, ["path", "key"]), "members")
        found = written(_compared(members.filter(F.col("held") <= MOST), table, bits), "links")
        edges = found if edges is None else edges.unionByName(found)
        large = members.filter(F.col("held") > MOST)
        if large.isEmpty():
            return edges
        rows = _dealt(large, bits)


def components(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4, bits: int = 4) -> DataFrame:
    """For each row: its id, fingerprint (16 lowercase hex digits) and component_id, the smallest id reachable."""
    rows = written(fingerprints(df, id_col, text, size), "fingerprints")
    sets = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "sets")
    found = connected_components(linked(sets, bits)).withColumnRenamed("node", "fp")
    label = sets.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = label.groupBy("component").agg(F.min("least").alias("component_id"))
    label = label.select("fp", "component").join(least, "component").select("fp", "component_id")
    return rows.join(label, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
