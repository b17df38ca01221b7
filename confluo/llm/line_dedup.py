"""Fuzzy line deduplication.

Every line with a character that isn't white space (A-Z lower-cased) takes part; its 128-bit hash of all bytes names it, so
exact copies of any length are one line. Lines of more than ``SIZE`` characters also become sets of ``SIZE``-character
shingles. Circulant MinHash of 60 coordinates in 20 bands of 3 gives candidates: a pair of similarity 0.8 misses all bands
with a chance of 6e-7, one of 0.85 with 5e-9, and shingles of 9 characters are so rarely shared by chance that unlike lines
hardly meet in three coordinates (shorter ones, or two coordinates, tie a tenth of all lines and more into one group by
chance). Of each component of exact links the first line stays, by document id, then place in the text; the others are
removed with their line breaks.

Lines that share a band are linked through one of them: each task ties what it holds itself and sends on one line for each
band key, so a key shared by a third of all lines is a row for each task. Those rows, 8 bytes of key and 8 of name, are the
only thing that grows with lines times bands; they are shuffled once, and tied range by range.
Exact Jaccard verification on the full sets within the groups and the distributed union-find are those of the document operator.

The names of all lines go the same way, 16 bytes for each: that finds the copies. Rows leave a task sorted and packed by
range of keys, so that the shuffle has a row for each range.

Lines of ``MANY`` different shingles and more get their coordinates from bins, one for each shingle (one permutation hashing,
empty bins borrow from others), which misses no more than 60 coordinates of each do and costs a fraction.

Two more passes over the texts, which only hash whole lines, fetch the candidate lines and the places of lines that have
copies or links; a bitmap of fixed size keeps other lines out of their shuffles. It only saves work: a false positive
costs a row, and no line is missed.

A null or empty text has no lines to remove. Rows that repeat an id and a text share a fate. ``drop_lines`` drops
a row that loses lines and keeps only blank ones, since all it held stands elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .minhash import band_keys, table
from .near_dedup import dealt, exact_links
from .shared import bitmap, in_bitmap, map_arrow, spent, written
from .textbuf import LOWER, SPACE, U, blocks, distinct, gather, mix, powers, scattered, utf8, with_key

SIZE = 9
BANDS, ROWS = 20, 3
#: Places of the ring: many times the shingles of all but the longest lines (a crowded ring makes unlike lines alike), in a
#: table that stays in a processor's cache.
RING = 1 << 18
FILTER_BITS = 24
#: Band keys that a task holds, and shingles that it takes, at once.
HELD, AT_ONCE = 1 << 18, 1 << 12
#: Lines of so many different shingles get their coordinates from bins, one for each shingle. So do lines that are shorter by
#: no more than the similarity sought, besides their own: no linked pair is without a kind of bands that both have.
MANY = 64
#: Bins, bits of a hash that are sorted with the number of its line, and shingles that are sorted at once.
BIN_BITS, HASH_BITS, SORTED = 6, 44, 1 << 18
BINS, NONE = 1 << BIN_BITS, U(2**64 - 1)
#: Ranges of band keys that are shuffled and sorted as a whole.
PARTS_BITS = 12
#: The number of the first range of lines' names, which are shuffled with them.
COPIES = 1 << 16


class Lines:
    """The lines of a block of texts that aren't blank: texts they belong to, numbers in them, names, and shingles."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        # a line break after each text parts the texts; breaks within them part their lines
        n = len(offs) - 1
        last = offs[1:] + np.arange(n)
        own = np.ones(len(buf) + n, bool)
        own[last] = False
        raw = np.full(len(buf) + n, 10, np.uint8)
        raw[own] = LOWER[buf]
        ends = np.flatnonzero(raw == 10)
        starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
        row = np.searchsorted(last, ends, "left")
        number = np.arange(len(ends)) - np.searchsorted(row, row, "left")
        inked = ~SPACE[raw[starts]]  # a line break is white space, too
        rest = np.flatnonzero(~inked & (ends > starts))
        if len(rest):
            size = ends[rest] - starts[rest]
            inked[rest] = np.logical_or.reduceat(~SPACE[raw[gather(starts[rest], size)]], np.cumsum(size) - size)
        own = np.flatnonzero(inked)
        self.raw, self.starts, self.ends, self.row, self.number = raw, starts[own], ends[own], row[own], number[own]
        #: Places of bytes that don't begin a character.
        self.inner = np.flatnonzero((raw & 0xC0) == 0x80) if raw.max(initial=0) > 127 else np.zeros(0, np.int64)
        self.size = self.head(self.ends) - self.head(self.starts)
        self.count = np.maximum(self.size - SIZE + 1, 1)
        self.pieces = scattered(raw, self.starts, self.ends)
        self.name = with_key(*self.pieces).view(np.int64)

    def head(self, at: np.ndarray) -> np.ndarray:
        """How many characters begin before some bytes."""
        return at - np.searchsorted(self.inner, at) if len(self.inner) else at

    def more(self, rows: np.ndarray) -> np.ndarray:
        """Another 64 bits of some lines' hash."""
        size, sums = self.pieces
        return with_key(size[rows], sums[rows], 1).view(np.int64)

    def shingles(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of some lines' shingles (``rows`` ascend), one line after the other, and where each line's begin."""
        points = self.raw
        if len(self.inner):
            points = np.frombuffer(self.raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        weight, inverse = powers(len(points))
        sums = np.zeros(len(points) + 1, U)
        weighed = np.add(points, U(1), dtype=U)
        weighed *= weight
        np.cumsum(weighed, out=sums[1:])
        starts, ends, count = self.head(self.starts[rows]), self.head(self.ends[rows]), self.count[rows]
        hashes = np.zeros(len(points), U)
        np.subtract(sums[SIZE:], sums[:-SIZE], out=hashes[: max(len(points) - SIZE + 1, 0)])
        short = starts[ends - starts < SIZE]
        hashes[short] = sums[ends[ends - starts < SIZE]] - sums[short]
        hashes *= inverse
        own = np.zeros(len(points) + 1, np.int8)
        own[starts], own[starts + count] = 1, -1
        return mix(hashes[np.cumsum(own[:-1], dtype=np.int8).view(bool)]), np.cumsum(count) - count

    def bands(self, rows: np.ndarray) -> np.ndarray:
        """Some lines' band keys, lines x bands, by circulant MinHash."""
        return _circulant(*self.shingles(rows))

    def keys(self, rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """The (key, name) rows of some lines: those of the shorter ones by circulant MinHash, of the longer ones by bins."""
        hashes, first = self.shingles(rows)
        n, names = self.count[rows], self.name[rows]
        size, least = _binned(hashes, n, MANY * percent // 100)
        few, many = size < MANY, size * 100 >= MANY * percent
        keys = [_circulant(hashes[np.repeat(few, n)], np.cumsum(n[few]) - n[few]), band_keys(_filled(least[many]), BANDS, ROWS)]
        return np.concatenate([x.ravel() for x in keys]), np.repeat(np.concatenate([names[few], names[many]]), BANDS)

    def text(self, k: int) -> bytes:
        return self.raw[self.starts[k] : self.ends[k]].tobytes()


def _circulant(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    places = ((hashes >> U(20)) & U(RING - 1)).astype(np.int64)
    out, a = np.empty((len(first), BANDS * ROWS), np.uint32), 0
    view, stop = np.lib.stride_tricks.sliding_window_view(table(BANDS * ROWS, RING), BANDS * ROWS), np.append(first[1:], len(places))
    while a < len(first):  # so many shingles at a time that their coordinates stay in a processor's cache
        b = max(a + 1, int(np.searchsorted(first, first[a] + AT_ONCE)))
        out[a:b] = np.minimum.reduceat(view[places[first[a] : stop[b - 1]]], first[a:b] - first[a], axis=0)
        a = b
    return band_keys(out, BANDS, ROWS)


def _binned(hashes: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each line the number of different shingles, and the least of each of ``BINS`` equal ranges of hashes (NONE if it
    has none there). Lines of fewer than ``most`` shingles in all count as they are, and get none."""
    size, least = count.copy(), np.full((len(count), BINS), NONE, U)
    some = np.flatnonzero(count >= most)
    hashes = hashes[np.repeat(count >= most, count)] >> U(64 - HASH_BITS)
    ends, a = np.cumsum(count[some]), 0
    while a < len(some):  # so many at a time that they stay in a processor's cache, and that a line's number has its bits
        done = int(ends[a] - count[some[a]])
        b = max(a + 1, int(np.searchsorted(ends, done + SORTED, "right")))
        own, n = some[a:b], count[some[a:b]]
        x = np.repeat(np.arange(b - a, dtype=U) << U(HASH_BITS), n)
        x |= hashes[done : ends[b - 1]]
        x.sort()
        new = np.ones(len(x), bool)
        np.not_equal(x[1:], x[:-1], out=new[1:])
        size[own] = np.add.reduceat(new, np.cumsum(n) - n, dtype=np.int64)
        bins = x >> U(HASH_BITS - BIN_BITS)
        np.not_equal(bins[1:], bins[:-1], out=new[1:])
        at = np.flatnonzero(new)
        part = np.full((b - a) * BINS, NONE, U)
        part[bins[at].astype(np.int64)] = x[at] & U((1 << HASH_BITS) - 1)
        least[own] = part.reshape(-1, BINS)
        a = b
    return size, least


def _orders() -> np.ndarray:
    """For each band the bins that an empty one of it borrows from, in turn, as distances: those of the band itself come last,
    and the band's bins try three different ones at a time."""
    rng, near = np.random.default_rng(21), [1, BINS - 1, 2, BINS - 2]
    far = np.setdiff1d(np.arange(1, BINS), near)
    return np.stack([np.concatenate([rng.permutation(far), near]) for _ in range(BANDS)])


ORDERS = _orders()


def _filled(least: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` coordinates of lines from the least hash of each bin. An empty bin borrows that of another, so that two
    lines agree in it with the chance of their similarity, as in the others."""
    out = least[:, : BANDS * ROWS].copy()
    line, bin_ = np.nonzero(out == NONE)
    for k in range(BINS - 1):
        if not len(line):
            break
        got = least[line, (bin_ + ORDERS[bin_ // ROWS, k]) % BINS]
        out[line, bin_] = got
        line, bin_ = line[got == NONE], bin_[got == NONE]
    return out


def line_sets(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The shingle set of each row's single line."""
    out: list[np.ndarray] = []
    for a, b in blocks(offs):
        lines = Lines(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
        hashes, first = lines.shingles(np.arange(len(lines.row)))
        sets = dict(zip(lines.row.tolist(), np.split(hashes, first[1:]), strict=True)) if len(first) else {}
        out += [distinct(sets[i]) if i in sets else np.zeros(0, U) for i in range(b - a)]
    return out


def tied(keys: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, name) rows that tie together what the given ones do: one row for each key, and for each other line of a key two
    rows under a key that only it and the key's first line have."""
    order = np.argsort(keys)
    keys, names = keys[order], names[order]
    first, head = heads(keys, names)
    other = head != names
    if not other.any():
        return keys[first], names[first]
    head_, names_ = head[other], names[other]
    order = np.lexsort((names_, head_))
    head_, names_ = head_[order], names_[order]
    once = np.concatenate([[True], (head_[1:] != head_[:-1]) | (names_[1:] != names_[:-1])])
    head_, names_ = head_[once], names_[once]
    own = mix(mix(head_.view(U) + U(0x632BE59BD9B4E019)) ^ names_.view(U)).view(np.int64)
    return np.concatenate([keys[first], own, own]), np.concatenate([head[first], head_, names_])


def heads(keys: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of the sorted keys begins, and for each row the least name of its key."""
    if not len(keys):
        return np.zeros(0, np.int64), names
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    first = np.flatnonzero(new)
    return first, np.minimum.reduceat(names, first)[np.cumsum(new) - 1]


def _linked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that tie the lines of each key, from keys and names in turn."""
    order = np.argsort(rows[::2])
    keys, names = rows[::2][order], rows[1::2][order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[1:] == keys[:-1]
    some = same[1:] | same[:-1]  # most keys are those of one line
    _, head = heads(keys[some], names[some])
    names = names[some]
    other = head != names
    return names[other], head[other]


def _distinct(own: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of two hashes, and which of them are there more than once."""
    order = np.argsort(own)
    own, more = own[order], more[order]
    same = np.zeros(len(own) + 1, bool)
    same[1:-1] = own[1:] == own[:-1]
    some = np.flatnonzero(same[1:] | same[:-1])  # most lines are there once
    order = some[np.lexsort((more[some], own[some]))]
    own[some], more[some] = own[order], more[order]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (more[1:] != more[:-1])])) if len(own) else some
    return own[first], more[first], np.diff(first, append=len(own)) > 1


def _twice(own: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs, those that are there more than once twice."""
    own, more, many = _distinct(own, more)
    return np.concatenate([own, own[many]]), np.concatenate([more, more[many]])


def _runs(parts: np.ndarray) -> list[tuple[int, int, int]]:
    """(part, first row, row after the last) of each run of a part."""
    bounds = np.flatnonzero(np.diff(parts, prepend=-1 - (1 << 30), append=1 << 30)).tolist()
    return [(int(parts[a]), a, b) for a, b in zip(bounds, bounds[1:], strict=False)]


def packed(keys: np.ndarray, names: np.ndarray, bits: int = PARTS_BITS, first_part: int = 0) -> pa.RecordBatch:
    """(part, rows): the rows of each of 2**bits ranges of keys, as bytes; ``first_part`` is that of the keys from 0 on."""
    if (keys[1:] < keys[:-1]).any():
        order = np.argsort(keys)
        keys, names = keys[order], names[order]
    part = (keys >> (64 - bits)).astype(np.int32) + np.int32(first_part)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    offsets = np.append(first, len(part)).astype(np.int32) * 16
    rows = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.column_stack([keys, names]))])
    return pa.RecordBatch.from_arrays([pa.array(part[first]), rows], names=["part", "rows"])


def _met(df: DataFrame, text: str, percent: int) -> DataFrame:
    """Rows (copies, a, b): edges that tie all lines that share a band, and if ``copies`` the two hashes of the lines that
    occur more than once."""

    def sent(held):
        keys, names, own, more = map(np.concatenate, zip(*held, strict=True))
        if len(keys):
            yield packed(*tied(keys, names))
        if len(own):
            yield packed(*_twice(own, more), PARTS_BITS - 4, COPIES)

    def keyed(batches):
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            buf, offs = utf8(batch.column(0))
            for a, b in blocks(offs):
                lines = Lines(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                long = np.flatnonzero(lines.size > SIZE)
                rows = long[np.sort(np.unique(lines.name[long], return_index=True)[1])]
                held.append((*lines.keys(rows, percent), lines.name, lines.more(np.arange(len(lines.name)))))
                if sum(len(x[0]) + len(x[2]) for x in held) > HELD:
                    yield from sent(held)
                    held = []
        if held:
            yield from sent(held)

    def meet(part: int, rows: np.ndarray) -> pa.RecordBatch:
        copies = part >= COPIES // 2
        if copies:
            own, more, many = _distinct(rows[::2], rows[1::2])
            a, b = own[many], more[many]
        else:
            a, b = _linked(rows)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), copies)), pa.array(a), pa.array(b)], names=["copies", "a", "b"])

    def edges(batches):
        part, held = None, []
        for batch in batches:
            parts, (_, offsets, data) = batch.column(0).to_numpy(), batch.column(1).buffers()
            offsets = np.frombuffer(offsets, np.int32)[batch.column(1).offset :][: len(parts) + 1]
            for own, a, b in _runs(parts):
                if own != part and held:
                    yield meet(part, np.concatenate(held))
                    held = []
                part = own
                held.append(np.frombuffer(data, np.int64, (offsets[b] - offsets[a]) // 8, offsets[a]).copy())
        if held:
            yield meet(part, np.concatenate(held))

    rows = map_arrow(df.select(text), keyed, "part int, rows binary").repartition("part").sortWithinPartitions("part")
    return map_arrow(rows, edges, "copies boolean, a long, b long")


def _places(df: DataFrame, id_col: str, text: str, wanted: np.ndarray) -> DataFrame:
    """(id, the text's hash, line number, name, more) of the lines whose name may be wanted."""

    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(2))
            for a, b in blocks(offs):
                lines = Lines(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                some = np.flatnonzero(in_bitmap(wanted, lines.name))
                rows = pa.array(a + lines.row[some])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(lines.number[some], pa.int32()), pa.array(lines.name[some]), pa.array(lines.more(some))], names=["id", "hash", "line", "name", "more"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(id_col, F.xxhash64(text), text), run, f"id {kind}, hash long, line int, name long, more long")


def _texts(df: DataFrame, text: str, names: DataFrame) -> DataFrame:
    """(name, more, n, text) of the lines that are nodes of ``names``, and of a few others; n is how many shingles one has."""
    wanted = bitmap(names, "node", FILTER_BITS)

    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(0))
            for a, b in blocks(offs):
                lines = Lines(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                _, some = np.unique(lines.name, return_index=True)
                some = some[in_bitmap(wanted, lines.name[some])]
                yield pa.RecordBatch.from_arrays([pa.array(lines.name[some]), pa.array(lines.more(some)), pa.array(lines.count[some], pa.int64()), pa.array([lines.text(k) for k in some], pa.binary()).cast(pa.string())], names=["name", "more", "n", "text"])

    rows = map_arrow(df.select(text), run, "name long, more long, n long, text string")
    return rows.groupBy("name").agg(F.any_value(F.struct("more", "n", "text")).alias("line")).select("name", "line.*")


def removals(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """(id, hash, lines): for each document that loses lines their numbers."""
    met = written(_met(df, text, percent), "met")
    groups = written(connected_components(met.filter(~F.col("copies")).select("a", "b")), "groups")
    texts = written(_texts(df, text, groups), "texts")
    nodes = groups.join(texts.select("name", "n"), F.col("node") == F.col("name")).select(F.col("component").alias("group"), F.col("name").alias("set"), "n")
    nodes = written(dealt(nodes), "nodes")
    links = exact_links(texts.select("name", "text").join(nodes.select("units", "group", "set"), F.col("name") == F.col("set")), line_sets, percent)
    # a line without links is a class by its full hash, linked ones by their component; lines alone need no more
    linked = connected_components(links).join(texts.select("name", "more"), F.col("node") == F.col("name")).select("name", "more", "component")
    copies = met.filter("copies").select(F.col("a").alias("name"), F.col("b").alias("more"))
    linked = copies.join(linked, ["name", "more"], "full")
    classes = written(linked.select("name", "more", F.coalesce("component", "name").alias("c"), F.when(F.col("component").isNull(), F.col("more")).alias("d")), "classes")
    spent(nodes, met, groups, texts)
    places = _places(df, id_col, text, bitmap(classes, "name", FILTER_BITS)).join(classes, ["name", "more"]).select("id", "hash", "line", "c", "d")
    places, place = written(places, "places"), F.struct("id", "hash", "line")
    spent(classes)
    first = places.groupBy("c", "d").agg(F.min(place).alias("first"))
    marked = places.join(first.select(F.col("c").alias("e"), F.col("d").alias("f"), "first"), (F.col("c") == F.col("e")) & F.col("d").eqNullSafe(F.col("f")))
    return marked.filter(place != F.col("first")).groupBy("id", "hash").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def report(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """For each row: its id, n_lines (all of them; a null or empty text has one empty line), n_removed, and the numbers
    (from 0) of the removed lines, joined by commas."""
    every = df.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__hash"), F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).cast("long").alias("n_lines"))
    out = every.join(removals(df, id_col, text, percent), F.col("__id").eqNullSafe(F.col("id")) & (F.col("__hash") == F.col("hash")), "left")
    return out.select(F.col("__id").alias(id_col), "n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("lines", ","), F.lit("")).alias("removed"))


def drop_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``df`` with the removed lines cut from the text, all other columns as they were. Rows that lose
    lines and keep only blank ones go; other texts that lose none stay byte for byte."""
    gone = removals(df, id_col, text, percent).select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), F.col("lines").alias("__lines"))
    gone = written(gone, "removed")
    kept = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("__lines", i))
    out = df.join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left").withColumn("__kept", F.when(F.col("__lines").isNotNull(), kept))
    out = out.filter(F.col("__kept").isNull() | F.exists("__kept", lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return out.select(*[F.when(F.col("__kept").isNull(), F.col(f"`{c}`")).otherwise(F.array_join("__kept", "\n")).alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])
