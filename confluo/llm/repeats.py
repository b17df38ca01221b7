"""Suffix-array deduplication: cuts every byte that a repeated string of ``SPAN`` bytes covers.

A *window* is a string of SPAN bytes within one text. Each window is named for the least hash among its strings of
``GRAM`` bytes, which depends on nothing but its content, so equal windows have equal names wherever they stand.
Consecutive windows named for the same place form a *run*; each window lies in exactly one, equal windows in different ones.

1. One pass counts the runs of each name, with the least and greatest hash of their bytes.
2. A second pass keeps the runs whose name occurs twice (a bitmap of fixed size keeps most others out), and takes the
   bytes of a run along where runs of one name differ. A name that occurs once can't hold a repeated window.
3. Equal runs are counted together, before any shuffle. A run that occurs twice is repeated as a whole.
4. The different runs of all names are dealt to shards by name, so that equal windows meet in one shard. A shard's
   suffix array (induced sorting) and permuted common prefixes show which windows also start elsewhere in it.
   A *hot* name, whose runs are more than a shard (a passage that many texts hold between other neighbours),
   is never dealt: its windows are counted by a 128-bit hash of all their bytes, before and after a shuffle that spreads
   them evenly, and those that recur go back to their runs.
5. Verdicts go back to the runs' places, and each text is cut once, judged on the input.

Work is in proportion to the bytes; a group of copies costs one run for each name, however many members it has. A null
or empty text, or one shorter than SPAN, loses nothing. Rows that repeat an id and a text are different places, so all
windows of such a text are repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bitmap, in_bitmap, map_arrow, ship, written
from .suffixes import common_prefixes, suffix_array
from .textbuf import BLOCK, U, blocks, gather, keyed_hashes, mix, powers, prefix, utf8

SPAN, GRAM = 200, 40
#: Bytes of a shard.
SHARD = 3 << 19
FILTER_BITS = 26


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    out, have = hashes, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(buf: np.ndarray, offs: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, start (in the row), windows, name and hash of the runs of a block of texts."""
    n = len(buf)
    if n < span:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    sums, inverse = prefix(buf), powers(n)[1]
    hashes = (sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1]
    hashes = mix(hashes)
    name = _least(hashes, span - gram + 1)
    row = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    inside = row[: n - span + 1] == row[span - 1 :]
    new = inside.copy()
    # a window that begins with its least string ends a run, so the place of the first least string is one for each run,
    # and equal windows are always in different runs
    new[1:] &= (name[1:] != name[:-1]) | (hashes[: len(name) - 1] == name[:-1]) | ~inside[:-1] | (row[1 : n - span + 1] != row[: n - span])
    starts = np.flatnonzero(new)
    stops = np.flatnonzero(inside & np.concatenate([(new | ~inside)[1:], [True]])) + 1
    count = stops - starts
    ends = starts + count + span - 1
    whole = keyed_hashes(buf, starts, ends)
    return row[starts].astype(np.int64), starts - offs[row[starts]], count, name[starts].view(np.int64), whole.view(np.int64)


def _portions(buf: np.ndarray, offs: np.ndarray, span: int):
    """(first row, first place, bytes, offsets) of parts of a batch; a long text is dealt in parts that overlap by a window."""
    for a, b in blocks(offs):
        if b == a + 1 and offs[b] - offs[a] > 2 * BLOCK:
            for at in range(0, int(offs[b] - offs[a]) - span + 1, BLOCK):
                part = buf[offs[a] + at : min(offs[b], offs[a] + at + BLOCK + span - 1)]
                yield a, at, part, np.array([0, len(part)])
        else:
            yield a, 0, buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]


def _counted(df: DataFrame, text: str, span: int, gram: int) -> DataFrame:
    """(name, held, low, high) of all names: how many runs, and the least and greatest of their hashes."""

    def run(batches):
        for batch in batches:
            for _, _, buf, offs in _portions(*utf8(batch.column(0)), span):
                _, _, _, name, whole = runs(buf, offs, span, gram)
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(whole)], names=["name", "whole"])

    rows = map_arrow(df.select(text), run, "name long, whole long")
    return rows.groupBy("name").agg(F.count("*").alias("held"), F.min("whole").alias("low"), F.max("whole").alias("high"))


def _occurrences(df: DataFrame, id_col: str, text: str, span: int, gram: int, repeated: np.ndarray, mixed: np.ndarray) -> DataFrame:
    """The runs whose name may be repeated; with their bytes, once in a portion, where the name may be mixed."""

    def run(batches):
        for batch in batches:
            for a, at, buf, offs in _portions(*utf8(batch.column(2)), span):
                row, start, count, name, whole = runs(buf, offs, span, gram)
                keep = in_bitmap(repeated, name)
                row, start, count, name, whole = (x[keep] for x in (row, start, count, name, whole))
                _, first = np.unique(whole, return_index=True)
                first = first[in_bitmap(mixed, name[first])]
                size = np.zeros(len(name), np.int64)
                size[first] = count[first] + span - 1
                data = buf[gather(offs[row] + start, size)].tobytes()
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                there = np.packbits(size > 0, bitorder="little").tobytes()
                bytes_ = pa.Array.from_buffers(pa.binary(), len(name), [pa.py_buffer(there), pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
                rows = pa.array(a + row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at + start), pa.array(count), pa.array(name), pa.array(whole), bytes_], names=["id", "hash", "start", "windows", "name", "whole", "bytes"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(id_col, F.xxhash64(text), text), run, f"id {kind}, hash long, start long, windows long, name long, whole long, bytes binary")


def repeated_windows(texts: list[bytes], windows: np.ndarray, span: int) -> list[np.ndarray]:
    """For each text, which of its first ``windows`` places start a string of ``span`` bytes that starts at another one, too."""
    size = np.array([len(t) for t in texts], np.int64) + 1
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)  # never in UTF-8
    order = suffix_array(np.concatenate([joined.astype(np.int64) + 1, [0]]), 257)
    previous, length = common_prefixes(np.concatenate([joined, np.zeros(1, np.uint8)]), order)
    long = np.flatnonzero(length >= span)
    hit = np.zeros(len(joined) + 1, bool)
    hit[long] = hit[previous[long]] = True
    starts = np.cumsum(size) - size
    return [hit[s : s + w] for s, w in zip(starts.tolist(), windows.tolist(), strict=True)]


def window_hashes(texts: list[bytes], windows: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Text, place and two hashes of the first ``windows`` strings of ``span`` bytes of each text."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    at = gather(np.cumsum([0] + [len(t) for t in texts])[:-1], windows)
    text = np.repeat(np.arange(len(texts)), windows)
    weight, inverse = powers(len(buf))
    out = []
    for codes in (buf.astype(U) + U(1), mix(buf.astype(U) + U(0x2545F491))):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(codes * weight[: len(buf)])])
        out.append(mix((sums[at + span] - sums[at]) * inverse[at]).view(np.int64))
    first = np.cumsum(windows) - windows
    return text, np.arange(len(at)) - np.repeat(first, windows), *out


def _hot_verdicts(each: DataFrame, span: int) -> DataFrame:
    """(name, whole, spans) as ``_verdicts`` gives them, of the runs (name, whole, held, windows, bytes) of hot names."""

    def parts(batch):
        texts, windows = batch.column("bytes").to_pylist(), np.asarray(batch.column("windows"))
        size = np.cumsum([len(t) for t in texts])
        cuts = np.unique(np.searchsorted(size, np.arange(BLOCK, size[-1] + BLOCK, BLOCK), "right")) if len(texts) else []
        for a, b in zip([0, *cuts], [*cuts, len(texts)], strict=True):
            if b > a:
                yield a, *window_hashes(texts[a:b], windows[a:b], span)

    def count(batches):
        for batch in batches:
            for _, _, _, one, two in parts(batch):
                order = np.lexsort((two, one))
                one, two = one[order], two[order]
                new = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
                yield pa.RecordBatch.from_arrays([pa.array(one[new]), pa.array(two[new]), pa.array(np.diff(np.append(new, len(one))))], names=["one", "two", "held"])

    rows = each.select("name", "whole", "windows", "bytes")
    counted = map_arrow(rows, count, "one long, two long, held long").groupBy("one", "two").agg(F.sum("held").alias("held"))
    again = written(counted.filter(F.col("held") > 1).select("one", "two"), "windows")
    wanted = bitmap(again, "one", FILTER_BITS)

    def find(batches):
        for batch in batches:
            for a, text, place, one, two in parts(batch):
                keep = in_bitmap(wanted, one)
                run = pa.array(a + text[keep])
                yield pa.RecordBatch.from_arrays([batch.column("name").take(run), batch.column("whole").take(run), pa.array(place[keep]), pa.array(one[keep]), pa.array(two[keep])], names=["name", "whole", "place", "one", "two"])

    def stretches(batches):
        for batch in batches:
            out = []
            for places in batch.column("places").to_pylist():
                p = np.sort(np.array(places, np.int64))
                edge = np.flatnonzero(np.diff(p) > 1)
                out.append([{"from": int(x), "to": int(y) + span} for x, y in zip(p[np.append(0, edge + 1)], p[np.append(edge, len(p) - 1)], strict=True)])
            kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("whole"), pa.array(out, kind)], names=["name", "whole", "spans"])

    # a run that occurs twice is repeated as a whole; it only counts here
    found = map_arrow(each.filter(F.col("held") == 1).select(rows.columns), find, "name long, whole long, place long, one long, two long")
    found = found.join(again, ["one", "two"]).groupBy("name", "whole").agg(F.collect_list("place").alias("places"))
    return map_arrow(found, stretches, "name long, whole long, spans array<struct<from:bigint,to:bigint>>")


def _verdicts(occurrences: DataFrame, span: int) -> DataFrame:
    """(name, whole, spans): for each different run with repeated windows, the covered stretches [from, to)."""
    total = occurrences.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = 1 + int(total) // SHARD
    each = occurrences.groupBy("name", "whole").agg(F.count("*").alias("held"), F.any_value("windows").alias("windows"), F.any_value("bytes", True).alias("bytes"))
    full = F.array(F.struct(F.lit(0).cast("long").alias("from"), (F.col("windows") + span - 1).alias("to")))
    whole = each.filter(F.col("held") > 1).select("name", "whole", full.alias("spans"))

    def run(table: pa.Table) -> pa.Table:
        texts, windows, held = table["bytes"].to_pylist(), np.array(table["windows"]), np.array(table["held"])
        out = []
        for hit, n in zip(repeated_windows(texts, windows, span), held.tolist(), strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            out.append([{"from": int(a), "to": int(b) + span - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)] if n == 1 else [])
        kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        rows = pa.table({"name": table["name"], "whole": table["whole"], "spans": pa.array(out, kind)})
        return rows.filter(pa.array([len(x) > 0 for x in out], pa.bool_()))

    ship(occurrences.sparkSession)
    dealt = each.filter(F.col("bytes").isNotNull())
    # copies of a run in several portions count, which only makes more names hot
    sizes = occurrences.filter(F.col("bytes").isNotNull()).groupBy("name").agg(F.sum(F.length("bytes")).alias("size"))
    hot = written(sizes.filter(F.col("size") > SHARD).select("name"), "hot")
    some = hot.limit(1).count() > 0
    own = dealt.join(hot, "name", "left_anti") if some else dealt
    part = own.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards))).groupBy("shard").applyInArrow(run, "name long, whole long, spans array<struct<from:bigint,to:bigint>>")
    out = whole.unionByName(part)
    return out.unionByName(_hot_verdicts(written(dealt.join(hot, "name", "left_semi"), "hot_runs"), span)) if some else out


def spans(df: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(id, hash, spans): for each document (id and hash of its text) that loses bytes, the stretches, by their start."""
    names = written(_counted(df, text, span, gram).filter(F.col("held") > 1).select("name", (F.col("low") != F.col("high")).alias("mixed")), "names")
    repeated, mixed = bitmap(names, "name", FILTER_BITS), bitmap(names.filter("mixed"), "name", FILTER_BITS)
    found = written(_occurrences(df, id_col, text, span, gram, repeated, mixed), "runs")
    verdicts = written(_verdicts(found, span), "verdicts")
    places = found.select("id", "hash", "start", "name", "whole").join(verdicts, ["name", "whole"]).select("id", "hash", "start", F.explode("spans").alias("s"))
    each = F.struct((F.col("start") + F.col("s.from")).alias("from"), (F.col("start") + F.col("s.to")).alias("to"))
    return places.groupBy("id", "hash").agg(F.sort_array(F.collect_set(each)).alias("spans"))


def cut(df: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """For each row: its id, n_bytes, n_removed, n_spans (maximal removed stretches), ``removed`` (those, as an array of
    [from, to) in bytes) and ``kept`` (the other bytes; a cut may part a character, so they are binary)."""
    gone = written(spans(df, id_col, text, span, gram), "spans")
    rows = df.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
    rows = rows.join(gone, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__hash") == F.col("hash")), "left").select("__id", "__text", "spans")

    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(1))
            sizes, removed, kept = np.diff(offs), [], []
            for k, found in enumerate(batch.column(2).to_pylist()):
                merged: list[list[int]] = []
                for s in found or ():
                    if merged and s["from"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["to"])
                    else:
                        merged.append([s["from"], s["to"]])
                own, at, parts = buf[offs[k] : offs[k + 1]], 0, []
                for x, y in merged:
                    parts.append(own[at:x])
                    at = y
                kept.append(np.concatenate([*parts, own[at:]]).tobytes())
                removed.append([{"from": x, "to": y} for x, y in merged])
            n = [sum(s["to"] - s["from"] for s in r) for r in removed]
            kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(n, pa.int64()), pa.array([len(r) for r in removed], pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "n_removed", "n_spans", "removed", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(rows, run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, removed array<struct<from:bigint,to:bigint>>, kept binary")
