"""MinHash near-deduplication of documents.

Documents become sets of word shingles; equal sets fall together first, so copies cost one set. Circulant MinHash gives
128 coordinates, in 32 bands of 4. Sets that share a bucket are candidates:

* a bucket of at most ``FEW`` sets gives its pairs, and a pair that meets in two buckets or more is a candidate edge (at
  similarity 0.8 all but about one pair in a million does);
* a larger bucket ties all its sets to its smallest one: no pairs are emitted, however many sets it has.

The components of these edges are groups that hold every link. Each group's texts meet once, in blocks of bounded size
(a large group is dealt out as pairs of blocks), and all links within are found exactly from the full sets. What leaves
a block is a spanning forest of its links; the components of those are the answer.

A null or empty text, or one without words, has no shingles and is linked with nothing. Rows with equal texts are always
linked, rows that repeat an id are rows of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, forest
from .minhash import band_keys, grouped_links, links, signature
from .shared import map_arrow, ship, written
from .textbuf import LOWER, SPACE, blocks, keyed_hashes, shingles, spans, utf8

BANDS, ROWS = 32, 4
FEW = 16
#: Bounds of a block: texts, and elements of their sets.
BLOCK_TEXTS, BLOCK_ELEMENTS = 1024, 1 << 20
#: Groups of at most so many texts are compared many at a time, elements at once so that they stay in a processor's cache.
SMALL, AT_ONCE = 48, 1 << 16


def shingle_sets(buf: np.ndarray, offs: np.ndarray, size: int) -> list[np.ndarray]:
    """The set of each row: sorted hashes of its distinct shingles."""
    out = []
    for a, b in blocks(offs):
        own = LOWER[buf[offs[a] : offs[b]]]
        starts, ends, bounds = spans(SPACE[own], offs[a : b + 1] - offs[a])
        hashed = keyed_hashes(own, starts, ends)
        out += [shingles(hashed[bounds[i] : bounds[i + 1]], size) for i in range(b - a)]
    return out


def digest(elements: np.ndarray) -> bytes | None:
    """A set's name; an empty set has none."""
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def signatures(df: DataFrame, id_col: str, text: str, size: int) -> DataFrame:
    """For each row: ``id``, the text's ``hash``, number of shingles ``n``, the set's digest ``set`` and its ``bands``."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(*utf8(batch.column(2)), size)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(np.stack([signature(sets[i], BANDS * ROWS) for i in full]), BANDS, ROWS) if full else np.zeros((0, BANDS), np.int64)
            ends = np.zeros(len(sets) + 1, np.int32)
            ends[np.array(full, np.int64) + 1] = BANDS
            bands = pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), pa.array(keys.ravel(), pa.int64()))
            columns = [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.binary()), bands]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "hash", "n", "set", "bands"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(id_col, F.xxhash64(text), text), run, f"id {kind}, hash long, n long, set binary, bands array<bigint>")


def candidate_edges(sets: DataFrame, percent: int = 80, meet: int = 2) -> DataFrame:
    """Edges (a, b) whose components hold every link, from rows with ``set`` (a name of any orderable type), size ``n`` and
    ``bands``. A pair in small buckets must ``meet`` in so many, and its sizes must allow ``percent``."""
    rows = sets.select("set", "n", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("held"), F.min("set").alias("least")).filter(F.col("held") > 1)
    members = written(rows.join(shared, "bucket"), "members")
    few = members.filter(F.col("held") <= FEW).groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("set", "n"))).alias("all"))
    pairs = few.select("all", F.posexplode("all").alias("at", "a")).select("a", F.explode(F.slice("all", F.col("at") + 2, FEW)).alias("b"))
    near = F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent
    pairs = pairs.filter(near).select(F.col("a.set").alias("a"), F.col("b.set").alias("b")).groupBy("a", "b").count().filter(F.col("count") >= meet).select("a", "b")
    stars = members.filter((F.col("held") > FEW) & (F.col("set") != F.col("least"))).select(F.col("set").alias("a"), F.col("least").alias("b")).distinct()
    return pairs.unionByName(stars)


def dealt(nodes: DataFrame) -> DataFrame:
    """Rows (group, set, n, ...) of groups with two sets or more, with the ``units`` of work (g, i, j) that each takes part in.

    Small groups share units; a large one becomes blocks, and each pair of blocks is a unit of its own."""
    sizes = written(nodes.groupBy("group").agg(F.count("*").alias("many"), F.sum("n").alias("total")).filter(F.col("many") > 1), "sizes")
    units = 1 + int(sizes.agg(F.sum("total")).first()[0] or 0) // BLOCK_ELEMENTS
    parts = F.ceil(F.greatest(F.col("many") / BLOCK_TEXTS, F.col("total") / BLOCK_ELEMENTS, F.lit(1))).cast("long")
    rows = nodes.join(sizes.select("group", parts.alias("parts")), "group").withColumn("own", F.pmod(F.xxhash64("set"), "parts"))
    kind = nodes.schema["group"].dataType
    alone = F.array(F.struct(F.lit(None).cast(kind).alias("g"), F.pmod(F.xxhash64("group"), F.lit(units)).alias("i"), F.lit(0).cast("long").alias("j")))
    paired = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda x: F.struct(F.col("group").alias("g"), F.least("own", x).alias("i"), F.greatest("own", x).alias("j")))
    return rows.withColumn("units", F.when(F.col("parts") == 1, alone).otherwise(paired)).drop("parts", "own")


def exact_links(rows: DataFrame, make_sets: Callable, percent: int) -> DataFrame:
    """Spanning forests (a, b) of the exact links within the groups, from rows with ``units``, ``group``, ``set``, ``text``.

    ``make_sets`` turns bytes and offsets into sets. Of rows with one name, the first counts."""
    kind = rows.schema["set"].dataType.simpleString()
    arrow = {"binary": pa.binary(), "bigint": pa.int64()}[kind]

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [("group", "ascending"), ("set", "ascending")]))
        groups, names, sets = table["group"].to_pylist(), table["set"].to_pylist(), make_sets(*utf8(table["text"]))
        own = [k for k in range(len(names)) if not k or names[k] != names[k - 1]]
        starts = [k for k in range(len(own)) if not k or groups[own[k]] != groups[own[k - 1]]]
        sizes = np.diff(np.array([*starts, len(own)], np.int64))
        starts = np.array(starts, np.int64)
        pairs: list[tuple[int, int]] = []
        for k in np.flatnonzero(sizes > SMALL).tolist():
            some = own[starts[k] : starts[k] + sizes[k]]
            pairs += [(some[x], some[y]) for x, y in forest(len(some), *links([sets[i] for i in some], percent))]
        todo, weight = np.flatnonzero((sizes > 1) & (sizes <= SMALL)), np.array([len(sets[i]) for i in own], np.int64)
        held = np.add.reduceat(weight, starts)[todo] + sizes[todo] ** 2 if len(todo) else np.zeros(0, np.int64)
        for part in np.split(todo, np.flatnonzero(np.diff(np.cumsum(held) // AT_ONCE)) + 1):
            some = [own[j] for k in part.tolist() for j in range(starts[k], starts[k] + sizes[k])]
            pairs += [(some[x], some[y]) for x, y in forest(len(some), *grouped_links([sets[i] for i in some], sizes[part], percent))] if some else []
        a, b = [names[x] for x, _ in pairs], [names[y] for _, y in pairs]
        return pa.table({"a": pa.array(a, arrow), "b": pa.array(b, arrow)})

    ship(rows.sparkSession)
    each = rows.select(F.explode("units").alias("unit"), "group", "set", "text").select("unit.*", "group", "set", "text")
    return each.groupBy("g", "i", "j").applyInArrow(run, f"a {kind}, b {kind}")


def _labelled(df: DataFrame, id_col: str, text: str, size: int, percent: int) -> DataFrame:
    """For each row: id, hash of its text, n and, if it has shingles, of its component the ``least`` id and the ``first``
    row (none, id, hash), null ids last.

    Rows are linked if 100 * intersection >= percent * union of their sets of ``size``-word shingles (A-Z lower-cased,
    words parted by ASCII white space; fewer words are one shingle)."""
    rows = written(signatures(df, id_col, text, size), "signatures")
    sets = rows.filter(F.col("n") > 0).groupBy("set").agg(F.min("id").alias("id"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("rep"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"))
    sets = written(sets, "sets")
    groups = connected_components(candidate_edges(sets, percent=percent))
    nodes = groups.join(sets.select("set", "rep", "n"), groups["node"] == F.col("set")).select(F.col("component").alias("group"), "set", "n", "rep")
    nodes = written(dealt(nodes), "nodes").select("units", "group", "set", F.col("rep.id").alias("id"), F.col("rep.hash").alias("hash"))
    texts = df.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__hash"), F.col(text).alias("text"))
    texts = texts.join(nodes, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__hash") == F.col("hash")))
    found = connected_components(exact_links(texts, lambda buf, offs: shingle_sets(buf, offs, size), percent))
    label = sets.select("set", "id", "rep").join(found, F.col("set") == F.col("node"), "left").select("set", "id", "rep", F.coalesce("component", "set").alias("component"))
    least = label.groupBy("component").agg(F.min("id").alias("least"), F.min("rep").alias("first"))
    label = label.join(least, "component").select("set", "least", "first")
    return rows.select("id", "hash", "n", "set").join(label, "set", "left")


def components(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """For each row: its id, n_shingles, component_id (the smallest id reachable) and kept (whether that is its own)."""
    out = _labelled(df, id_col, text, size, percent)
    own_id = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own_id.alias("component_id"), F.col("id").eqNullSafe(own_id).alias("kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with, of each component, the row of the smallest id (of its texts, the one of the smallest hash); all columns
    as they were. Rows that repeat an id and a text share a fate, rows that share only an id don't. The dropped ones are
    written first, so the planner knows their size."""
    found = _labelled(df, id_col, text, size, percent)
    other = ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash")))
    gone = written(found.filter((F.col("n") > 0) & other).select(F.col("id").alias("__id"), F.col("hash").alias("__hash")).distinct(), "dropped")
    return df.join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left_anti")
