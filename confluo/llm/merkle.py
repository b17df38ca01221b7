"""Merkle manifest of a table: a persistent, path-copying tree in aligned blocks.

Every row is a leaf, the SHA-256 of its fields. Per group, leaves ascend by id (equal ids by leaf, null ids first); while
several nodes remain, every two consecutive ones become their hash, a last one alone the hash of itself. What remains is
the group's root; the groups' roots, ordered by group (null first, UTF-8 bytewise), make the table's root in the same way.

4,096 consecutive nodes (12 ``LEVELS``) are one task's tree (``Block``); its top is a node of the next tier, where as many tops
make a block again. A tier is a table; each has a 4,096th of the rows of the one below, down to a row for each group. Nodes are
numbered by range partitions and their counts, so no group, however large, is in one task.

A change to a leaf makes a version of its block's tree: new nodes for the leaf and its ancestors, all others shared with
the original. The version goes on above its block row by row, along the path of siblings that the upper tiers hand down to
each block; versions are never gathered.

Null fields are hashed as ``-``, so a null text differs from an empty one; rows that repeat all fields are leaves of their
own; an empty table gives no rows. Columns that aren't fields are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ship, written

#: Levels of a block; it has two to the power of that many nodes.
LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """Hash of the fields, each with its length in bytes before it."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (g, ...) with ``pos``, each row's place from 0 in its ``g`` by ``order``, and ``m``, the rows of the ``g``.

    The rows are sorted by range; equal ones may be parted. Only counts of (partition, g) are summed up."""
    ranged = rows.withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange("g", *order, "__salt")
    placed = written(ranged.sortWithinPartitions("g", *order, "__salt").drop("__salt").withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy("g", part.alias("part")).agg(F.min("__at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("g")
    before = F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = written(counts.select("g", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(own).alias("m")), "counts")
    return placed.withColumn("part", part).join(counts, ["g", "part"]).withColumn("pos", F.col("__at") - F.col("first") + F.col("before")).drop("__at", "part", "first", "before")


class Block:
    """A tree of up to ``most`` levels above its nodes, which may be the last of ``m`` nodes in all."""

    def __init__(self, nodes: list[str], m: int, most: int = LEVELS):
        self.levels = [nodes]
        for _ in range(min(most, (m - 1).bit_length())):
            below = self.levels[-1]
            self.levels.append([digest(*below[k : k + 2]) for k in range(0, len(below), 2)])
        self.top = self.levels[-1][0]

    def path(self, at: int) -> list[str]:
        """The siblings from the node at ``at`` to the top: ``<`` and the left one, ``>`` and the right one, or ``-``."""
        out = []
        for level in self.levels[:-1]:
            other = at ^ 1
            out.append("-" if other >= len(level) else ("<" if at & 1 else ">") + level[other])
            at >>= 1
        return out

    def version(self, at: int, node: str) -> list[str]:
        """The new nodes, from the changed one to the new top, of the version in which the node at ``at`` is ``node``."""
        out = [node]
        for step in self.path(at):
            out.append(fold(out[-1], step))
        return out


def fold(node: str, step: str) -> str:
    return digest(node) if step == "-" else digest(step[1:], node) if step[0] == "<" else digest(node, step[1:])


def _block(table: pa.Table, levels: int) -> tuple[pa.Table, list[int], Block]:
    """The block's rows in order, their places in it, and its tree."""
    table = table.take(pc.sort_indices(table, [("pos", "ascending")]))
    return table, [p % (1 << levels) for p in table["pos"].to_pylist()], Block(table["node"].to_pylist(), table["m"][0].as_py(), levels)


def _tier(nodes: DataFrame, levels: int) -> DataFrame:
    """The tops (g, pos, m, node) of the blocks of ``nodes``."""

    def run(table: pa.Table) -> pa.Table:
        m, pos = table["m"][0].as_py(), table["pos"][0].as_py()
        return pa.table({"g": table["g"][:1], "pos": [pos >> levels], "m": [-(-m >> levels)], "node": [_block(table, levels)[2].top]})

    ship(nodes.sparkSession)
    own = nodes.select("g", "pos", "m", "node", F.shiftright("pos", levels).alias("block"))
    return written(own.groupBy("g", "block").applyInArrow(run, "g string, pos long, m long, node string"), "tier")


def _tiers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """All tiers above ``nodes``; the last has one node for each ``g``."""
    out = [_tier(nodes, levels)]
    while not out[-1].filter(F.col("m") > 1).isEmpty():
        out.append(_tier(out[-1], levels))
    return out


def _paths(nodes: DataFrame, upper: DataFrame, levels: int) -> DataFrame:
    """(g, pos, node, path) of a tier's nodes, whose blocks' tops have the paths of ``upper``."""

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table, places, tree = _block(table, levels)
        rest = above["path"][0].as_py()
        return pa.table({"g": table["g"], "pos": table["pos"], "node": table["node"], "path": pa.array([tree.path(p) + rest for p in places], pa.list_(pa.string()))})

    ship(nodes.sparkSession)
    left = nodes.select("g", "pos", "m", "node", F.shiftright("pos", levels).alias("block")).groupBy("g", "block")
    right = upper.select("g", "pos", "path").groupBy("g", "pos")
    return written(left.cogroup(right).applyInArrow(run, "g string, pos long, node string, path array<string>"), "paths")


def _down(tiers: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """Paths of the lowest tier's nodes, from those of the last tier's (g, pos, node, path)."""
    for tier in reversed(tiers[:-1]):
        top = _paths(tier, top, levels)
    return top


def manifest(df: DataFrame, id_col: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, count: str = "n_chars", one_in: int = 7, levels: int = LEVELS) -> DataFrame:
    """For each row: its id, leaf, subroot (of its group), root, proof_sha256 (of the siblings up to the root), folded_root
    (from the leaf, or from the tampered one where ``one_in`` divides the id's CRC-32) and verified.

    Tampering adds 1 to ``count``; a null stays, and so does the root."""
    values = [F.col(f"`{f}`") for f in fields]
    more = [(v.cast("decimal(38,0)") + 1).cast("string") if f == count else v for f, v in zip(fields, values, strict=True)]
    tampered = F.when(F.crc32(F.col(id_col).cast("string")) % one_in == 0, leaf(more))
    g = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    leaves = numbered(df.select(g.alias("g"), F.col(id_col).alias("id"), leaf(values).alias("node"), tampered.alias("changed")), "id", "node")
    leaves = leaves.withColumn("block", F.shiftright("pos", levels))
    tiers = _tiers(leaves, levels)
    roots = numbered(tiers[-1].select(F.lit("").alias("g"), F.col("g").alias("own"), "node"), "own")
    roots = written(roots, "roots")
    above = _tiers(roots, levels)
    root = above[-1].select("g", "pos", "node", F.array().cast("array<string>").alias("path"))
    groups = _paths(roots, _down(above, root, levels), levels).join(roots.select("pos", "own"), "pos")
    ends = groups.select("g", F.col("own"), F.col("node").alias("subroot")).join(root.select("g", F.col("node").alias("root")), "g").drop("g")
    upper = _down(tiers, groups.select(F.col("own").alias("g"), F.lit(0).cast("long").alias("pos"), "node", "path"), levels).select("g", "pos", "path").join(ends, F.col("g") == F.col("own"))

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table, places, tree = _block(table, levels)
        rest = above["path"][0].as_py()
        proofs, folded = [], []
        for at, changed, own in zip(places, table["changed"].to_pylist(), table["node"].to_pylist(), strict=True):
            path = tree.path(at) + rest
            proofs.append(digest(*[s[1:] for s in path]))
            node = tree.top if changed is None or changed == own else tree.version(at, changed)[-1]
            for step in rest:
                node = fold(node, step)
            folded.append(node)
        n, root = len(places), above["root"][0].as_py()
        return pa.table({"id": table["id"], "leaf": table["node"], "subroot": [above["subroot"][0].as_py()] * n, "root": [root] * n, "proof": proofs, "folded": folded, "verified": [x == root for x in folded]})

    kind = leaves.schema["id"].dataType.simpleString()
    right = upper.select("g", "pos", "path", "subroot", "root").groupBy("g", "pos")
    done = leaves.groupBy("g", "block").cogroup(right).applyInArrow(run, f"id {kind}, leaf string, subroot string, root string, proof string, folded string, verified boolean")
    return done.select(F.col("id").alias(id_col), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"), "verified")
