"""Connected components, distributed: alternating large-star and small-star steps over an edge table.

Each step moves edges towards the smallest node in reach, with a map-side minimum for each node and a join, and is
written to the shared folder; before the first, each task contracts the edges it holds,
and edges that several tasks found become one. It ends when a round changes nothing. No node's neighbours are ever gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow, spent, written

ROUNDS, HELD = 60, 1 << 19


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """``edges`` lead from the larger node a to the smaller b, as _large leaves them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


class _Forest:
    """Union-find over any names; the smallest name of a set is its root."""

    def __init__(self) -> None:
        self.up: dict = {}

    def top(self, x):
        up = self.up
        root = x
        while (y := up.setdefault(root, root)) != root:
            root = y
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def join(self, x, y) -> None:
        p, q = self.top(x), self.top(y)
        if p != q:
            self.up[max(p, q)] = min(p, q)

    def edges(self) -> tuple[list, list]:
        a = [x for x, y in self.up.items() if x != y]
        return a, [self.top(x) for x in a]


def _contracted(edges: DataFrame) -> DataFrame:
    """Each task's edges as stars around their smallest nodes: fewer edges and shorter paths before the first round.
    A task holds at most HELD nodes at once and then begins anew, which costs rounds, not results."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches):
        own, types = _Forest(), None
        for batch in batches:
            types = batch.schema.types
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own.join(x, y)
            if len(own.up) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(own.edges(), types, strict=True)], names=["a", "b"])
                own = _Forest()
        if own.up:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(own.edges(), types, strict=True)], names=["a", "b"])

    return map_arrow(edges, run, f"a {kind}, b {kind}")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of ``edges`` (columns a and b, one orderable type) the smallest node it reaches.

    Loops are ignored; nodes without an edge to another node don't appear."""
    now = written(_contracted(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).distinct(), "edges")
    state = None
    for _ in range(ROUNDS):
        new = written(_small(_large(now)), "edges")
        was, state = state, new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        spent(now)
        now = new
        if was == state or not state[0]:
            break
    else:
        raise RuntimeError(f"components haven't settled in {ROUNDS} rounds")
    roots = now.groupBy("a").agg(F.min("b").alias("b"))
    return roots.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (a, b) between nodes 0 to n - 1, as many as connect the same nodes."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out
