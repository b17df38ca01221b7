"""Exact top-k search by pivot-table elimination.

Vectors become integers, floor(64 * x). Each vector's distances to ``PIVOTS`` pivots are computed once and written beside it.
For a query the greatest difference of its and a candidate's distance to one pivot is a lower bound of their
distance, and with the norms an upper bound of their inner product: 2 q·v = |q|² + |v|² - |q - v|². Candidates are
evaluated in the order of that bound, in growing portions, until it falls below the k-th best score so far; ties go on,
so the result is exact. Pivots are chosen farthest-first from a bounded sample, the ``SAMPLE`` vectors first by hash; they
decide speed, not results.

Candidates and queries are dealt to blocks by hash of their id, each pair of a query block and a candidate block is one
task of bounded size, and only a task's best k for each query leave it.

Vectors that are null or empty, or hold null or non-finite components, take no part; vectors of different length are never
compared. A query is never its own candidate; rows that repeat its id aren't, either. Products of components too large for exact
floats are taken in whole numbers of any size, without bounds; a score that leaves 64 bits counts as the nearest 64-bit number.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import map_arrow, ship, written

PIVOTS, SAMPLE = 128, 2048
#: Bounds of a task: queries, and candidates.
QUERIES, CANDIDATES = 1024, 1 << 14
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1


def vectors(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, x, d): the vectors that take part, as arrays of double, and their length."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    return df.filter(F.col(id_col).isNotNull() & F.coalesce(fine & (F.size(x) > 0), F.lit(False))).select(F.col(id_col).alias("id"), x.alias("x"), F.size(x).alias("d"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), kind).reshape(-1, width)


def limit(width: int) -> float:
    """Products of vectors of components below this are exact as floats."""
    return math.isqrt((1 << 52) // width)


def whole(x: float) -> int:
    """floor(64 * x), whatever its size."""
    y = x * 64
    return math.floor(y) if math.isfinite(y) else int(x) * 64


def product(a: list[int], b: list[int]) -> int:
    return min(max(sum(x * y for x, y in zip(a, b, strict=True)), LEAST), GREATEST)


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    """Rows of the sample, each as far as can be from those before it."""
    out, far = [0], np.full(len(sample), np.inf)
    while len(out) < min(n, len(sample)):
        far = np.minimum(far, ((sample - sample[out[-1]]) ** 2).sum(axis=1))
        out.append(int(far.argmax()))
    return sample[out]


def distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """n x pivots, as 32-bit floats."""
    if not len(pivots):
        return np.zeros((len(v), 0), np.float32)
    return np.sqrt(np.maximum((v * v).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * v @ pivots.T, 0)).astype(np.float32)


def widest(far: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Each candidate's greatest difference of distances to a pivot; ``far`` is pivots x candidates, so that a pivot's
    distances stay in a processor's cache."""
    out, gap = np.zeros(far.shape[1], np.float32), np.empty(far.shape[1], np.float32)
    for d, x in zip(far, own, strict=True):
        np.abs(np.subtract(d, x, out=gap), out=gap)
        np.maximum(out, gap, out=out)
    return out


def first(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows in order; only those that reach the k-th score are sorted."""
    if len(rows) > k > 0:
        fine = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        rows, scores = rows[fine], scores[fine]
    order = np.lexsort((ids[rows], ~scores))[:k]
    return rows[order], scores[order]


def best(queries: np.ndarray, query_ids: np.ndarray, to_q: np.ndarray, v: np.ndarray, ids: np.ndarray, to_v: np.ndarray, k: int, seen: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows of its best k candidates and their scores, in order; ``queries`` and ``v`` as doubles.
    ``seen`` gets the pairs, and those that were evaluated."""
    size = limit(queries.shape[1])
    with np.errstate(over="ignore", invalid="ignore"):
        q, v64 = np.floor(queries * 64), np.floor(v * 64)
        large_q, large_v = ~(np.abs(q) < size).all(axis=1), ~(np.abs(v64) < size).all(axis=1)
    many = np.flatnonzero(large_v).tolist()
    exact = {j: [whole(x) for x in v[j].tolist()] for j in (range(len(v)) if large_q.any() else many)}
    v64[large_v] = 0
    norm_v = (v64 * v64).sum(1)
    far, farthest = np.ascontiguousarray(to_v.T), to_v.max(initial=0)
    out = []
    for i in range(len(q)):
        asked = [whole(x) for x in queries[i].tolist()] if large_q[i] or many else None
        rows = np.array([j for j in (range(len(v)) if large_q[i] else many) if ids[j] != query_ids[i]], np.int64)
        scores = np.array([product(asked, exact[j]) for j in rows.tolist()], np.int64)
        if not large_q[i]:
            norm_q = (q[i] * q[i]).sum()
            slack = 4e-7 * max(farthest, to_q[i].max(initial=0))  # what 32 bits may take
            low = np.maximum(widest(far, to_q[i]).astype(np.float64) - slack, 0)
            bound = (norm_q + norm_v - low * low) / 2
            bound += 1e-6 * (norm_q + norm_v) + 1e-3  # and rounding
            open_, least, portion, every = np.flatnonzero((ids != query_ids[i]) & ~large_v), -np.inf, max(4 * k, 128), None
            if seen is not None:
                seen[0] += len(open_)
            while len(open_):
                if portion < len(open_):
                    part = np.argpartition(-bound[open_], portion - 1)
                    now, open_ = open_[part[:portion]], open_[part[portion:]]
                else:
                    now, open_ = open_, open_[:0]
                if seen is not None:
                    seen[1] += len(now)
                # a product of all rows costs less than to gather a quarter of them; sums of whole numbers are exact in any order
                if every is None and len(now) * 4 > len(v64):
                    every = v64 @ q[i]
                found = (v64[now] @ q[i] if every is None else every[now]).astype(np.int64)
                rows, scores = np.concatenate([rows, now]), np.concatenate([scores, found])
                rows, scores = first(rows, scores, ids, k)
                if len(rows) == k:
                    least = scores[-1]
                    open_ = open_[bound[open_] >= least]
                portion = portion * 4 if every is None else len(open_)
        out.append(first(rows, scores, ids, k))
    return out


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """Of each length that the sample has, the pivots, as whole numbers."""
    few = rows.withColumn("o", F.xxhash64("id", F.lit("pivot"))).orderBy("o", "id").limit(SAMPLE).collect()
    sample: dict[int, list] = {}
    for r in few:
        x = np.floor(np.array(r["x"]) * 64) if np.abs(r["x"]).max() < limit(r["d"]) / 64 else None
        if x is not None:
            sample.setdefault(r["d"], []).append(x)
    return {d: farthest_first(np.array(x), PIVOTS) for d, x in sample.items()}


def _tabled(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with ``far``, each vector's distances to the pivots."""

    def run(batches):
        for batch in batches:
            widths = np.asarray(batch.column(2))
            far: list = [None] * batch.num_rows
            for d in np.unique(widths).tolist():
                own = np.flatnonzero(widths == d)
                with np.errstate(over="ignore", invalid="ignore"):
                    v = np.floor(_matrix(batch.column(1).take(pa.array(own)), d) * 64)
                    v[~(np.abs(v) < limit(d)).all(axis=1)] = 0
                for k, x in zip(own.tolist(), distances(v, pivots.get(d, np.zeros((0, d)))), strict=True):
                    far[k] = x
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far, pa.list_(pa.float32()))], names=[*batch.schema.names, "far"])

    return map_arrow(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>, d int, far array<float>")


def search(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, id, score): the k best candidates by integer inner product of each row whose id ``every`` divides."""
    rows = written(vectors(df, id_col, vector), "vectors")
    rows = written(_tabled(rows, _pivots(rows)), "distances")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    q_blocks, c_blocks = 1 + sizes["q"] // QUERIES, 1 + sizes["n"] // CANDIDATES
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))
    block = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(int(n))).cast("int")
    asked = rows.filter(F.col("id") % every == 0).select("id", "x", "d", "far", F.lit(True).alias("asks"), block(q_blocks, "q").alias("i"), spread(c_blocks).alias("j"))
    given = rows.select("id", "x", "d", "far", F.lit(False).alias("asks"), spread(q_blocks).alias("i"), block(c_blocks, "c").alias("j"))

    def run(table: pa.Table) -> pa.Table:
        d, width = table["d"][0].as_py(), len(table["far"][0])
        asks = np.asarray(table["asks"])
        ids, x, far = np.asarray(table["id"]), _matrix(table["x"], d), _matrix(table["far"], width, np.float32) if width else np.zeros((len(asks), 0), np.float32)
        found = best(x[asks], ids[asks], far[asks], x[~asks], ids[~asks], far[~asks], k)
        other = ids[~asks]
        return pa.table({
            "query_id": pa.array(np.repeat(ids[asks], [len(r) for r, _ in found]), pa.int64()),
            "id": pa.array(np.concatenate([np.zeros(0, np.int64), *(other[r] for r, _ in found)]), pa.int64()),
            "score": pa.array(np.concatenate([np.zeros(0, np.int64), *(s for _, s in found)]), pa.int64()),
        })

    ship(df.sparkSession)
    part = asked.unionByName(given).groupBy("d", "i", "j").applyInArrow(run, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
