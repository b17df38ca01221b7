"""Language identification by a string kernel.

The kernel of two texts is the number of byte n-grams (of 1 to ``ORDERS`` bytes, hashed to ``2**BITS`` numbers) present
in both, over the root of the product of their counts: a blended-spectrum presence kernel. A bounded sample of labelled
rows gives landmarks; the Nyström map of the kernel to them feeds one ridge regression for each language against the
rest. Scoring is batched matrix products: presence by landmarks, then landmarks by languages.

Rows train a model only if they have a label, hold a letter and aren't held out; the sample takes ``PER_LABEL`` rows of
each label, first by hash of the id, ``MOST`` in all, and one row of each id and label. Its landmarks are at most
``LANDMARKS`` of a label and ``MARKS`` in all. Without such rows every prediction is ``und`` with score 0; a null text, or
one without letters, is so always. Any other text gets the label that scores best.

Beside it stands ``like``: whether the text is like that language at all (a dump of hex digits, or a language no label
has, isn't). Its *level* is the mean, over its n-grams of the highest order with two letters or more, of the logarithm
of the share of the label's sample rows that hold it. The sample's own levels, each row judged by the others, set
the label's floor: halfway from their median to the level of a text of unknown n-grams, or twice as far from the median
as their ``LOW`` quantile, whichever is lower. A label of fewer than ``FEWEST`` rows has no floor, and a text without
such n-grams is not held against one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import map_arrow
from .textbuf import U, blocks, utf8

ORDERS, BITS = 3, 18
#: Bounds of the sample: rows of a label, rows in all, landmarks of a label, landmarks in all.
PER_LABEL, MOST, LANDMARKS, MARKS = 300, 6000, 32, 512
PARTS = 64
RIDGE = 0.1
UNKNOWN = "und"
#: Bytes as the kernel sees them: small letters, and one blank for all that isn't a letter.
SEEN = np.full(256, 32, np.uint8)
SEEN[97:123] = np.arange(97, 123)
SEEN[65:91] = np.arange(97, 123)
SEEN[128:] = np.arange(128, 256)
ROWS = 256
#: The floor of a label's levels: a low quantile of its sample's, and the rows it takes to set one.
LOW, FEWEST = 0.02, 10


def _bare() -> np.ndarray:
    """Which hashed n-grams of the highest order hold fewer than two letters."""
    key = np.concatenate([(np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) | np.uint32(0x202020 & ~(255 << 8 * k)) for k in range(ORDERS)])
    out = np.zeros(1 << BITS, bool)
    out[_hashed(key, ORDERS)] = True
    return out


def _hashed(key: np.ndarray, order: int) -> np.ndarray:
    return ((key + np.uint32(order << 24)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)


BARE = _bare()


def grams(buf: np.ndarray, offs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: rows and hashed n-grams, with repeats, of a block. Each text is read with a blank on both sides."""
    n = len(offs) - 1
    places = np.arange(len(buf)) + 2 * np.repeat(np.arange(n), np.diff(offs)) + 1
    padded = np.full(len(buf) + 2 * n, 32, np.uint32)
    padded[places] = SEEN[buf]
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(offs) + 2)
    out, key = [], padded.copy()
    for k in range(1, ORDERS + 1):
        if k > 1:
            key = (key[:-1] << np.uint32(8)) | padded[k - 1 :]
        own = row[: len(key)]
        inside = own == row[k - 1 :] if k > 1 else slice(None)
        out.append((own[inside], _hashed(key[inside], k)))
    return out


@dataclass(frozen=True)
class Model:
    """Of a size that the sample's bounds set: the landmarks are bits, 16 MB at most."""

    labels: list[str]
    column: np.ndarray  # of each hashed n-gram, -1 if no landmark has it
    held: np.ndarray  # columns x landmarks, packed bits: which landmark holds which n-gram
    scale: np.ndarray  # of each landmark
    weights: np.ndarray  # landmarks x labels
    place: np.ndarray  # of each hashed n-gram in ``above``, the last one if the sample has it not
    above: np.ndarray  # labels x n-grams: how far an n-gram's level lies above the label's floor

    @cached_property
    def landmarks(self) -> np.ndarray:
        """columns x landmarks, scaled."""
        return np.unpackbits(self.held, axis=1, count=len(self.scale)).astype(np.float32) * self.scale

    def scores(self, found: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
        """Rows x labels, from the ``grams`` of n rows."""
        width = len(self.landmarks)
        present = np.zeros(n * width, np.float32)
        total = np.zeros(n, np.float32)
        for row, gram in found:
            at = self.column[gram]
            known = at >= 0
            present[row[known].astype(np.int64) * width + at[known]] = 1
            if not known.all():
                total += np.bincount(np.unique((row[~known].astype(np.int64) << BITS) | gram[~known]) >> BITS, minlength=n)
        present = present.reshape(n, width)
        total += present.sum(axis=1)
        kernel = (present @ self.landmarks) / np.sqrt(np.maximum(total, 1))[:, None]
        return kernel @ self.weights

    def like(self, found: list[tuple[np.ndarray, np.ndarray]], best: np.ndarray) -> np.ndarray:
        """Which rows reach the floor of their label."""
        row, gram = found[-1]
        some = ~BARE[gram]
        row = row[some]
        # the sum has the sign of the mean
        return np.bincount(row, self.above[best[row], self.place[gram[some]]], minlength=len(best)) >= 0


def floors(counted: list[tuple[np.ndarray, np.ndarray]], labels: list[str], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``place`` and ``above`` of a model, from the rows' hashed n-grams of the highest order and how often each has them."""
    counted = [(gram[~BARE[gram]], held[~BARE[gram]]) for gram, held in counted]
    vocabulary = np.unique(np.concatenate([gram for gram, _ in counted]))
    place = np.full(1 << BITS, len(vocabulary), np.int32)
    place[vocabulary] = np.arange(len(vocabulary))
    above = np.zeros((len(names), len(vocabulary) + 1), np.float32)
    for k, name in enumerate(names):
        own = [(place[gram], held) for (gram, held), x in zip(counted, labels, strict=True) if x == name and len(gram)]
        n = len(own)
        if n < FEWEST:
            continue
        rows = np.bincount(np.concatenate([gram for gram, _ in own]), minlength=len(vocabulary) + 1)
        levels = np.array([np.average(np.log((rows[gram] - 0.5) / n), weights=held) for gram, held in own])
        middle, low = np.quantile(levels, [0.5, LOW])
        floor = min((middle + np.log(0.5 / (n + 1))) / 2, 2 * low - middle)
        above[k] = np.log((rows + 0.5) / (n + 1)) - floor
    return place, above


def train(presence: list[np.ndarray], counted: list[tuple[np.ndarray, np.ndarray]], labels: list[str]) -> Model | None:
    """A model from the rows' sets of hashed n-grams, and the highest order's with their counts, in the sample's order."""
    names = sorted(set(labels))
    if not names:
        return None
    each = max(1, min(LANDMARKS, MARKS // len(names)))
    chosen, seen = [], dict.fromkeys(names, 0)
    for i, label in enumerate(labels):
        if seen[label] < each and len(chosen) < MARKS and len(presence[i]):
            seen[label] += 1
            chosen.append(i)
    vocabulary = np.unique(np.concatenate([presence[i] for i in chosen]))
    column = np.full(1 << BITS, -1, np.int32)
    column[vocabulary] = np.arange(len(vocabulary))

    def rows(some: list[int]) -> np.ndarray:
        out = np.zeros((len(some), len(vocabulary)), np.float32)
        for k, i in enumerate(some):
            at = column[presence[i]]
            out[k, at[at >= 0]] = 1
        return out

    sizes = np.sqrt(np.maximum([len(p) for p in presence], 1))
    held, scale = rows(chosen), (1 / sizes[chosen]).astype(np.float32)
    parts = [rows(list(range(k, min(k + ROWS, len(labels))))) @ held.T for k in range(0, len(labels), ROWS)]
    kernel = np.concatenate(parts).astype(np.float64) / sizes[:, None] / sizes[chosen]
    value, vector = np.linalg.eigh(kernel[chosen])
    keep = value > 1e-8 * value.max()
    to_space = vector[:, keep] / np.sqrt(value[keep])
    space = kernel @ to_space
    target = np.where(np.array(labels)[:, None] == np.array(names), 1.0, -1.0)
    weight = 1.0 / np.array([labels.count(x) for x in labels])
    normal = (space * weight[:, None]).T @ space + RIDGE / len(labels) * np.eye(space.shape[1])
    ridge = np.linalg.solve(normal, (space * weight[:, None]).T @ target)
    return Model(names, column, np.packbits(held.T.astype(bool), axis=1), scale, (to_space @ ridge).astype(np.float32), *floors(counted, labels, names))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row takes no part in training: crc32 of the id as text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _letters(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def fit(df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang") -> Model | None:
    """Trains on the sample described above; only its sets of n-grams come to the driver."""
    usable = df.filter(F.col(label).isNotNull() & ~held_out(id_col))
    order = [F.xxhash64("__id"), F.col("__id")]
    # a label may hold most rows: the first of each of many parts, then the first of those
    part = Window.partitionBy("__label", F.pmod(F.xxhash64(F.lit("part"), "__id"), F.lit(PARTS))).orderBy(*order)
    first = Window.partitionBy("__label").orderBy(*order)
    some = usable.filter(_letters(text)).select(F.col(id_col).alias("__id"), F.col(label).cast("string").alias("__label")).distinct()
    for window in (part, first):
        some = some.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= PER_LABEL)
    some = some.orderBy("__rank", "__label").limit(MOST)
    rows = usable.select(F.col(id_col).alias("__id"), F.col(label).cast("string").alias("__label"), F.col(text).alias("__text"))
    rows = rows.join(F.broadcast(some), ["__id", "__label"]).select("__rank", "__label", "__text")

    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(2))
            each = [[g for _, g in grams(buf[offs[i] : offs[i + 1]], offs[i : i + 2] - offs[i])] for i in range(len(offs) - 1)]
            high = [np.unique(x[-1], return_counts=True) for x in each]
            parts = [[np.unique(np.concatenate(x)) for x in each], [g for g, _ in high], [held for _, held in high]]
            columns = [pa.array([x.astype(np.int32).tobytes() for x in part], pa.binary()) for part in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["rank", "label", "grams", "high", "held"])

    each = map_arrow(rows, run, "rank int, label string, grams binary, high binary, held binary")
    # rows that repeat an id and a label share a rank: one of them counts
    one = each.groupBy("rank", "label").agg(F.min(F.struct("grams", "high", "held")).alias("row")).select("rank", "label", "row.*")
    got = sorted(tuple(r) for r in one.collect())
    ints = lambda x: np.frombuffer(x, np.int32)
    return train([ints(r[2]) for r in got], [(ints(r[3]), ints(r[4])) for r in got], [r[1] for r in got])


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (half of one plus the best regression's value, kept within 0 and 1) and ``like``."""
    more = "lang_pred string, score double, like boolean"
    names = [f.split()[0] for f in more.split(", ")]
    keep = [c for c in df.columns if c not in names]
    work = df.select(*[F.col(f"`{c}`") for c in keep], _letters(text).alias("__letters"))
    at = keep.index(text)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            best, score, like = np.full(n, -1), np.zeros(n), np.zeros(n, bool)
            buf, offs = utf8(batch.column(at))
            for a, b in blocks(offs) if model else ():
                for i in range(a, b, ROWS):
                    j = min(b, i + ROWS)
                    found = grams(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                    value = model.scores(found, j - i)
                    best[i:j] = value.argmax(axis=1)
                    like[i:j] = model.like(found, best[i:j])
                    score[i:j] = np.clip((1 + value.max(axis=1).astype(np.float64)) / 2, 0, 1)
            known = np.asarray(batch.column(len(keep)).to_pylist(), bool) & (best >= 0)
            labels = [model.labels[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
            new = [pa.array(labels, pa.string()), pa.array(np.where(known, score, 0.0), pa.float64()), pa.array(known & like)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + new, names=[*batch.schema.names[:-1], *names])

    from pyspark.sql.types import StructType

    return map_arrow(work, run, StructType(work.schema.fields[:-1] + StructType.fromDDL(more).fields))


def identify(df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """For each row ``id_col``, held_out, lang_pred, score and like; the label only trains, it is never an input."""
    model = fit(df, id_col, text, label)
    rows = df.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text).alias("__text"))
    return predict(rows, model, "__text").drop("__text")
