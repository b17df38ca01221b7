"""Phrase collocations, counted exactly in counting quotient filters.

Texts (A-Z lower-cased) are cut into pieces at ``.,;:!?`` and line breaks, pieces into words at blanks and tabs; all counts
are per language (null: ``und``). A word's id is a 64-bit hash of language and word that is checked to be one-to-one over
the whole vocabulary (another key is taken if not), so no table of words goes to the tasks.

Phrases are counted by length. A phrase that occurs often enough holds only words and shorter phrases that do, so each
pass counts just those whose parts may: bitmaps of fixed size, which miss none, tell. A task packs the ids of each phrase,
permutes the pack and counts it in a filter (see ``quotient``); filters go out by shard, in tiers of ``TIER`` bits, and those of
a shard are merged. A phrase, however frequent, is one entry of a filter, and shards are even, whatever the text.

A null or empty text has no words. Rows that repeat an id all count. Ids and other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quotient import Counter, permuted, restored, summed, unpacked
from .shared import bitmap, in_bitmap, map_arrow, ship, written
from .textbuf import LOWER, blocks, keyed_hashes, mix, spans, utf8

LONGEST = 4
#: Entries of a shard on the average at most, and bits by which filters are dealt at a time.
SHARD, TIER = 1 << 21, 12
#: Different words that a task holds at once, and bits of the largest bitmap (16 MB).
HELD, MOST_BITS = 1 << 18, 27

#: Bytes that end a piece, and those that part words.
CUT = np.zeros(256, bool)
CUT[[*b".,;:!?\n\x0b\x0c\r"]] = True
APART = CUT.copy()
APART[[9, 32]] = True


class Words:
    """The words of a block of texts: spans in ``low``, ``row``, ``piece`` (equal within a piece only) and ``ids``."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, langs: np.ndarray, key: int):
        self.low, self.rows = LOWER[buf], len(langs)
        self.starts, self.ends, bounds = spans(APART[self.low], offs)
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(bounds))
        self.piece = (np.cumsum(CUT[self.low]) if len(buf) else np.zeros(0, np.int64))[self.starts] + self.row
        self.ids = keyed_hashes(self.low, self.starts, self.ends, mix(langs.view(np.uint64) + np.uint64(key))[self.row])


    def more(self, langs: np.ndarray, key: int) -> np.ndarray:
        """Another hash of each word and its language, to tell words apart that share an id."""
        return keyed_hashes(self.low, self.starts, self.ends, mix(langs.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D + key))[self.row])


def _distinct(ids: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the different words (ids, and what tells apart those that share one), the first place of each, and each place's word."""
    _, first, back = np.unique(ids, return_index=True, return_inverse=True)
    if (more[first][back] != more).any():
        _, first, back = np.unique(np.stack([ids, more]), axis=1, return_index=True, return_inverse=True)
    return first, back.ravel()


def _words(batch: pa.RecordBatch, key: int):
    """Blocks of a batch of (language's hash, text), with each block's first row."""
    buf, offs = utf8(batch.column(1))
    langs = batch.column(0).to_numpy()
    for a, b in blocks(offs):
        yield a, Words(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a], langs[a:b], key)


def _language(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("und"))


def _vocabulary(df: DataFrame, text: str, lang: str, key: int) -> DataFrame:
    """(id, lang, word, n, same): all words; ``same`` is false where words share an id."""

    def run(batches):
        held = []

        def merged():
            ids, more, n = (np.concatenate([h[k] for h in held]) for k in (0, 1, 4))
            first, back = _distinct(ids, more)
            words, langs = (pa.concat_arrays([h[k] for h in held]).take(pa.array(first)) for k in (2, 3))
            return ids[first], more[first], words, langs, np.bincount(back, n, len(first)).astype(np.int64)

        def out():
            ids, _, words, langs, n = held[0]
            return pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), langs, words.cast(pa.string()), pa.array(n)], names=["id", "lang", "word", "n"])

        for batch in batches:
            for a, w in _words(batch, key):
                more = w.more(batch.column(0).to_numpy()[a : a + w.rows], key)
                first, back = _distinct(w.ids, more)
                words = pa.array([w.low[s:e].tobytes() for s, e in zip(w.starts[first].tolist(), w.ends[first].tolist(), strict=True)], pa.large_binary())
                held.append((w.ids[first], more[first], words, batch.column(2).take(pa.array(a + w.row[first])).cast(pa.large_string()), np.bincount(back, minlength=len(first))))
                if sum(len(h[0]) for h in held) > HELD:
                    held = [merged()]
                    if len(held[0][0]) > HELD // 2:
                        yield out()
                        held = []
        if held:
            held = [merged()]
            yield out()

    each = map_arrow(df.select(F.xxhash64(_language(lang)), text, _language(lang).alias("lang")), run, "id long, lang string, word string, n long")
    name = F.struct("lang", "word")
    all_of = each.groupBy("id").agg(F.min(name).alias("name"), F.max(name).alias("last"), F.sum("n").alias("n"))
    return written(all_of.select("id", "name.lang", "name.word", "n", (F.col("name") == F.col("last")).alias("same")), "vocabulary")


def vocabulary(df: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, int]:
    """All words (id, lang, word, n), with the key that gives each its own id."""
    for key in range(8):
        found = _vocabulary(df, text, lang, key)
        if found.filter(~F.col("same")).isEmpty():
            return found.drop("same"), key
    raise RuntimeError("words share 64-bit ids under every key")


def _map_of(names: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the frequent names, of 8 to 16 bits a name up to the largest one."""
    return bitmap(names, column, min(MOST_BITS, max(16, (8 * names.count()).bit_length())))


def _counted(df: DataFrame, n: int, key: int, words: np.ndarray, below: np.ndarray | None, bits: int, text: str, lang: str) -> DataFrame:
    """(shard, filter) of the phrases of ``n`` words whose words, and phrases of n - 1 words, may be frequent."""

    def run(batches):
        counter = Counter(n)

        def out():
            found = counter.flushed(bits)
            return pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int64()), pa.array([f for _, f in found], pa.binary())], names=["shard", "filter"])

        for batch in batches:
            for _, w in _words(batch, key):
                good = in_bitmap(words, w.ids.view(np.int64))
                own = max(len(good) - 1, 0)
                at = np.flatnonzero(good[:own] & good[1:] & (w.piece[:own] == w.piece[1:]))
                for size in range(3, n + 1):  # from places of frequent phrases of size - 1 words to those of size words
                    if size == n:
                        at = at[in_bitmap(below, permuted(np.stack([w.ids[at + k] for k in range(n - 1)]))[0].view(np.int64))]
                    at = at[:-1][np.diff(at) == 1]
                if len(at) and counter.add(permuted(np.stack([w.ids[at + k] for k in range(n)]))):
                    yield out()
        yield out()

    return map_arrow(df.select(F.xxhash64(_language(lang)), text), run, "shard long, filter binary")


def _redealt(filters: DataFrame, n: int, had: int, bits: int) -> DataFrame:
    """Filters of shards of ``had`` bits, merged as they come and dealt by ``bits`` bits."""

    def run(batches):
        counter, own = Counter(n), None

        def out():
            found = counter.flushed(bits)
            return pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int64()), pa.array([f for _, f in found], pa.binary())], names=["shard", "filter"])

        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if own not in (None, shard):
                    yield out()
                own = shard
                if counter.add(*unpacked(data.as_py(), n, shard, had)):
                    yield out()
        yield out()

    dealt = filters.repartition("shard", F.pmod(F.xxhash64("filter"), F.lit(16))).sortWithinPartitions("shard")
    return map_arrow(dealt, run, "shard long, filter binary")


def _merged(filters: DataFrame, n: int, bits: int, least: int) -> DataFrame:
    """(ids, lane, a): the phrases that occur ``least`` times or more."""

    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        parts = [unpacked(f.as_py(), n, shard, bits) for f in table["filter"]]
        lanes, counts = summed(np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts]))
        lanes, counts = lanes[:, counts >= least], counts[counts >= least]
        ids = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * n), pa.array(np.ascontiguousarray(restored(lanes).T).ravel().view(np.int64)))
        return pa.table({"ids": ids, "lane": lanes[0].view(np.int64), "a": counts})

    ship(filters.sparkSession)
    return filters.groupBy("shard").applyInArrow(run, "ids array<bigint>, lane long, a long")


def frequent(df: DataFrame, words: DataFrame, key: int, least: int, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> DataFrame:
    """(ids, a): all phrases of 2 to ``longest`` words that occur ``least`` times or more, from the vocabulary ``words``."""
    total = words.agg(F.sum("n")).first()[0] or 0
    bits, common = (total // SHARD).bit_length(), _map_of(words.filter(F.col("n") >= least), "id")
    below, out = None, None
    for n in range(2, longest + 1):
        had = min(bits, TIER)
        filters = written(_counted(df, n, key, common, below, had, text, lang), "filters")
        while had < bits:
            filters, had = written(_redealt(filters, n, had, min(bits, had + TIER)), "filters"), min(bits, had + TIER)
        found = written(_merged(filters, n, had, least), "phrases")
        out = found.select("ids", "a") if out is None else out.unionByName(found.select("ids", "a"))
        if n < longest:
            below = _map_of(found, "lane")
    return out


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def _inner(ids: str, longest: int) -> Column:
    """The contiguous parts of two words or more, shorter than the whole."""

    def parts(m: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(ids) - m + 1), lambda s: F.slice(ids, s, m))
        return F.when(F.size(ids) > m, every).otherwise(F.array().cast("array<array<bigint>>"))

    return F.flatten(F.array(*[parts(m) for m in range(2, longest)]))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, percent: int = 80, first: int = 2000, longest: int = LONGEST) -> DataFrame:
    """Each language's ``first`` phrases by score, then a, both descending, then phrase: lang, rank, phrase, a, l, r, n, score.

    A phrase's a is how often it occurs (``least`` or more); cut after k words its parts occur l and r times, and the
    score is 2000000 * a / (l + r), floored, of the lowest-scoring cut (of like ones, the first). Phrases that lie in a longer
    one with ``percent`` of their occurrences or more are left out. n is the number of the language's words."""
    words, key = vocabulary(df, text, lang)
    phrases = written(frequent(df, words, key, least, longest, text, lang), "candidates")
    known = phrases.unionByName(words.filter(F.col("n") >= least).select(F.array("id").alias("ids"), F.col("n").alias("a")))
    inner = phrases.filter(F.size("ids") > 2).select(F.explode(_inner("ids", longest)).alias("ids"), F.col("a").alias("top"))
    held = phrases.join(inner.groupBy("ids").agg(F.max("top").alias("top")), "ids", "left")
    held = held.filter(F.col("top").isNull() | (_wide("top") * 100 < _wide("a") * percent)).drop("top")
    cuts = held.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail"))
    cuts = cuts.join(known.select(F.col("ids").alias("head"), F.col("a").alias("l")), "head").join(known.select(F.col("ids").alias("tail"), F.col("a").alias("r")), "tail")
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.withColumn("score", score).groupBy("ids").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("best")).select("ids", "best.*")
    scored = scored.join(words.select("id", "lang"), F.col("ids")[0] == F.col("id")).drop("id", "k")
    order = [F.desc("score"), F.desc("a")]
    near = written(scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= first).drop("place"), "ranked")
    each = near.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelt = each.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("all")).select("ids", F.concat_ws(" ", F.col("all.word")).alias("phrase"))
    out = near.join(spelt, "ids").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")).filter(F.col("rank") <= first)
    return out.join(words.groupBy("lang").agg(F.sum("n").alias("n")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
