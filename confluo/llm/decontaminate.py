"""Benchmark decontamination, in DataFrame functions only.

Every benchmark item becomes windows of ``SIZE`` consecutive words (an item of fewer words is one window). The distinct
windows, hashed, are the hash set; each document is split into words once, every word position gives the hash of the
words from there on, and a hash join followed by a comparison of the words themselves finds the hits. The set is
broadcast if its measured size is within ``BROADCAST_BYTES``; a larger one is joined by shuffle, with the same result.

The empty window is a member of the set and stands at the end of each document, so that a document without hits also
gives one row. Words are runs of ASCII letters, digits and non-ASCII characters; only A-Z are lower-cased. A null or
empty text has no words and is clean. Rows with the same id and text are one document, and each of them is returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

SIZE = 10
BROADCAST_BYTES = 64 << 20
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words(text: Column) -> Column:
    """The words of a text, in order; of a null text, none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _SMALL), f"{_APART}+"), "")


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Distinct windows: ``words``, their hash ``key``, their number ``len`` and the ``items`` (as text) that hold them."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("all")).filter(F.size("all") > 0)
    rows = rows.select("item", "all", F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - size + 1, F.lit(1)))).alias("at"))
    rows = rows.select("item", F.slice("all", F.col("at"), size).alias("words"))
    return rows.groupBy("words").agg(F.collect_set("item").alias("items")).select(F.xxhash64("words").alias("key"), F.size("words").alias("len"), "words", "items")


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """One row for each document (id, hash of its text): ``n_rows``, ``n_words``, ``n_hit`` and the sorted ``items``."""
    grams = windows(benchmark, item, item_text, size)
    about = grams.agg(F.coalesce(F.sum(F.length(F.concat_ws(" ", "words")) + F.length(F.concat_ws(" ", "items")) + 24 * F.size("words") + 64), F.lit(0)).alias("bytes"), F.collect_set("len").alias("lens")).first()
    small = about["bytes"] <= BROADCAST_BYTES
    none = docs.sparkSession.range(1).select(F.array().cast("array<string>").alias("words"), F.array().cast("array<string>").alias("items")).select(F.xxhash64("words").alias("key"), F.lit(0).alias("len"), "words", "items")
    split = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("hash"), words(F.col(text)).alias("all"))
    found = []
    for length in sorted({size, *about["lens"]}, reverse=True):
        last = F.size("all") - (0 if small and length == size else length)
        at = split if small and length == size else split.filter(F.size("all") >= length)
        at = at.select("id", "hash", "all", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        part = F.slice("all", F.col("at") + 1, length)
        own = grams.filter(F.col("len") == length) if length < size else grams
        own = F.broadcast(own.unionByName(none) if length == size else own) if small else own.hint("merge")
        if not small:
            at, part = at.select("id", "hash", "at", part.alias("part")), F.col("part")
        # the hash alone is the join's key, a plain number; the words are compared only where hashes meet
        got = at.join(own, (F.xxhash64(part) == F.col("key")) & (part >= F.col("words")) & (part <= F.col("words")))
        found.append(got.select("id", "hash", "at", "len", "items"))
    if not small:
        found.append(split.select("id", "hash", F.size("all").alias("at"), F.lit(0).alias("len"), F.lit(None).cast("array<string>").alias("items")))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    end = F.col("len") == 0
    span = F.when(~end, F.struct("at", "len"))
    seen = rows.groupBy("id", "hash").agg(F.count_if(end).alias("n_rows"), F.max(F.when(end, F.col("at"))).cast("long").alias("n_words"), F.sort_array(F.collect_set(span)).alias("spans"), F.collect_set(F.when(~end, F.col("items"))).alias("sets"))

    def cover(state: Column, x: Column) -> Column:
        to = x["at"] + x["len"]
        return F.struct(F.greatest(state["end"], to).alias("end"), (state["n"] + F.greatest(F.lit(0), to - F.greatest(state["end"], x["at"]))).alias("n"))

    covered = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), cover, lambda s: s["n"].cast("long"))
    return seen.select(F.col("id").alias(id_col), F.col("hash"), "n_rows", "n_words", covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"), "spans")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """For each row of ``docs``: its id, n_words, n_hit, the items found and whether it is contaminated."""
    found = hits(docs, benchmark, id_col, text, item, item_text, size)
    rows = found.withColumn("row", F.explode(F.array_repeat(F.lit(1), F.col("n_rows").cast("int"))))
    return rows.select(id_col, "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` without the contaminated rows; all columns as they were. The contaminated ids are written first, so the
    planner knows their size when it joins them, and broadcasts them only if they are few."""
    bad = hits(docs, benchmark, id_col, text, item, item_text, size).filter(F.col("n_hit") > 0)
    bad = written(bad.select(F.col(id_col).alias("__id"), F.col("hash").alias("__hash")), "contaminated")
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__hash")), "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with each hit word, and what stands between it and the next word, cut from the text; columns as they were."""
    bad = hits(docs, benchmark, id_col, text, item, item_text, size).filter(F.col("n_hit") > 0)
    bad = written(bad.select(F.col(id_col).alias("__id"), F.col("hash").alias("__hash"), F.col("spans").alias("__spans")), "contaminated")
    word = _APART.replace("[", "[^", 1)
    lead = F.regexp_extract(F.col(text), f"^{_APART}*", 0)
    units = F.regexp_extract_all(F.col(text), F.lit(f"{word}+{_APART}*"), F.lit(0))
    kept = F.filter(units, lambda u, i: ~F.exists("__spans", lambda s: (i >= s["at"]) & (i < s["at"] + s["len"])))
    new = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(F.concat(lead, F.array_join(kept, "")))
    rows = docs.join(bad, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__hash")), "left")
    return rows.select(*[new.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns])
