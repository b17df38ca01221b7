"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, langid, licenses, line_dedup, merkle, near_dedup, phrases, repeats, secret_scan, simhash, token_files, topk
from .oracle import ORACLE as ORACLE


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.through_files(_table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(_table(spark, sf_dir, "documents"))


def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def spans_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base rules' spans, the digest of their list, and the list of all spans as text."""
    base = [r.kind for r in secret_scan.BASE]
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    own = F.transform(F.filter("spans", lambda x: x["kind"].isin(base)), line)
    return found.select(id_col, *[count(k) for k in base], F.sha2(F.concat_ws(",", own), 256).alias("base_sha256"), F.concat_ws(",", F.transform("spans", line)).alias("spans"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_digest(secret_scan.scan(_table(spark, sf_dir, "documents")))


def fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf_dir, "documents"))


def phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": decontamination,
    "op2_license_scan": license_scan,
    "op3_bpe_round_trip": bpe_round_trip,
    "op4_token_files": token_output,
    "op5_minhash_near_dedup": near_duplicates,
    "op6_exact_top_k": exact_top_k,
    "op7_suffix_array_dedup": repeated_strings,
    "op8_language_id": language_id,
    "op9_secret_scan": secrets,
    "op10_line_dedup": fuzzy_lines,
    "op11_phrase_mining": phrase_mining,
    "op12_merkle_manifest": merkle_manifest,
    "op13_simhash_near_dedup": simhash_groups,
}
