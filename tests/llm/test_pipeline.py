"""The pipeline against its stages in plain Python, and the SQL of the llm queries."""

from __future__ import annotations

import pytest

import corpus_pipeline
from confluo.llm.queries import ORACLE, QUERIES
from tests.compare import compare, duck

from . import brute


def test_pipeline(spark, sf_small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    docs = [r for r in docs if any(c.isalpha() for c in r[1] or "")]
    gone = {r[0]: {int(x) for x in r[3].split(",") if x} for r in brute.lines(docs)}
    cut = [(d, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d])) for d, t in docs]
    docs = [r for r in cut if not gone[r[0]] or any(x.strip(" ") for x in r[1].split("\n"))]
    kept = {r[0] for r in brute.near_duplicates(docs, size=5) if r[3]}
    docs = [r for r in docs if r[0] in kept]
    dirty = {r[0] for r in brute.decontamination(docs, bench) if r[5]}
    docs = [r for r in docs if r[0] not in dirty]
    got = corpus_pipeline.run(spark, sf_small)
    assert brute.in_order(got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == brute.bpe(docs)


def test_stages_keep_the_columns(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_small).columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_small).count() == 0, name


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_sql(spark, sf_check, key):
    ok, said = compare(QUERIES[key](spark, sf_check), ORACLE[key], sf_check, duck(sf_check))
    assert ok, said
