"""Phrase mining, the Merkle manifest and SimHash against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from confluo.llm import merkle, phrases, queries, quotient, simhash, textbuf
from tests.compare import compare, duck

from . import brute
from .test_operators import CLASH, digest, some_docs

PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
MERKLE = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SIMHASH = ("doc_id", "fingerprint", "component_id")


@pytest.mark.parametrize("key", ["op11_phrase_mining", "op12_merkle_manifest"])
def test_queries_match_their_oracles(spark, sf_check, key):
    ok, message = compare(queries.QUERIES[key](spark, sf_check), queries.ORACLE[key], sf_check, duck(sf_check))
    assert ok and not message.startswith("0 rows"), message


def test_hashes_tell_runs_apart():
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), "", "a", "a\0", "aaaaaaaa", "aaaaaaaaa", "aaaaaaaa\0", word + "a"]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    for key in (0, 1):
        assert len(set(textbuf.keyed_hashes(buf, starts, ends, key).tolist())) == len(texts)
    alone = [textbuf.keyed_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0]), np.array([len(t)]))[0] for t in texts]
    assert alone == textbuf.keyed_hashes(buf, starts, ends).tolist()


@pytest.mark.parametrize("n", [2, 3, 4])
def test_filters_lose_nothing(n):
    rng = np.random.default_rng(n)
    for m in (1, 2, 3, 900, 20000):
        packs = rng.integers(0, 2**64, (n, m), dtype=np.uint64)
        packs[:, m // 2 :] = packs[:, : m - m // 2]
        packs[0, : m // 3] = packs[0, 0]  # packs that differ in later lanes only
        mixed = quotient.permuted(packs)
        assert (quotient.restored(mixed) == packs).all()
        counts = rng.integers(1, 2**40, m)
        for lanes in (packs, mixed):
            own, total = quotient.summed(lanes, counts)
            expected = {}
            for k, c in zip(map(tuple, lanes.T.tolist()), counts.tolist(), strict=True):
                expected[k] = expected.get(k, 0) + c
            assert dict(zip(map(tuple, own.T.tolist()), total.tolist(), strict=True)) == expected
            for bits in (0, 3, 12):
                counter = quotient.Counter(n)
                counter.add(lanes, counts)
                back = [quotient.unpacked(f, n, shard, bits) for shard, f in counter.flushed(bits)]
                assert (np.concatenate([b[0] for b in back], axis=1) == own).all() and (np.concatenate([b[1] for b in back]) == total).all()


def phrase_rows():
    rnd = random.Random(3)
    words = ["a", "b", "C", "é", "x-y", "\x85", "d\x1c", "long" * 9]
    rows = [("".join(rnd.choice([*words, " ", " ", "\t", ".", "\n"]) + " " for _ in range(60)), rnd.choice(["en", "fr", "und", None])) for _ in range(120)]
    return rows + [(None, "en"), ("", None), ("one two three four five " * 40, "en"), ("one two three four five " * 40, "en"), (" .. ", "xx")]


@pytest.mark.parametrize("limits", [(1 << 21, 12), (64, 2)])
def test_phrases(spark, monkeypatch, limits):
    """The second limits deal filters in several tiers and flush often."""
    monkeypatch.setattr(phrases, "SHARD", limits[0])
    monkeypatch.setattr(phrases, "TIER", limits[1])
    if limits[0] == 64:
        monkeypatch.setattr(phrases, "Counter", lambda n: quotient.Counter(n, 200))
        monkeypatch.setattr(phrases, "HELD", 20)
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "text string, lang string").select("*", *[F.lit("clash").alias(c) for c in [*CLASH, "ids", "a", "l", "word"]])
    assert digest(phrases.collocations(df), *PHRASE) == brute.phrases(rows)
    assert digest(phrases.collocations(df, least=5, first=7), *PHRASE) == brute.phrases(rows, least=5, first=7)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_phrases_take_another_key_where_words_share_an_id(spark, monkeypatch):
    rows = [("a b a b c " * 20, "en")]
    whole = phrases.keyed_hashes
    monkeypatch.setattr(phrases, "map_arrow", lambda df, run, schema: spark.createDataFrame([tuple(c.as_py() for c in row) for batch in run(df.toArrow().to_batches()) for row in zip(*batch.columns, strict=True)], schema))
    keys = []

    def shared(low, starts, ends, key):
        keys.append(key)
        return whole(low, starts, ends, key) & np.uint64(0 if len(keys) == 1 else 2**64 - 1)

    monkeypatch.setattr(phrases, "keyed_hashes", shared)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert phrases.vocabulary(df)[1] == 1
    assert digest(phrases.vocabulary(df)[0], "word", "n") == [("a", 40), ("b", 40), ("c", 20)]


def manifest_rows():
    rnd = random.Random(9)
    rows = [(k, f"s{k % 3}", rnd.choice(["en", "fr", "Zz", "é", None, ""]), rnd.choice([None, k, -k]), rnd.choice([None, "", "é" * k, "x"])) for k in range(140)]
    return rows + [(None, None, None, None, None), (5, "s", "en", 3, "t"), (5, "s", "en", 3, "t"), (5, "s", "en", 4, "t"), (-7, "s", "alone", 2**62, "y")]


@pytest.mark.parametrize("levels", [12, 1, 2])
def test_manifest(spark, levels):
    """Blocks of two and four nodes make many tiers."""
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    for rows in (manifest_rows(), manifest_rows()[-1:]):
        df = spark.createDataFrame(rows, schema).select("*", *[F.lit("clash").alias(c) for c in ["id", "g", "pos", "m", "node", "block", "leaf", "root", "path"]])
        assert digest(merkle.manifest(df, levels=levels), *MERKLE) == brute.merkle(rows)
    assert merkle.manifest(spark.createDataFrame([], schema), levels=levels).count() == 0


def test_manifest_writes_its_rows_once(spark, monkeypatch):
    """Each file that a task writes costs a call of the file system; the numbered leaves needn't be written again."""
    names, once = [], merkle.written
    monkeypatch.setattr(merkle, "written", lambda df, name: names.append((name, "changed" in df.columns)) or once(df, name))
    df = spark.createDataFrame(manifest_rows(), "doc_id long, source string, lang string, n_chars long, text string")
    assert digest(merkle.manifest(df), *MERKLE) == brute.merkle(manifest_rows())
    assert [name for name, leaves in names if leaves] == ["numbered"]


def test_versions_share_what_did_not_change():
    nodes = [brute.sha(str(k)) for k in range(13)]
    tree = merkle.Block(list(nodes), 13)
    before = [list(level) for level in tree.levels]
    new = tree.version(6, brute.sha("other"))
    changed = merkle.Block(nodes[:6] + [brute.sha("other")] + nodes[7:], 13)
    assert tree.levels == before and len(new) == len(tree.levels)
    assert [level[6 >> k] for k, level in enumerate(changed.levels)] == new
    assert all(a == b for x, y in zip(tree.levels, changed.levels, strict=True) for k, (a, b) in enumerate(zip(x, y, strict=True)) if b not in new)


def test_simhash(spark, sf_small):
    rows = some_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("clash").alias(c) for c in [*CLASH, "fp", "path"]])
    assert digest(simhash.components(df), *SIMHASH) == brute.simhash(rows)
    assert simhash.components(df.limit(0)).count() == 0
    whole = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert digest(simhash.components(whole), *SIMHASH) == brute.simhash([tuple(r) for r in whole.select("doc_id", "text").collect()])


def some_prints():
    """Random numbers, chains of near ones, and a dense ball."""
    rnd = random.Random(5)
    out = {rnd.getrandbits(64) for _ in range(800)}
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(12):
            x ^= sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 6)))
            out.add(x)
    centre = rnd.getrandbits(64)
    out |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(9))) for _ in range(900)}
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("most", [1 << 12, 40])
def test_no_link_between_fingerprints_is_lost(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "MOST", most)  # the second deals buckets again
    prints = some_prints()
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    union = brute.Union(len(prints))
    for a, b in simhash.linked(df).collect():
        x, y = (np.searchsorted(prints, np.array([v], np.int64).view(np.uint64))[0] for v in (a, b))
        assert int(prints[x] ^ prints[y]).bit_count() <= 4
        union.join(int(x), int(y))
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= 4).tolist():
            assert union.top(i) == union.top(j)


def test_the_table_discards_far_pairs():
    prints = np.random.default_rng(1).integers(0, 2**64, 1500, dtype=np.uint64)
    table = simhash.distances(prints.view(np.int64))
    order = np.argsort(table[:, 0], kind="stable")
    seen = [0, 0, 0]
    simhash.near(prints[order], np.zeros(1500, np.int64), table[order], 4, seen)
    assert seen[0] > 500_000 and seen[1] < seen[0] / 1e5
    gap = (table[:1].astype(int) - table[1:].astype(int)).astype(int)
    assert ((gap**2).sum(1) == 64 * np.bitwise_count(prints[0] ^ prints[1:])).all()
