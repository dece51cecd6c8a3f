"""Conversation trie, exact dedup and divergence audit on awkward tables, against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendscope.llm import divergence, exact_dedup, prefix_trie, skew
from lendscope.llm.perfect_hash import PerfectHash, string_hashes
from lendscope.llm.queries import QUERIES
from lendscope.operators import shared_storage

from . import brute_groups as brute

TURNS = "conv_id long, turn long, role string, text string"


def _trie(df, **options):
    got = prefix_trie.conversation_trie(df, **options)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(5)
    rows = []
    for c in range(-12, 45):
        if c % 7 == 3:
            continue  # some groups have no first conversation
        rows += [(c, t, rng.choice(["user", "bot", None]), rng.choice(["a", "b", "é" * 40, "", None])) for t in range(rng.choice([0, 1, 2, 5, 9, 14]))]
    rows += [(50 + k, t, "user", f"same {t}") for k in range(5) for t in range(30)]  # copies and a long common stretch
    rows += [(60, t, "user", f"long {t}") for t in range(300)]  # a long unary chain
    rows += [(61, None, "user", "null first"), (61, 3, "user", "tie one"), (61, 3, "user", "tie two"), (61, 3, "user", "tie two"), (61, -1, "bot", "x")]
    rows += [(None, 1, "user", "nobody's"), (62, 1, None, None), (63, 1, "", ""), (64, 1, "ab", "c"), (65, 1, "a", "bc"), (66, 1, "user", "y" * 70_000)]
    rng.shuffle(rows)
    return rows


def test_trie(spark, turns):
    df = spark.createDataFrame(turns, TURNS).withColumn("depth", F.lit("clash")).withColumn("place", F.lit(1)).withColumn("a.b", F.lit(2))
    assert _trie(df.repartition(5)) == brute.trie(turns)


def test_trie_in_small_ranges(spark, turns, monkeypatch):
    """Conversations over many ranges and runs, hot parents and chain ends, pieces of ids: the same rows."""
    for module, name, value in ((prefix_trie, "RANGE_ROWS", 20), (prefix_trie, "CHUNK_TURNS", 7), (prefix_trie, "PIECE_BYTES", 8),
                                (skew, "HOT_ROWS", 3), (skew, "HOT_SHARE", 10_000)):
        monkeypatch.setattr(module, name, value)
    assert _trie(spark.createDataFrame(turns, TURNS).repartition(9)) == brute.trie(turns)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(7, 1, "user", "x")], [(7, 1, None, None)] * 20])
def test_trie_of_little(spark, rows):
    assert _trie(spark.createDataFrame(rows, TURNS)) == brute.trie(rows)


def test_subtree_totals(spark):
    """Random trees, a star, a path and a comb against sums from the leaves up."""
    rng = random.Random(1)
    shapes = [[(i, rng.randrange(max(0, i - k), i)) for i in range(1, 120)] for k in (1, 2, 9, 120)]
    shapes += [[(i, 0) for i in range(1, 200)], [(i, i - 1 if i % 2 else max(i - 2, 0)) for i in range(1, 101)]]
    rows, expected = [], {}
    for depth, shape in enumerate(shapes):
        total = {i: [i % 3, i] for i in range(len(shape) + 1)}
        rows += [(i, depth, None if i == 0 else dict(shape)[i], None if i == 0 else depth, *total[i]) for i in total]
        for i, parent in sorted(shape, reverse=True):
            for k in (0, 1):
                total[parent][k] += total[i][k]
        expected |= {(i, depth): tuple(v) for i, v in total.items()}
    df = spark.createDataFrame(rows, "conv long, depth long, parent_conv long, parent_depth long, leaves long, saved long")
    got = {(r[0], r[1]): (r[2], r[3]) for r in prefix_trie.subtree_totals(df).collect()}
    assert got == expected


@pytest.fixture(scope="module")
def copies():
    rows = [(1, "Aa É"), (2, "aA É"), (3, "aa é"), (4, None), (5, ""), (6, " "), (None, "aa É"), (None, "only"), (None, "only"), (7, "x"), (7, "X"), (7, "x"), (7, "y"),
            (8, "long " * 50_000), (9, "LONG " * 50_000), (10, "İı"), (11, "iı"), (-3, ""), (12, "z\0"), (13, "z")]
    return rows + [(100 + i % 40, "Copy") for i in range(200)]


def _exact(got):
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_exact_dedup(spark, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string").withColumns({"body": F.lit(1), "digest": F.lit("d"), "keep_id": F.lit(0), "a.b": F.lit(2)})
    for parts in (1, 40):
        assert _exact(exact_dedup.exact_groups(df.repartition(parts))) == brute.exact(copies)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    wanted = [r[0] for r in brute.exact(copies) if r[3]]
    assert sorted((r[0] for r in kept.collect()), key=repr) == sorted(wanted, key=repr)


def test_exact_dedup_compares_texts(spark, copies, monkeypatch):
    """Digests that many texts share, and hot groups: texts decide."""
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(7)

    def weak(body):
        return F.unhex(F.hex(F.length(body) % 3))

    assert _exact(exact_dedup.exact_groups(df, weak)) == brute.exact(copies)


def test_exact_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


def test_exact_dedup_is_native(spark, copies, monkeypatch):
    """Neither the result nor any table on the way uses Python workers."""
    plans = []
    written = shared_storage.cut_lineage
    monkeypatch.setattr(exact_dedup, "written", lambda df: plans.append(df._jdf.queryExecution().toString()) or written(df))
    plans.append(exact_dedup.exact_groups(spark.createDataFrame(copies, "doc_id long, text string"))._jdf.queryExecution().toString())
    assert len(plans) >= 4 and not [p for p in plans if any(x in p for x in ("Python", "Arrow", "Pandas"))]


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(3)
    words = ["red", "Blue", "grün", "日本", "x" * 300, "Don't", "a-b", "42nd", "é", "İ", "tail"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(1, 60))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "", None, "ß"])) for _ in range(300)]
    rows += [(None, "en", "s1"), ("", "en", "none"), ("42 17 _", "en", "digits"), ("rare word", "xx", "a"), (None, "xx", "b"), ("rare", "yy", "one"), ("red " * 9_000, "en", "long")]
    return rows


def _divergence(df, **options):
    got = divergence.source_divergence(df, **options)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    return sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence(spark, sources):
    df = spark.createDataFrame(sources, "text string, lang string, source string").withColumns({"shard": F.lit(1), "term": F.lit("t"), "n": F.lit(0), "a.b": F.lit(2)})
    assert _divergence(df) == brute.divergence(sources)


def test_divergence_in_pieces(spark, sources):
    """A term or two per shard, one hash per pass, counters sent early: the same rows."""
    df = spark.createDataFrame(sources, "text string, lang string, source string")
    assert _divergence(df, least=3, top=2, shard_terms=2, most_bytes=400, counters=10) == brute.divergence(sources, 3, 2)


def test_divergence_of_nothing(spark):
    assert _divergence(spark.createDataFrame([], "text string, lang string, source string")) == []


def test_shares_are_exact():
    for total, terms, counts in ((0, 1, [0]), (7, 3, [0, 2, 5]), (8_999_999_999_999, 10_000, [0, 1, 123_456_789, 8_999_999_999_999])):
        expected = [1 + 1_000_000_000 * (c + 5) // (total + 5 * terms) for c in counts]
        assert divergence.shares(np.array(counts, np.int64), total, terms).tolist() == expected


def test_perfect_hash():
    keys = [f"key {i}".encode() for i in range(5_000)] + [b"a", b"b" * 1_000, "é".encode()]
    table = PerfectHash.load(PerfectHash.build(pa.array(keys, pa.large_binary())).dump())
    asked = pa.array([*keys, b"unknown", b"key 5000"], pa.large_binary())
    slots = table.find(asked)
    assert sorted(slots[:-2].tolist()) == list(range(len(keys))) and slots[-2:].tolist() == [-1, -1]
    assert [table.keys[i].as_py() for i in slots[:-2].tolist()] == keys
    assert len(PerfectHash.load(PerfectHash.build(pa.array([], pa.large_binary())).dump()).keys) == 0


def test_perfect_hash_verifies_keys(monkeypatch):
    """A stranger that falls on a key's slot is not taken for it."""
    table = PerfectHash.build(pa.array([b"one", b"two"], pa.large_binary()))
    strangers = pa.array([f"s{i}".encode() for i in range(200)], pa.large_binary())
    assert len(string_hashes(strangers, 0)) == 200 and (table.find(strangers) == -1).all()


def test_terms():
    terms, sizes = divergence.split_terms(pa.array(["A-b", None, "", "Zé 9日本x\x00y", "[`{~"]))
    assert [t.decode() for t in terms.to_pylist()] == ["a", "b", "zé", "日本x", "y"] and sizes.tolist() == [2, 0, 0, 3, 0]


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_exact_dedup", "op13_source_divergence"])
def test_queries_are_registered(spark, small_dir, name):
    assert QUERIES[name](spark, small_dir).count() > 0
