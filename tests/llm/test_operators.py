"""Each operator on small tables with every awkward row, against plain Python."""

import hashlib
import math
import os
import random
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import fingerprints, html_text, language_model, line_dedup, mixing, near_dedup, nearest, packing, quality, substring_dedup
from lendscope.llm.queries import QUERIES, vocabulary
from lendscope.llm.tables import table, written

from . import brute

DOCS = "doc_id long, text string, source string"


def _prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("the of Über and river stone light, walk under. quick brown ten é".split()) + rng.choice(["", "s", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base, other = _prose(120, 1), _prose(200, 2)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    return {
        1: base, 2: None, 3: "", 4: " \t\n ", 5: _prose(30_000, 3), 6: "a B c", 7: base, 8: near, 9: "A b  c", 10: other,
        11: other[:200] + " " + base, 12: "one\ntwo\none", 13: base.upper(), 14: near + " tail words here", 15: "word",
        16: _prose(45, 9) + " " + _prose(45, 9), 17: "日本 語 " * 30, 18: "x" * 5000,
    }


@pytest.fixture(scope="module")
def documents(spark, texts):
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}") for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCS).withColumn("a.b", F.lit(1)).withColumn("host", F.lit("h")).withColumn("lines", F.lit("l"))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def _by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def test_line_dedup(spark, nothing):
    rows = [("h", "menu\nbody 1\r\nmenu"), ("h", " menu \nbody 2"), ("h", None), ("h", ""), (None, "menu\nx"), (None, "menu"), ("g", "menu\nonly"), ("h", "menu\nbody 1")]
    df = spark.createDataFrame([(i, *r, "k", 7) for i, r in enumerate(rows)], "doc_id long, source string, text string, host string, n_lines long")
    got = line_dedup.drop_boilerplate(df, ratio=0.5, min_pages=2)
    assert got.columns == ["doc_id", "source", "text", "host", "n_lines", "n_dropped"]
    assert [tuple(r) for r in got.orderBy("doc_id").select("text", "n_lines", "n_dropped").collect()] == brute.without_boilerplate(rows, 0.5, 2)
    assert line_dedup.drop_boilerplate(nothing).count() == 0


def test_quality_learns(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = QUERIES["op2_quality"](spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    rows = scored.where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert len(bad) > 3
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in scored.collect())


def test_quality_of_odd_rows(spark, documents, nothing):
    df = documents.withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 19)] + [(1, 0), (2, None), (None, 1), (3, 7), (99, 1)], "doc_id long, quality int")
    got = quality.quality_scores(df, labels)
    assert got.columns == [*documents.columns, "score", "held_out", "predicted"]
    scores = {r.doc_id: r.score for r in got.collect()}
    assert len(scores) == 18 and all(0 <= s <= 1 for s in scores.values())
    assert scores[2] == scores[3] == scores[4] and scores[1] == pytest.approx(scores[7], abs=1e-6)
    assert quality.quality_scores(nothing, labels).count() == 0
    no_labels = quality.quality_scores(df, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in no_labels] == [0.5]
    assert quality.good_documents(df, labels.limit(0)).columns == df.columns


@pytest.mark.parametrize("block", [512, 2])
def test_near_duplicates(spark, documents, texts, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "F", near_dedup.F)
    family = {100 + k: " ".join(w if (j * 7 + k * 3) % 11 else f"e{k}" for j, w in enumerate(texts[1].split())) for k in range(12)}
    rows = {**texts, **family}
    df = documents.select("doc_id", "text").union(spark.createDataFrame(list(family.items()), "doc_id long, text string"))
    assert _by_id(near_dedup.near_duplicates(df), "n_shingles", "component_id", "kept") == brute.near_duplicates(rows)


def test_near_duplicates_of_repeated_rows(spark, nothing, texts):
    df = spark.createDataFrame([(5, texts[1]), (5, texts[1]), (5, "other"), (3, texts[8]), (None, texts[1]), (None, "lonely")], "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(df).select("doc_id", "component_id", "kept").collect()), key=str)
    assert got == sorted([(5, 3, False), (5, 3, False), (5, 3, False), (3, 3, True), (None, 3, False), (None, None, False)], key=str) or \
        got == sorted([(5, 3, False), (5, 3, False), (5, 5, True), (3, 3, True), (None, 3, False), (None, None, False)], key=str)
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>One &amp; two.</p></article>", "x"), (2, None, None, "y"), (2, None, "", "y"), (None, "v", "<nav>n</nav>", "z")],
                               "page_id long, url string, html string, text string")
    got = html_text.extract_text(df)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted(map(tuple, got.select("page_id", "text", "n_chars").collect()), key=str) == sorted([(1, "One & two.", 10), (2, "", 0), (2, "", 0), (None, "", 0)], key=str)
    assert html_text.extract_text(df.limit(0)).count() == 0


class _Article(HTMLParser):
    """Text of article elements by the standard parser, without what stands in navigation, adverts and the like."""

    def __init__(self):
        super().__init__()
        self.open, self.blocks = [], []

    def handle_starttag(self, tag, attributes):
        if tag in ("p", "li", "h1", "h2", "div", "ul", "article"):
            self.blocks.append("")
        if tag == "br":
            self.blocks.append(self.blocks.pop() + "\n")
        elif tag != "meta":
            self.open.append((tag, dict(attributes).get("class")))

    def handle_endtag(self, tag):
        if tag in [t for t, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass
            if tag in ("p", "li", "h1", "h2", "div", "ul", "article"):
                self.blocks.append("")

    def handle_data(self, data):
        tags = {t for t, _ in self.open}
        if "article" in tags and not tags & {"nav", "script", "style", "footer"} and "ad" not in {c for _, c in self.open} and self.blocks:
            self.blocks[-1] += data


def test_html_against_the_standard_parser(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        parser = _Article()
        parser.feed(r.html)
        parser.close()
        assert got[r.page_id] == " ".join(" ".join(b.split()) for b in parser.blocks if b.split()), r.page_id


@pytest.mark.parametrize("window", [20, 5, 3])
def test_repeats(documents, texts, window):
    got = substring_dedup.remove_repeats(documents, window)
    assert _by_id(got, "n_words", "n_removed", "text") == brute.without_repeats(texts, window)
    runs = {r.doc_id: r.removed for r in got.collect()}
    assert runs[7] == [0, 120] and runs[1] == [] and sum(runs[16][1::2]) - sum(runs[16][::2]) >= 45


def test_repeats_of_odd_rows(spark, nothing, texts):
    df = spark.createDataFrame([(4, texts[1]), (4, texts[1]), (4, texts[10]), (None, texts[10]), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect())
    assert got == sorted([("4", 120, 0), ("4", 120, 0), ("4", 200, 200), ("None", 200, 0), ("None", 0, 0)])
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_language_model(spark, documents, texts, nothing):
    got = _by_id(language_model.score(documents), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    want = brute.unigram_scores(texts)
    assert {i: g[:4] for i, g in got.items()} == {i: w[:4] for i, w in want.items()}
    assert all(math.isclose(got[i][4], want[i][4], rel_tol=1e-9) for i in want)
    assert all(math.isfinite(g[5]) and g[5] < 0 for g in got.values())
    assert sum(g[5] for g in got.values()) > sum(g[4] for g in got.values())
    assert got[2][4:] == got[3][4:] == got[4][4:]
    assert language_model.score(nothing).count() == 0
    held = spark.createDataFrame([(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2] * 2, "doc_id long, text string")
    assert {(r.train_tokens, r.base_score, r.score) for r in language_model.score(held).collect()} == {(0, 0.0, 0.0)}


def test_language_model_keeps_every_ngram(spark, monkeypatch):
    rng = random.Random(8)
    rows = {i: " ".join(rng.choice(["a b c", "b c d", "a c", "d", f"x{rng.randint(0, 60)}"]) for _ in range(rng.randint(0, 40))) for i in range(120)}
    df = spark.createDataFrame([*rows.items(), (None, "a b c x1 new")], "doc_id long, text string").repartition(3)
    want = brute.backoff_scores({**rows, None: "a b c x1 new"})
    for run_tokens in (1_000_000, 200):
        monkeypatch.setattr(language_model, "RUN_TOKENS", run_tokens)
        monkeypatch.setattr(language_model, "PART_BYTES", 1_000)
        assert _by_id(language_model.score(df), "score") == {i: (pytest.approx(w, rel=1e-9),) for i, w in want.items()}
    # An n-gram seen twice among many is not forgotten: its repeat outweighs its words.
    often = [(i, "the " * 4000) for i in range(40)] + [(i, f"one two three four five w{i}") for i in range(40, 60)]
    scores = {i: s for i, (s,) in _by_id(language_model.score(spark.createDataFrame(often, "doc_id long, text string")), "score").items()}
    assert scores == {i: pytest.approx(w, rel=1e-9) for i, w in brute.backoff_scores(dict(often)).items()}


def test_language_model_sends_hashes_in_waves(spark, monkeypatch):
    """All hashes and all runs in one shuffle took 3.7 times the input's space; runs are written once, and parts take turns."""
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(40))) for i in range(60)]
    kept = []
    monkeypatch.setattr(language_model, "written", lambda df: kept.append(written(df)) or kept[-1], raising=False)
    monkeypatch.setattr(language_model, "RUN_TOKENS", 300)
    got = {i: s for i, (s,) in _by_id(language_model.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), "score").items()}
    assert got == {i: pytest.approx(w, rel=1e-9) for i, w in brute.backoff_scores(dict(rows)).items()}
    runs, *waves, _ = kept
    assert len(waves) == language_model.WAVES > 1
    assert {r.own for r in runs.collect()} == {True} and not any(r.own for w in waves for r in w.collect())
    parts = [{r.part for r in w.collect()} for w in waves]
    assert all(parts) and not set.intersection(*parts)
    assert runs.count() == 3 and all({r.run for r in w.collect()} == {r.run for r in runs.collect()} for w in waves)


def test_fingerprints(spark, documents, texts, nothing):
    got = {r.doc_id: r for r in fingerprints.document_fingerprints(documents).collect()}
    want = brute.edited(texts)
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == {i: w[:2] for i, w in want.items()}
    for i, r in got.items():
        assert r.fingerprint == fingerprints.fingerprint(texts[i] or "")
        assert r.near_next == fingerprints.likeness(r.fingerprint, got[want[i][2]].fingerprint)
        assert r.near_edited == fingerprints.likeness(r.fingerprint, r.edited_fingerprint)
        text, following = texts[i] or "", texts[want[i][2]] or ""
        edited = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        assert (r.common_edited, r.common_next) == tuple(len(os.path.commonprefix([text, other])) for other in (edited, following))
    assert got[1].fingerprint == got[7].fingerprint != got[13].fingerprint
    alone = fingerprints.document_fingerprints(spark.createDataFrame([(None, "abcd")], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.edited_sha256, r.near_next) for r in alone] == [(4, hashlib.sha256(b"abab").hexdigest(), 1.0)]
    assert fingerprints.document_fingerprints(documents.union(documents)).count() == 36
    assert fingerprints.document_fingerprints(nothing).count() == 0


def _exact(ids, x, k):
    out = {}
    for i in range(len(ids)):
        score = x @ x[i]
        score[i] = -np.inf
        out[ids[i]] = np.lexsort((ids, -score))[:k]
    return out


def test_nearest_recall(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = table(spark, sf_dir, "embeddings").orderBy("vec_id").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)
    want = _exact(ids, x, 20)
    got = QUERIES["op8_nearest"](spark, sf_dir).toPandas()
    found = sum(len(set(g.vec_id) & set(ids[want[q]])) for q, g in got.groupby("query_id"))
    assert found >= 0.9 * 20 * got.query_id.nunique() and got.query_id.nunique() == (ids % 20 == 0).sum()


def test_nearest_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 8)
    vectors = [(i, [1.0, 0.0]) for i in range(30)] + [(30, [0.5, 0.5]), (31, None), (32, [0.0, 0.0]), (33, [float("nan"), 1.0]), (34, [None, 1.0]),
               (35, [float("inf"), 1.0]), (36, [1.0]), (None, [1.0, 0.0]), (30, [0.5, 0.5]), (40, [2.0, 0.0]), (60, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = nearest.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 40, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (20, 1, 40, 2.0), (20, 2, 0, 1.0), (20, 3, 1, 1.0),
                                       (40, 1, 0, 2.0), (40, 2, 1, 2.0), (40, 3, 2, 2.0)]
    few = nearest.nearest_neighbours(df.where("vec_id in (0, 30)"), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in few.collect()] == [(0, 1, 30, 0.5)]
    assert nearest.nearest_neighbours(df.where("vec_id in (31, 32)"), F.lit(True)).count() == 0
    assert nearest.nearest_neighbours(df.where("vec_id = 1"), F.col("vec_id") % 20 == 0).count() == 0


def test_packing(spark, documents, texts, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("json"))
    both = documents.union(documents.where("doc_id in (1, 5)"))
    cut = packing.pieces(both, vocabulary(), with_ids=True)
    rows = packing.pack(cut.withColumn("offset", F.lit("old")), window=8, carried=3).collect()
    assert len(rows) == cut.count()
    at = {}
    for r in rows:
        ids = [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        piece = ids[r.start:r.start + r.length]
        assert r.ids == piece and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, [*places[1:], (sum(n for _, n in places), 0)], strict=True))
        assert places[0][0] == 0 and sum(n for _, n in places) <= 2048
    assert sum(r.length for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts.items() for _ in range(2 if i in (1, 5) else 1))
    assert packing.packed_documents(nothing, vocabulary()).count() == 0


def test_vocabularies_agree(spark, small_dir):
    docs = table(spark, small_dir, "documents")
    assert packing.pieces(docs, vocabulary()).exceptAll(packing.pieces(docs, vocabulary("json"))).count() == 0


def test_special_tokens_are_those_of_the_library(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("json"))
    rows = {1: "end <|endoftext|> start", 2: "<|endoftext|>", 3: "<|endoftext|><|endoftext|>\n<|endoftex|>", 4: "a<|endoftext|>b"}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in rows.items()}
    assert want[1] == [437, 220, 50256, 923, 1]
    for kind in ("tiktoken", "json"):
        assert {r.doc_id: r.ids for r in packing.pieces(df, vocabulary(kind), with_ids=True).collect()} == want
        assert 50256 not in packing.encoder(vocabulary(kind), special={})(rows[1])


def test_mixing(spark, documents, texts, nothing, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 2)
    rows = {r.doc_id: r for r in mixing.mix(documents).collect()}
    assert {i: r.size for i, r in rows.items()} == {i: len(brute.WORD.findall(t or "")) for i, t in texts.items()}
    source = {r.doc_id: r.source for r in documents.collect()}
    sizes, taken = {}, {}
    for i, r in rows.items():
        sizes[source[i]] = sizes.get(source[i], 0) + r.size
        taken[source[i]] = taken.get(source[i], 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = brute.targets(sizes)
    for i, r in rows.items():
        assert r.source_size == sizes[source[i]] and r.target == pytest.approx(want[source[i]])
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    assert mixing.mix(documents).exceptAll(mixing.mix(documents.repartition(5))).count() == 0
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    words = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert words == {i: r.taken for i, r in rows.items() if r.taken}
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    twice = documents.union(documents)
    assert mixing.mix(twice).count() == 36
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_targets_of_uneven_sources(spark):
    sizes = {"a": 1, "b": 100, "c": 2, "d": 0, None: 3, "é": 40}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute.targets(sizes))
