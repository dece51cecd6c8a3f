"""The numpy and tree helpers, without Spark."""

import html
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lendscope.llm import fingerprints as fp
from lendscope.llm import language_model as lm
from lendscope.llm import nearest, packing, window_blobs
from lendscope.llm import sketches as sk
from lendscope.llm.html_text import main_text
from lendscope.llm.words import WORD_PATTERN, chunks, split_words

TEXTS = st.text(alphabet=st.sampled_from("aAbBé ,\t\n\x0b\x0c\r\x1c日"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXTS), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    found = split_words(pa.array(texts, pa.string()), lower=True)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    want = [re.findall(WORD_PATTERN, (t or "").translate(lower)) for t in texts]
    got = [bytes(found.data[s:e]).decode() for s, e in zip(found.starts, found.ends, strict=True)]
    assert got == [w for ws in want for w in ws]
    assert np.diff(found.first).tolist() == [len(w) for w in want]
    by_hash = dict(zip(found.hashes.tolist(), got, strict=True))
    assert len(by_hash) == len(set(got))


def test_chunks_keep_every_row():
    batch = pa.record_batch({"text": ["a" * 10, None, "b" * 100, "", "c"]})
    parts = list(chunks(batch, "text", 20))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) <= 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(0, 3), st.integers(0, 200_000), st.integers(0, 2**32 - 1)), min_size=1, max_size=50))
def test_blobs_round_trip(rows):
    rows.sort()
    doc, version, position, key = (np.array(c) for c in zip(*rows, strict=True))
    entries = window_blobs.Entries(key.astype(np.uint32), doc, version.astype(np.uint32), position)
    back = window_blobs.unpack(window_blobs.pack(entries, np.uint32), np.uint32)
    assert all((a == b).all() for a, b in zip(entries, back, strict=True))


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(3)
    for share in (0.6, 0.75, 0.9):
        base = rng.integers(0, 2**63, 2000).astype(np.uint64)
        other = base.copy()
        new = int(2000 * (1 - share) / (1 + share))
        other[:new] = rng.integers(0, 2**63, new).astype(np.uint64)
        sets = np.concatenate([np.sort(base), np.sort(other)])
        sampled = sk.samples(sets, np.array([0, 2000, 4000]))
        differing = np.bitwise_count(np.bitwise_xor(*sk.odd_sketches(sampled))).sum()
        assert abs(differing - sk.differing_bits(share)) < 45
        assert (sk.band_keys(sampled)[0] == sk.band_keys(sampled)[1]).any()


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=8), st.integers(0, 60))
def test_fill_is_as_close_as_any_choice(counts, room):
    used = packing.fill(counts, room)
    assert all(n <= counts[length] for length, n in used.items())
    reachable = {0}
    for length, n in counts.items():
        reachable = {s + k * length for s in reachable for k in range(n + 1) if s + k * length <= room}
    assert sum(length * n for length, n in used.items()) == max(reachable)


def test_sequences_hold_each_piece_once():
    rng = random.Random(2)
    lengths = [rng.randint(1, 64) for _ in range(500)] + [64] * 3
    made = packing.fill_sequences(lengths, 64)
    assert sorted(i for s in made for i in s) == list(range(len(lengths)))
    sums = [sum(lengths[i] for i in s) for s in made]
    assert max(sums) <= 64 and len(made) <= 1.03 * sum(lengths) / 64 + 1


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc", max_size=60), st.text(alphabet="abc", max_size=60), st.integers(0, 20), st.integers(0, 20))
def test_extension_by_binary_search(x, y, i, j):
    i, j = min(i, len(x)), min(j, len(y))
    want = 0
    while i + want < len(x) and j + want < len(y) and x[i + want] == y[j + want]:
        want += 1
    a, b = fp.PrefixHashes(fp.code_points(x)), fp.PrefixHashes(fp.code_points(y))
    assert fp.common_extension(a, i, b, j) == want
    assert (fp.fingerprint(x) == fp.fingerprint(y)) == (x == y)


def test_common_prefix_by_blocks(monkeypatch):
    monkeypatch.setattr(fp, "BLOCK", 128)
    for n in (0, 1, 1023, 1024, 1025, 1151, 1152, 1153, 5000):
        assert fp.common_prefix("é" * n + "x", "é" * n + "yz") == n == fp.common_prefix("a" * n, "a" * n + "b")


def test_fingerprints_of_blocks_and_likeness(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh 日") for _ in range(5000))
    whole = fp.fingerprint(text)
    monkeypatch.setattr(fp, "BLOCK", 512)
    assert fp.fingerprint(text) == whole
    half = text[:2500] + "".join(rng.choice("ijklmnop") for _ in range(2500))
    assert fp.likeness(whole, whole) == 1.0
    assert 0.35 < fp.likeness(whole, fp.fingerprint(half)) < 0.7
    assert fp.likeness(whole, fp.fingerprint("xyz" * 500)) < 0.1
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("a")) == 0.0
    assert 0.4 < fp.likeness(fp.fingerprint("abcd"), fp.fingerprint("abxy")) < 0.6


def _model(texts, share_least=2):
    hashes, first = lm.tokens(pa.array(texts))
    kinds, counts = np.unique(hashes, return_counts=True)
    frequent = counts >= share_least
    levels = [lm.Grams(kinds[frequent], counts[frequent])]
    for _ in range(2):
        numbers = lm._numbers(levels, hashes, first)
        inner = np.ones(len(hashes), bool)
        inner[first[:-1]] = False
        before = np.concatenate([[-1], numbers[-1][:-1]])
        possible = np.flatnonzero(inner & (before >= 0) & (numbers[-1] >= 0))
        keys, n = np.unique(before[possible].astype(np.uint64) * np.uint64(len(levels[0].keys)) + numbers[0][possible].astype(np.uint64), return_counts=True)
        levels.append(lm.Grams(keys[n >= share_least], n[n >= share_least]))
    return levels, kinds, counts, len(hashes), lm.build(levels, len(hashes), 0.75, 3)


def test_automaton_probabilities_add_up_to_one():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a b c", "b c d", "a c", "d", f"x{rng.randint(0, 40)}"]) for _ in range(30)) for _ in range(20)]
    levels, kinds, counts, total, model = _model(texts)
    single = {w: (c - 0.75) / total for w, c in zip(kinds.tolist(), counts.tolist(), strict=True)}
    assert len(levels[2].keys) > 3
    for context in ("", "a", "a b", "b c", "d d", "zzz a", "a b c"):
        mass = 0.75 * len(kinds) / total  # the unknown word after the empty state
        walked = []
        for word in [*kinds.tolist(), -1]:
            ctx, first = lm.tokens(pa.array([context]))
            hashes = np.append(ctx[:-1], np.uint64(word) if word != -1 else np.uint64(1))
            numbers = lm._find(model.words, hashes)
            log = lm.traverse(model, numbers, np.array([0, len(hashes)]))[-1]
            if numbers[-1] < 0:
                log += math.log10(single[word] if word != -1 else mass)
            walked.append(10**log)
        assert sum(walked) == pytest.approx(1, abs=1e-9)


def test_segments_do_not_change_the_walk(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcd") for _ in range(n)) for n in (0, 1, 5, 300, 70)]
    *_, model = _model(texts)
    hashes, first = lm.tokens(pa.array(texts))
    numbers = lm._find(model.words, hashes)
    whole = lm.traverse(model, numbers, first)
    monkeypatch.setattr(lm, "SEGMENT", 7)
    assert np.allclose(lm.traverse(model, numbers, first), whole)


def test_tree_visits_every_leaf_once_and_near_ones_first():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 8))
    tree = nearest.fit_tree(x, leaf_sample=50)
    leaf = nearest.assign(tree, x)
    order = list(nearest.visits(tree, x[0]))
    assert sorted(order) == list(range(tree.leaf.max() + 1))
    assert order.index(leaf[0]) < len(order) / 2
    assert nearest.fit_tree(np.ones((5000, 3))).leaf.tolist() == [0]


ARTICLE = "First paragraph is rather long, has commas, and says something about the matter."


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("plain &amp; short", "plain & short"),
    (f"<nav><ul><li><a href=x>Home</a></ul></nav><article><h1>T &lt;1&gt;</h1><p>{ARTICLE}<p>Second  \n one</article><footer>f</footer>",
     f"T <1> {ARTICLE} Second one"),
    (f"<div class='content'><p>{ARTICLE}</p><div class='ad-box'>Buy, buy, buy, buy this now please</div></div><aside>Side</aside>", ARTICLE),
    (f"<main><p>{ARTICLE}</p></main><section id=comments><p>Nice, very nice, thanks a lot, dear author, indeed.</p></section>", ARTICLE),
    (f"<div id=cookieNotice>We use cookies, as all do, sadly, today.</div><div><p>{ARTICLE}<form><p>Sign up, now, or never, dear reader.</form></div>", ARTICLE),
    (f"<body><script>var a='</p>, , ,';</script><style>p,q{{}}</style><div><p>{ARTICLE}<!-- no, no, no --></div>", ARTICLE),
    (f"<div><p>{ARTICLE}<b>bo</b>ld<br>next</div><ul><li><a href=1>one link</a><li><a href=2>other link</a></ul>", f"{ARTICLE}bold next"),
    (f"<article><p>{ARTICLE}</p><p>cut off &quo", f"{ARTICLE} cut off &quo"), ("<article><p>a<a href='x", "a"),
    (f"<div id=page><h1>Title</h1><div><p>{ARTICLE}<p>{ARTICLE}</div></div>", f"Title {ARTICLE} {ARTICLE}"),
    (f"<body><section><h2>One</h2><p>{ARTICLE}</section><section><p>{ARTICLE}<p>{ARTICLE}</section><section><h2>Three</h2><p>The end.</section>",
     f"One {ARTICLE} {ARTICLE} {ARTICLE} Three The end."),
    (f"<article><p>{ARTICLE}</p><div class='market-share'><p>{ARTICLE}</div><section id=search-history>{ARTICLE}</section>"
     f"<div class='share-buttons'>{ARTICLE}</div><div id='commentList'>{ARTICLE}</div></article>", " ".join([ARTICLE] * 3)),
    (f"<article><p>{ARTICLE}</p><ul><li><a href=1>First reference</a><li><a href=2>Second reference</a></ul></article>",
     f"{ARTICLE} First reference Second reference"),
    (f"<body><h1>Title</h1><article><p>{ARTICLE}</article><div>Other</div>", f"Title {ARTICLE}"),
    (f"<div class='page site-header'>Site, name, of, this, page, in, words.</div><article><h1>T</h1><p>{ARTICLE}</article>", f"T {ARTICLE}"),
    ("<p title=\"a>b\">x < y</p>", "x < y"), ("<div hidden><p>no</p></div><p style='display: none'>no</p>yes", "yes"),
])
def test_main_text(source, want):
    assert main_text(source) == want


def test_main_text_of_odd_pages():
    deep = "<div>" * 20_000 + ARTICLE + "</div>" * 20_000
    assert main_text(deep) == ARTICLE
    long = "<article>" + f"<p>{ARTICLE}</p>" * 3000 + "</article>"
    assert main_text(long) == " ".join([ARTICLE] * 3000)
    assert main_text("<a " + "x='" * 20_000) == ""
    assert main_text(html.escape("<p>code</p>")) == "<p>code</p>"


def test_places_of_hashes():
    """Found from where their first bits begin; also where hashes crowd, and at both ends."""
    rng = np.random.default_rng(5)
    for hashes in (rng.integers(0, 2**64, 5000, np.uint64), np.arange(3000, dtype=np.uint64), np.array([0, 7, 2**64 - 1], np.uint64), np.zeros(0, np.uint64)):
        distinct, place = lm._distinct(np.concatenate([hashes, hashes[::2]]))
        assert np.array_equal(distinct, np.unique(hashes)) and np.array_equal(distinct[place], np.concatenate([hashes, hashes[::2]]))
        wanted = np.concatenate([hashes, rng.integers(0, 2**64, 500, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        assert np.array_equal(lm.Places(distinct).find(wanted), lm._find(distinct, wanted))
