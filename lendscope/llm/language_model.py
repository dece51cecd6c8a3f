"""Log-probabilities of documents under an n-gram model with backoff, as a weighted automaton with failure arcs.

``build`` makes the automaton of a whole model and ``traverse`` walks it, both in one process. ``score`` holds no whole model
anywhere: each task builds the part of the automaton that its own texts can reach (``reachable``) and walks that.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.counting import key_counts
from lendscope.llm.tables import partitions, release, written
from lendscope.llm.words import chunks, mix, rolling, seeds, split_words

ORDER = 3
DISCOUNT = 0.75
SEGMENT = 256
PART_BYTES = 8 << 20
RUN_TOKENS = 1_000_000
WAVES = 2
FOLDS, HELD = 7, 2
END = seeds(1, 9_999)[0]


def held_out(doc_id, folds: int = FOLDS, held: int = HELD):
    """Rows kept from learning: crc32 of doc_id as text leaves the remainder ``held``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == held


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, A-Z lower-cased, with an end after each; and where texts begin."""
    words = split_words(texts, lower=True)
    n = len(words.first) - 1
    first = words.first + np.arange(n + 1)
    out = np.empty(first[-1], np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[first[1:] - 1] = True
    out[is_end] = END
    out[~is_end] = words.hashes
    return out, first


class Grams(NamedTuple):
    """N-grams of one length. A key is the number of the n-gram's prefix times ``base`` plus its last word."""

    keys: np.ndarray  # sorted; of single words: their hashes
    counts: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of wanted keys in sorted keys, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


class Places:
    """Places of keys among sorted hashes, found from where those with the same first bits begin: a step or two each."""

    def __init__(self, hashes: np.ndarray):
        bits = max(1, len(hashes).bit_length())
        self.size, self.shift = len(hashes), np.uint64(64 - bits)
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))
        self.begin = np.zeros(1 << bits, np.int64)
        np.cumsum(np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << bits)[:-1], out=self.begin[1:])

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """-1 where there is none."""
        at = self.begin[(wanted >> self.shift).astype(np.int64)]
        pending = np.flatnonzero(self.hashes[at] < wanted)
        for _ in range(16):
            if not len(pending):
                break
            at[pending] += 1
            pending = pending[self.hashes[at[pending]] < wanted[pending]]
        at[pending] = np.searchsorted(self.hashes, wanted[pending])
        return np.where((self.hashes[at] == wanted) & (at < self.size), at, -1)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, each once and sorted, and the place of each of them there."""
    ordered = np.sort(hashes)
    distinct = ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered
    return distinct, Places(distinct).find(hashes)


def _numbers(levels: list[Grams], hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """For each length, the number of the known n-gram that ends at each token, or -1."""
    words = _find(levels[0].keys, hashes)
    out, base = [words], np.uint64(len(levels[0].keys))
    inner = np.ones(len(hashes), bool)
    inner[first[:-1][first[:-1] < len(hashes)]] = False
    for level in levels[1:]:
        last = out[-1]
        before = np.concatenate([[-1], last[:-1]])
        possible = np.flatnonzero(inner & (before >= 0) & (last >= 0))
        numbers = np.full(len(hashes), -1, np.int64)
        numbers[possible] = _find(level.keys, before[possible].astype(np.uint64) * base + words[possible].astype(np.uint64))
        out.append(numbers)
    return out


class Automaton(NamedTuple):
    """States are n-grams that have arcs; state 0 is empty. An arc's key is the hash (``mix``) of state * words + word.

    A state without an arc for a word fails to the state of its longest proper suffix, at the cost of its backoff weight.
    """

    words: np.ndarray  # hashes of known words, sorted
    word_counts: np.ndarray
    arc_keys: np.ndarray  # sorted
    arc_target: np.ndarray
    arc_log: np.ndarray
    fail: np.ndarray
    backoff: np.ndarray | None  # log10; None where the weights are not known yet


def build(levels: list[Grams], total: int, discount: float, order: int) -> Automaton:
    """The automaton of some n-grams. The probability of a word after a state is (count - DISCOUNT) / count of
    the state; what its words leave goes to the next shorter state, so that all probabilities add up to one."""
    n_words = len(levels[0].keys)
    base = np.uint64(max(n_words, 1))
    single = (levels[0].counts - discount) / max(total, 1)
    prob, words, prefix, suffix = [single], [np.arange(n_words)], [np.zeros(n_words, np.int64)], [np.zeros(n_words, np.int64)]
    for n in range(1, len(levels)):
        level = levels[n]
        prefix.append((level.keys // base).astype(np.int64))
        words.append((level.keys % base).astype(np.int64))
        prob.append((level.counts - DISCOUNT) / levels[n - 1].counts[prefix[n]])
        if n == 1:
            suffix.append(words[n])
        else:  # drop the first word: the suffix of the prefix, then the last word
            shorter = suffix[n - 1][prefix[n]].astype(np.uint64) * base + words[n].astype(np.uint64)
            suffix.append(_find(levels[n - 1].keys, shorter))
    # Backoff weights of the states: n-grams that some longer n-gram continues.
    state = [np.zeros(len(level.keys), np.int64) for level in levels]
    backoffs, sources, number = [np.zeros(1)], [], 1
    for n in range(1, len(levels)):
        owners = np.unique(prefix[n])
        state[n - 1][owners] = np.arange(number, number + len(owners))
        number += len(owners)
        kept = np.bincount(prefix[n], prob[n], len(levels[n - 1].keys))[owners]
        lower = np.bincount(prefix[n], prob[n - 1][suffix[n]], len(levels[n - 1].keys))[owners]
        backoffs.append(np.log10(np.maximum(1 - kept, 1e-12) / np.maximum(1 - lower, 1e-12)))
        sources.append((n - 1, owners))
    # Where an n-gram leads: its own state, or that of its longest suffix that is one.
    lands = []
    for n in range(len(levels)):
        shorter = lands[n - 1][suffix[n]] if n else np.zeros(n_words, np.int64)
        lands.append(np.where(state[n] > 0, state[n], shorter))
    fails = [np.zeros(1, np.int64)] + [lands[n - 1][suffix[n][owners]] if n else np.zeros(len(owners), np.int64) for n, owners in sources]
    keys = [np.arange(n_words, dtype=np.uint64)]
    keys += [state[n - 1][prefix[n]].astype(np.uint64) * base + words[n].astype(np.uint64) for n in range(1, len(levels))]
    keys = mix(np.concatenate(keys))
    ordered = np.argsort(keys)
    return Automaton(levels[0].keys, levels[0].counts, keys[ordered], np.concatenate(lands)[ordered],
                     np.log10(np.concatenate(prob))[ordered], np.concatenate(fails), np.concatenate(backoffs))


def reachable(numbers: np.ndarray, at: list[np.ndarray], count: np.ndarray, total: int, discount: float,
              words: np.ndarray) -> tuple[Automaton, np.ndarray]:
    """The part of the whole automaton that some texts can reach, and the n-gram of each state.

    ``numbers`` is the word at each token, ``at`` and ``count`` the n-gram of each length that ends there and how often
    training texts hold each n-gram. Every n-gram of the texts that is in training gives its arc, and those shorter than the longest
    are states; the suffixes and prefixes of such an n-gram are in training too, so arcs and failures end inside the part.
    Backoff weights depend on words that these texts may not hold and are left open.
    """
    order, base = len(at) - 1, np.uint64(max(len(words), 1))
    state = np.zeros(len(count) + 1, np.int64)  # the last one stands for the empty n-gram, which has the number -1
    held = []
    for n in range(1, order + 1):
        place = np.full(len(count), -1, np.int64)
        inner = np.flatnonzero(at[n] >= 0)
        place[at[n][inner]] = inner
        held.append(place[(place >= 0) & (count > 0)])
    owners = np.concatenate([at[n][held[n - 1]] for n in range(1, order)])
    state[owners] = np.arange(1, len(owners) + 1)
    keys, lands, logs, fails = [], [], [], [np.zeros(1, np.int64)]
    for n, place in enumerate(held, 1):
        gram = at[n][place]
        before = at[n - 1][place - 1] if n > 1 else np.full(len(place), -1, np.int64)
        keys.append(state[before].astype(np.uint64) * base + numbers[place].astype(np.uint64))
        suffix = at[n - 1][place] if n > 1 else np.full(len(place), -1, np.int64)
        lands.append(state[gram] if n < order else state[suffix])
        if n < order:
            fails.append(state[suffix])
        logs.append(np.log10((count[gram] - DISCOUNT) / count[before]) if n > 1
                    else np.log10(np.maximum(count[gram] - discount, 1e-300) / max(total, 1)))
    keys = mix(np.concatenate(keys))
    ordered = np.argsort(keys)
    model = Automaton(words, np.zeros(0, np.int64), keys[ordered], np.concatenate(lands)[ordered], np.concatenate(logs)[ordered],
                      np.concatenate(fails), None)
    return model, np.append(-1, owners)


def walk(model: Automaton, words: np.ndarray, first: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 weight of the arcs that each token takes, by one walk from left to right; and the failures on the way as
    tokens and the states that failed there, whose backoff weights are still to be added.

    ``words`` are numbers, -1 for an unknown word: that one costs the failures to state 0; its own probability is added
    elsewhere. A state depends on order - 1 tokens only, so a text is walked as segments that begin that much earlier, all of
    them in step: each step moves every segment by a token.
    """
    lengths = np.diff(first)
    pieces = -(-lengths // SEGMENT)
    document = np.repeat(np.arange(len(lengths)), pieces)
    start = first[document] + (np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
    end = np.minimum(start + SEGMENT, first[document + 1])
    at = np.maximum(start - (order - 1), first[document])
    out = np.zeros(len(words))
    failed_at, failed_state = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    state = np.zeros(len(at), np.int64)
    base, arcs = np.uint64(max(len(model.words), 1)), Places(model.arc_keys)
    active = np.arange(len(at))
    while len(active):
        place = at[active]
        word, here = words[place], state[active]
        counted = place >= start[active]
        going = np.arange(len(active))
        while len(going):
            w, s = word[going], here[going]
            arc = np.where(w >= 0, arcs.find(mix(s.astype(np.uint64) * base + np.maximum(w, 0).astype(np.uint64))), -1)
            hit = arc >= 0
            taken = going[hit]
            out[place[taken][counted[taken]]] = model.arc_log[arc[hit]][counted[taken]]
            here[taken] = model.arc_target[arc[hit]]
            failed = going[~hit]
            going = failed[here[failed] > 0]
            failed_at.append(place[going][counted[going]])
            failed_state.append(here[going][counted[going]])
            here[going] = model.fail[here[going]]
        state[active] = here
        at[active] += 1
        active = active[at[active] < end[active]]
    return out, np.concatenate(failed_at), np.concatenate(failed_state)


def traverse(model: Automaton, words: np.ndarray, first: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 probability of each token: the arcs and failures of ``walk`` in a model whose weights are known."""
    out, failed_at, failed_state = walk(model, words, first, order)
    return out + np.bincount(failed_at, model.backoff[failed_state], len(words))


def _boxed(*arrays: np.ndarray) -> bytes:
    """Arrays as packed planes of single bytes: those of small numbers take next to nothing."""
    flat = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays if len(a))
    return pickle.dumps(([(a.dtype.str, len(a)) for a in arrays], len(flat), pa.compress(flat, "zstd", asbytes=True) if flat else b""), 5)


def _unboxed(data: bytes) -> list[np.ndarray]:
    kinds, size, packed = pickle.loads(data)
    flat = np.frombuffer(pa.decompress(packed, size, "zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    out, at = [], 0
    for kind, n in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(flat[at:at + n * width].reshape(width, n).T).reshape(-1).view(kind))
        at += n * width
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as steps, which ``np.cumsum`` undoes."""
    return np.diff(keys, prepend=np.uint64(0)).astype(np.uint64)


def _inside(lengths: np.ndarray) -> np.ndarray:
    """How many tokens of its text come before each token."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _grams(hashes: np.ndarray, lengths: np.ndarray, order: int, chosen=None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys of all n-grams of the texts, each once and sorted, and for each length the place in them of the n-gram that
    ends at each token (-1 where the text has fewer tokens before). Item 0 of the list stands for the empty n-gram.
    With ``chosen``, only keys for which it holds; the others have the place -1 as well."""
    inside = _inside(lengths)
    ends = [np.flatnonzero(inside >= n) for n in range(order)]
    keys = [hashes] + [rolling(hashes, n + 1, n + 1)[ends[n] - n] for n in range(1, order)]
    if chosen is not None:
        kept = [chosen(k) for k in keys]
        ends, keys = ([x[k] for x, k in zip(c, kept, strict=True)] for c in (ends, keys))
    distinct, place = _distinct(np.concatenate(keys))
    at, done = [np.full(len(hashes), -1, np.int64)], 0
    for end in ends:
        at.append(np.full(len(hashes), -1, np.int64))
        at[-1][end] = place[done:done + len(end)]
        done += len(end)
    return distinct, at


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts are equal ranges of keys, which are hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _dealt(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(part, start, end) of sorted keys."""
    part = _part(keys, parts)
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    return zip(part[cuts[:-1]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


_SENT = "part long, run long, own boolean, blob binary"


def _sent(rows: list[tuple[int, int, bool, bytes]]) -> dict:
    part, run, own, blob = zip(*rows, strict=True)
    return {"part": pa.array(part, pa.int64()), "run": pa.array(run, pa.int64()), "own": pa.array(own, pa.bool_()), "blob": pa.array(blob, pa.binary())}


def _own_part(run: int, parts: int) -> int:
    """Where a run's own row waits for the answers: anywhere, dealt evenly."""
    return int(mix(np.array([run + 1], np.uint64))[0] % np.uint64(parts))


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys, where each distinct key begins in it, and how often it is there."""
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0])) if len(keys) else np.zeros(0, np.int64)
    return order, starts, np.diff(np.append(starts, len(keys)))


def _answered(table: pa.Table, answers) -> pa.Table:
    """A part's rows: those of runs go on as they are, the others get what ``answers`` makes of all their blobs."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("part", "run", "own", "blob")), strict=True))
    asked = [r for r in rows if not r[2]]
    found = answers([r[3] for r in asked]) if asked else []
    return pa.table(_sent([r for r in rows if r[2]] + [(p, run, False, blob) for (p, run, _, _), blob in zip(asked, found, strict=True)]))


def _gathered(table: pa.Table) -> tuple[int, list[np.ndarray], list[bytes]]:
    """A run's number, its own arrays, and the answers in order of keys."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("own", "part", "run", "blob")), strict=True))
    own = next(r for r in rows if r[0])
    return own[2], _unboxed(own[3]), [r[3] for r in sorted((r for r in rows if not r[0]), key=lambda r: r[1])]


def _total_counts(blobs: list[bytes]) -> list[bytes]:
    """For each key asked: its count over all runs times four, plus two in the first run that has learnt from it,
    plus one if some run has it as a context in a row that is held out."""
    pairs = [_unboxed(b) for b in blobs]
    keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in pairs])
    sent = np.concatenate([p[1] for p in pairs])
    order, starts, times = _groups(keys)
    sent = sent[order]
    counts = sent >> 1
    total, context = np.add.reduceat(counts, starts), np.bitwise_or.reduceat(sent & 1, starts)
    has = counts > 0
    before = np.cumsum(has) - has
    value = np.empty(len(keys), np.int64)
    value[order] = np.repeat(4 * total + context, times) + 2 * (has & (before == np.repeat(before[starts], times)))
    return [_boxed(v) for v in np.split(value, np.cumsum([len(p[0]) for p in pairs])[:-1])]


def _total_contexts(blobs: list[bytes]) -> list[bytes]:
    """For each context asked: how many words follow it, and the sum of their counts after the next shorter context."""
    pairs = [_unboxed(b) for b in blobs]
    kinds, lower = (np.concatenate([p[c] for p in pairs]) for c in (1, 2))
    keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in pairs])
    order, starts, times = _groups(keys)
    out = []
    for values in (kinds, lower):
        total = np.empty(len(keys), np.int64)
        total[order] = np.repeat(np.add.reduceat(values[order], starts), times)
        out.append(total)
    answers, done = [], 0
    for p in pairs:
        wanted = done + np.flatnonzero(p[3])
        answers.append(_boxed(out[0][wanted], out[1][wanted]))
        done += len(p[0])
    return answers


def score(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of (doc_id, text).

    Learns from the rows that ``held_out`` leaves. Tokens are words with A-Z lower-cased and an end after each
    text; null and empty texts are one end. base_score is the add-one unigram log10 probability; score that of the backoff
    model. Both know all training words, and one unknown word that stands for all others.

    Every n-gram of up to ``order`` tokens that a training text holds is in the model, once or more, at every size of the
    corpus. Its probability is (count - DISCOUNT) / count of its first tokens; what the words after a context leave goes to
    the next shorter context, so that all probabilities add up to one. Single words are discounted: (count - D) / N
    with D from the words seen once and twice; what that leaves is the unknown word's.

    1. Tasks cut rows into runs of about RUN_TOKENS tokens, which are written once, as numbers of words. A run sends each distinct
       n-gram once, with its count in training rows, to the part of its hash.
    2. Parts add up the counts and answer every run. So an n-gram that is everywhere costs one entry per run, and
       parts are even however hot a word is. Most of what is shuffled is these hashes, so the parts take their turn in WAVES: the
       answers of a wave are written, and its shuffle files go before the next one sends.
    3. A run now knows the counts of all its n-grams, so it builds the states and arcs that its texts can reach and walks them once from
       left to right. Each failure on the way owes its state's backoff weight. It depends on all words seen after the state: each
       n-gram is reported to its context by one run, if any held-out row has that context.
    4. A second round of the same kind adds up these reports and answers the runs that owe weights.

    Runs are numbered by task and place when they are written; all later steps read that table.
    """
    docs = documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held"))
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = partitions(spark, size, PART_BYTES)
    def boxed_run(run: int, gathered: list[tuple]) -> pa.RecordBatch:
        hashes, lengths, ids, known, held = (np.concatenate(c) for c in zip(*gathered, strict=True))
        words, numbers = _distinct(hashes)
        own = _boxed(_steps(words), numbers.astype(np.uint32), lengths.astype(np.uint32), ids, known.astype(np.uint16), held.astype(np.uint16))
        return pa.RecordBatch.from_pydict(_sent([(0, run, True, own)]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, gathered, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                hashes, first = tokens(part.column("text"))
                ids = part.column("doc_id")
                gathered.append((hashes, np.diff(first), ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                                 ids.is_valid().to_numpy(zero_copy_only=False), part.column("held").to_numpy(zero_copy_only=False).astype(bool)))
                n += len(hashes)
                if n >= RUN_TOKENS:
                    yield boxed_run(run, gathered)
                    run, gathered, n = run + 1, [], 0
        if n:
            yield boxed_run(run, gathered)

    def learnt_tokens(blobs: pa.Array) -> np.ndarray:
        out = [np.zeros(0, np.uint64)]
        for blob in blobs:
            words, numbers, lengths, _, _, held = _unboxed(blob.as_py())
            out.append(np.cumsum(words, dtype=np.uint64)[numbers[np.repeat(held == 0, lengths.astype(np.int64))]])
        return np.concatenate(out)

    runs = written(docs.mapInArrow(cut, _SENT))
    counts = key_counts(runs.select(F.col("blob").alias("text")), learnt_tokens, parts)
    facts = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*"), F.count(F.when(F.col("count") == 1, 1)),
                       F.count(F.when(F.col("count") == 2, 1))).first()
    total, kinds, once, twice = (int(x) for x in facts)
    discount = once / (once + 2 * twice) if once and twice else DISCOUNT
    unknown = float(np.log10(discount * kinds / total)) if total else 0.0

    def ask(wave: int):
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for run, blob in zip(batch.column("run"), batch.column("blob"), strict=True):
                    words, numbers, lengths, _, _, held = _unboxed(blob.as_py())
                    lengths = lengths.astype(np.int64)
                    distinct, at = _grams(np.cumsum(words, dtype=np.uint64)[numbers], lengths, order,
                                          lambda keys: _part(keys, parts) * WAVES // parts == wave)
                    learnt, inside = np.repeat(held == 0, lengths), _inside(lengths)
                    times = sum(np.bincount(a[learnt & (a >= 0)], minlength=len(distinct)) for a in at[1:])
                    context = np.zeros(len(distinct), np.int64)
                    for n in range(1, order):
                        before = at[n][np.flatnonzero(~learnt & (inside >= n)) - 1]
                        context[before[before >= 0]] = 1
                    rows = [(part, run.as_py(), False, _boxed(_steps(distinct[a:b]), 2 * times[a:b] + context[a:b]))
                            for part, a, b in _dealt(distinct, parts)]
                    if rows:
                        yield pa.RecordBatch.from_pydict(_sent(rows))

        return send

    def settle(table: pa.Table) -> pa.Table:
        run, (words, numbers, lengths, ids, known, held), answers = _gathered(table)
        lengths = lengths.astype(np.int64)
        distinct, at = _grams(np.cumsum(words, dtype=np.uint64)[numbers], lengths, order)
        value = np.concatenate([_unboxed(b)[0] for b in answers])
        first_here, wanted = (value & 2) > 0, (value & 1) > 0
        count = [np.where(a >= 0, (value >> 2)[a], 0) for a in at]
        follow, lower = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        for n in range(order, 1, -1):
            inner = np.flatnonzero(at[n] >= 0)
            # Of each n-gram that this run reports, any one place.
            place = np.full(len(distinct), -1, np.int64)
            place[at[n][inner]] = inner
            place = place[first_here & (place >= 0)]
            place = place[wanted[at[n - 1][place - 1]]]
            owner = at[n - 1][place - 1]
            follow += np.bincount(owner, minlength=len(distinct))
            lower += np.bincount(owner, count[n - 1][place], len(distinct)).astype(np.int64)

        numbers = numbers.astype(np.int64)
        model, gram = reachable(numbers, at, value >> 2, total, discount, words)
        logs, failed_at, failed_state = walk(model, np.where(count[1] > 0, numbers, -1), np.append(0, np.cumsum(lengths)), order)
        logs[count[1] == 0] += unknown
        row = np.repeat(np.arange(len(lengths)), lengths)
        rows_of = row[failed_at]
        context, first_ask, entry = np.unique(gram[failed_state], return_index=True, return_inverse=True)  # answers come in this order
        shorter = gram[model.fail[failed_state[first_ask]]]
        about = np.stack([(value >> 2)[context], np.where(shorter < 0, total, (value >> 2)[shorter]), (shorter < 0).astype(np.int64)])
        starts = np.cumsum(lengths) - lengths
        own = _boxed(lengths, ids, known, held, np.add.reduceat((count[1] > 0).astype(np.int64), starts),
                     np.add.reduceat(np.log10(count[1] + 1.0), starts), np.add.reduceat(logs, starts),
                     *about, entry.astype(np.uint32), rows_of.astype(np.uint32))
        asked = np.zeros(len(distinct), np.uint16)
        asked[context] = 1
        some = np.flatnonzero((follow > 0) | (asked > 0))
        out = [(_own_part(run, parts), run, True, own)]
        for part, a, b in _dealt(distinct[some], parts):
            which = some[a:b]
            out.append((part, run, False, _boxed(_steps(distinct[which]), follow[which], lower[which], asked[which])))
        return pa.table(_sent(out))

    def finish(table: pa.Table) -> pa.Table:
        _, own, answers = _gathered(table)
        lengths, ids, known, held, n_known, base, logs, here, shorter, single, entry, rows_of = own
        found = [_unboxed(b) for b in answers]
        follow, lower = (np.concatenate([np.zeros(0, np.int64), *c]).astype(float) for c in (zip(*found, strict=True) if found else ([], [])))
        spared = np.where(single > 0, discount, DISCOUNT)
        # What the context leaves, over what the shorter context gives to words not seen after the longer one.
        weight = np.log10(DISCOUNT * follow / here) - np.log10((shorter - lower + spared * follow) / shorter)
        return pa.table({
            "doc_id": pa.array(ids, mask=known == 0), "held_out": held.astype(bool), "n_tokens": lengths, "n_known": n_known,
            "base": base, "logs": logs + np.bincount(rows_of, weight[entry], len(lengths))})

    known_so_far = runs
    for wave in range(WAVES):
        release(spark)
        known_so_far = known_so_far.unionByName(written(
            runs.mapInArrow(ask(wave), _SENT)
            .repartition(parts, "part").groupBy("part").applyInArrow(lambda table: _answered(table, _total_counts), _SENT)))
    release(spark)
    settled = written(known_so_far.repartition(parts, "run").groupBy("run").applyInArrow(settle, _SENT))
    release(spark)
    rows = (settled.repartition(parts, "part").groupBy("part").applyInArrow(lambda table: _answered(table, _total_contexts), _SENT)
            .repartition(parts, "run").groupBy("run").applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, logs double"))
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(total + kinds + 1))).alias("base_score"), F.col("logs").alias("score"))
