"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import functools
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(_LOWER)


def without_boilerplate(rows, ratio, least):
    """rows of (host, text) to (text, n_lines, n_dropped)."""
    pages, counts = collections.Counter(), collections.Counter()
    for host, text in rows:
        pages[host] += 1
        counts.update((host, x) for x in {x.strip(" \t\r") for x in (text or "").split("\n")} - {""})
    out = []
    for host, text in rows:
        if text is None:
            out.append((None, 0, 0))
            continue
        parts = text.split("\n")
        kept = [x for x in parts if not (counts[host, x.strip(" \t\r")] >= least and counts[host, x.strip(" \t\r")] > ratio * pages[host])]
        out.append(("\n".join(kept), len(parts), len(parts) - len(kept)))
    return out


def near_duplicates(rows, percent=75, width=5):
    """{doc_id: text} to {doc_id: (n_shingles, component, kept)}."""
    sets = {}
    for i, text in rows.items():
        w = WORD.findall(lower(text))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    holders = collections.defaultdict(list)
    for i, s in sorted(sets.items()):
        for x in s:
            holders[x].append(i)
    common = collections.Counter((a, b) for ids in holders.values() for k, b in enumerate(ids) for a in ids[:k])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def without_repeats(rows, window):
    """{doc_id: text} to {doc_id: (n_words, n_removed, kept text)}."""
    seen, out = set(), {}
    for i, text in sorted(rows.items()):
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.add(key)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def unigram_scores(rows):
    """{doc_id: text} to {doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in rows.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    counts = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    return {i: (held[i], len(ws), sum(counts[w] > 0 for w in ws), total,
                sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws)) for i, ws in tokens.items()}


def backoff_scores(rows, order=3, spared=0.75):
    """{doc_id: text} to {doc_id: log10 probability} with all n-grams of the training texts."""
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in rows.items()}
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i in rows}
    grams = collections.Counter(tuple(ws[k:k + n]) for i, ws in tokens.items() if not held[i]
                                for n in range(1, order + 1) for k in range(len(ws) - n + 1))
    single = [c for g, c in grams.items() if len(g) == 1]
    total, once, twice = sum(single), single.count(1), single.count(2)
    discount = once / (once + 2 * twice) if once and twice else spared
    after = collections.defaultdict(list)
    for g in grams:
        after[g[:-1]].append(g[-1])

    def probability(context, word):
        g = (*context, word)
        if not context:
            return (grams[g] - discount if grams[g] else discount * len(single)) / total
        if grams[g]:
            return (grams[g] - spared) / grams[context]
        if not grams[context]:
            return probability(context[1:], word)
        return weight(context) * probability(context[1:], word)

    @functools.cache
    def weight(context):
        kept = sum(probability(context, w) for w in after[context])
        return (1 - kept) / (1 - sum(probability(context[1:], w) for w in after[context]))

    return {i: sum(math.log10(probability(tuple(ws[max(0, k - order + 1):k]), w)) for k, w in enumerate(ws)) for i, ws in tokens.items()}


def edited(rows):
    """{doc_id: text} to {doc_id: (n_chars, sha256 of the edited text, next doc_id)}."""
    ids = sorted(rows, reverse=True)
    out = {}
    for k, i in enumerate(ids):
        following = ids[(k + 1) % len(ids)]
        text, other = rows[i] or "", rows[following] or ""
        n = len(text)
        out[i] = (n, hashlib.sha256((text[:n - n // 2] + other[:n // 2]).encode()).hexdigest(), following)
    return out


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: size} to {source: target}: share by weight, cut at the limit, and share the excess again."""
    ordered = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(ordered)}
    left, target, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over
    return target
