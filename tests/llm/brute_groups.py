"""Plain Python versions of the trie, exact dedup and divergence operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

from .brute import lower

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def trie(rows, heads=9, group=5):
    """rows of (conv_id, turn, role, text) to sorted tuples as the operator's columns."""
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            content = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append((turn is not None, turn or 0, content, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % group if c >= 0 else -(abs(c) % group))
        rebuilt[c] = own.get(base, [])[:h] + mine[h:]
    members = collections.defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, convs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(convs) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, convs in members.items():
        ids = ",".join(str(c) for c in convs if len(rebuilt[c]) == len(k))
        out.append((convs[0], len(k), members[k[:-1]][0] if k else None, len(convs), children[k], leaves[k], saved[k], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def exact(rows):
    """rows of (doc_id, text) to a sorted list of (doc_id, keep_id, group_size, kept, text_sha256)."""
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[lower(text)].append(i)
    out = []
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, ids[0], len(ids), n == 0, sha) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


def divergence(rows, least=30, top=50):
    """rows of (text, lang, source) to a sorted list of (lang, source, part, item, value, rank)."""
    docs = [(TERM.findall(lower(t)), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {d[1] for d in docs}:
        frequency, counts = collections.Counter(), collections.defaultdict(collections.Counter)
        for terms, its, source in docs:
            if its == lang:
                frequency.update(set(terms))
                counts[source].update(terms)
        kept = sorted((t for t, n in frequency.items() if n >= least), key=str.encode)

        def share(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: share(c) for s, c in counts.items()}
        q = share(sum(counts.values(), collections.Counter()))
        for s in p:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            best = sorted(((q[t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t]))[:top]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(best)]
    return sorted(out)
