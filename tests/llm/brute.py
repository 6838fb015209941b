"""Brute-force versions of the operators, on plain Python lists."""
from __future__ import annotations

import hashlib
import itertools


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[k:] for k in range(5))))


def near_duplicates(rows):
    """rows: (doc_id, text), doc_id distinct -> {doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t) for i, t in rows}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {}
    for ids in where.values():
        for p in itertools.combinations(sorted(ids), 2):
            pairs[p] = pairs.get(p, 0) + 1
    links = [p for p, n in pairs.items() if 100 * n >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    comp = components(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def repeated_strings(texts, length=200):
    """texts: list of str or None -> list of (n_bytes, n_removed, n_spans, sha256 of the rest)"""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            w = d[i : i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def line_dedup(rows, min_words=50):
    """rows: (doc_id, text), distinct -> {doc_id: (n_lines, n_removed, text left)}"""
    docs = [(i, t.split("\n")) for i, t in sorted(rows) if t is not None]
    first, gone = {}, {i: set() for i, _ in docs}
    for i, lines in docs:
        count = [ln.count(" ") + (ln != "") for ln in lines]
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += count[b]
                if n >= min_words:
                    if first.setdefault(tuple(lines[a : b + 1]), (i, a)) != (i, a):
                        gone[i].update(range(a, b + 1))
                    elif b - a > 60:
                        break
    out = {i: (0, 0, None) for i, t in rows if t is None}
    for i, lines in docs:
        out[i] = (len(lines), len(gone[i]), "\n".join(x for k, x in enumerate(lines) if k not in gone[i]))
    return out


def unigram(rows):
    """rows: (doc_id, text) -> {doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}"""
    import math
    import zlib
    from collections import Counter

    def toks(t):
        return (t or "").encode().lower().split() + [None]

    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    c = Counter()
    for i, t in rows:
        if not held[i]:
            c.update(toks(t))
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(toks(t)), sum(c[w] > 0 for w in toks(t)), n,
                sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks(t))) for i, t in rows}
