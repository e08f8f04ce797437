"""Plain single-process versions of the operators, for comparison in tests."""

from __future__ import annotations

import hashlib

import numpy as np


def words(text):
    return (text or "").encode("utf-8").lower().split()


def shingles(text, k=5):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def near_duplicates(docs, percent=75):
    """{doc_id: (n_shingles, component_id)} by comparing all texts that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    first, union = {}, Union()
    for i in sorted(sets):
        union.find(i)
        if sets[i]:
            union.join(first.setdefault(sets[i], i), i)
    post = {}
    for s, i in first.items():
        for x in s:
            post.setdefault(x, []).append(i)
    pairs = {}
    for members in post.values():
        for a in range(len(members)):
            for b in range(a):
                key = (members[b], members[a])
                pairs[key] = pairs.get(key, 0) + 1
    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            union.join(a, b)
    return {i: (len(sets[i]), union.find(i)) for i in sets}


def remove_repeats(docs, width=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}; docs in any order."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        data = (text or "").encode("utf-8")
        gone = np.zeros(len(data), dtype=bool)
        for a in range(len(data) - width + 1):
            s = data[a:a + width]
            if s in seen:
                gone[a:a + width] = True
            seen.add(s)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def clean_lines(docs, percent=80, gram=5):
    """{doc_id: text without the lines that repeat or resemble an earlier one}; unique ids."""
    forms, places = {}, {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        for no, line in enumerate((text or "").split("\n")):
            f = " ".join(line.lower().split())
            if f:
                forms.setdefault(f, (i, no))
                places.setdefault(f, []).append((i, no))
    names = list(forms)
    sets = [frozenset(f[a:a + gram] for a in range(len(f) - gram + 1)) for f in names]
    post, pairs, union = {}, {}, Union()
    for n, s in enumerate(sets):
        union.find(n)
        for x in s:
            post.setdefault(x, []).append(n)
    for members in post.values():
        for a in range(len(members)):
            for b in range(a):
                key = (members[b], members[a])
                pairs[key] = pairs.get(key, 0) + 1
    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            union.join(a, b)
    keep = {}
    for n, f in enumerate(names):
        root = union.find(n)
        keep[root] = min(keep.get(root, forms[f]), forms[f])
    drop = {p for n, f in enumerate(names) for p in places[f] if p != keep[union.find(n)]}
    return {i: None if t is None else "\n".join(ln for no, ln in enumerate(t.split("\n")) if (i, no) not in drop)
            for i, t in docs}


def nearest(rows, queries, k=10):
    """{(query, rank): (id, distance)} exactly; rows are (id, vector) that take part."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        best = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        for rank, j in enumerate(best, 1):
            out[q, rank] = (int(ids[j]), float(d[j]))
    return out
