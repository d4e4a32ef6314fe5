"""Plain Python versions of the operators' contracts, and small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table of (doc_id, text) or (doc_id, text, lang, source) tuples."""
    full = [(*r, *(None, None)[: 4 - len(r)])[:4] for r in rows]
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in full], DOCUMENT)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def decontaminated(docs, items, window=10):
    words = lambda t: ALNUM.findall((t or "").translate(FOLD))
    owners = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            owners[tuple(w[i : i + n])].add(str(item))
    lengths = sorted({len(k) for k in owners})
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                who = owners.get(tuple(w[i : i + n]))
                if who:
                    hit.update(range(i, i + n))
                    found |= who
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def without_repeats(docs, window=35):
    lists = [(d, SPACED.findall(t or "")) for d, t in docs]
    seen = defaultdict(list)
    for n, (_, w) in enumerate(lists):
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])].append((n, i))
    gone = defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for n, i in places:
                gone[n].update(range(i, i + window))
    return [
        (d, len(w), len(gone[n]), sha(" ".join(x for i, x in enumerate(w) if i not in gone[n])))
        for n, (d, w) in enumerate(lists)
    ]


def without_byte_repeats(docs, window=200):
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = defaultdict(list)
    for n, (_, b) in enumerate(data):
        for i in range(len(b) - window + 1):
            seen[b[i : i + window]].append((n, i))
    ends = defaultdict(list)
    for places in seen.values():
        if len(places) > 1:
            for n, i in places:
                ends[n].append(i)
    out = []
    for n, (d, b) in enumerate(data):
        gone = bytearray(len(b))
        for i in ends[n]:
            gone[i : i + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, sha(kept)))
    return out


def shingles(text, size):
    w = SPACED.findall((text or "").translate(FOLD))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def near_groups(docs, size=4, percent=80):
    sets = [(d, shingles(t, size)) for d, t in docs]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for n, (_, s) in enumerate(sets):
        for x in s:
            holders[x].add(n)
    for n, (d, s) in enumerate(sets):
        for m in {m for x in s for m in holders[x] if m < n}:
            e, r = sets[m]
            if None not in (d, e) and 100 * len(s & r) >= percent * len(s | r):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return [(d, len(s), None if d is None else root(d)) for d, s in sets]


def edits(docs):
    order = sorted(((d, t or "") for d, t in docs), key=lambda x: -x[0])
    out = []
    for n, (d, t) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        half = len(t) // 2
        out.append((d, len(t), sha(t[: len(t) - half] + after[:half])))
    return out
