"""Plain Python versions of the contracts, over lists of rows."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

SPACES = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text: str) -> str:
    return text.translate(UPPER)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def lines(rows, min_chars=40, min_docs=5):
    """[(doc_id, n_lines, n_dropped, kept text)] in the rows' order."""
    holders = defaultdict(set)
    keyed = []
    for i, text in rows:
        own = [(x, lower(x.strip(SPACES))) for x in (text or "").split("\n")]
        keyed.append((i, own))
        if i is not None:
            for _, k in own:
                if len(k) >= min_chars:
                    holders[k].add(i)
    out = []
    for i, own in keyed:
        kept = [x for x, k in own if i is None or len(holders.get(k, ())) < min_docs or max(holders[k]) == i]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def shingles(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def near(rows, k=4, percent=80):
    """doc_id -> (n_shingles, component)."""
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    part = components(ids, links)
    return {i: (len(sets[i]), part[i]) for i in ids}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def leaks(rows, items, window=10):
    """[(doc_id, n_words, hit flags, item ids)]."""
    grams = defaultdict(set)
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        for a in range(len(w) - m + 1 if m else 0):
            grams[tuple(w[a : a + m])].add(item)
    sizes = {len(g) for g in grams}
    out = []
    for i, text in rows:
        w = words(text)
        hit, found = [False] * len(w), set()
        for m in sizes:
            for a in range(len(w) - m + 1):
                own = grams.get(tuple(w[a : a + m]))
                if own:
                    hit[a : a + m] = [True] * m
                    found |= own
        out.append((i, len(w), hit, found - {None}))
    return out
