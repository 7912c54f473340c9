"""The operators' results by their definitions, one text at a time."""

from __future__ import annotations

import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(docs, window=13):
    """{(id, text): (words, removed, digest of the rest)}"""
    rank = lambda i: (i is None, i or 0)
    first = {}
    for i, text in docs:
        w = SPACED.findall(text or "")
        for k in range(len(w) - window + 1):
            s = tuple(w[k : k + window])
            first[s] = min(first.get(s, (True, 1 << 62)), rank(i))
    out = {}
    for i, text in docs:
        w = SPACED.findall(text or "")
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < rank(i) and not (i is None and first[tuple(w[k : k + window])][0]):
                gone.update(range(k, k + window))
        out[i, text] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def contamination(docs, items, window=13):
    """{(id, text): (words, hit, items)}"""
    wins = {}
    for i, text in items:
        w = ALPHANUMERIC.findall((text or "").translate(LOWER))
        n = min(len(w), window)
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    sizes = {len(s) for s in wins}
    out = {}
    for i, text in docs:
        w = ALPHANUMERIC.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if names := wins.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= names
        out[i, text] = (len(w), len(hit), sorted(found))
    return out


def shingles(text, k=5):
    w = SPACED.findall((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def components(docs, threshold, k=5):
    """Smallest id reachable, by place in ``docs``."""
    sets = [shingles(t, k) for _, t in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    least = {}
    for i, (ident, _) in enumerate(docs):
        if ident is not None:
            least[root(i)] = min(least.get(root(i), ident), ident)
    return [docs[i][0] if not sets[i] else least.get(root(i)) for i in range(len(docs))]


def winnow(text, hashes, window):
    """Chosen places by definition, from the hash of each run."""
    window = min(window, len(hashes))
    chosen = set()
    for k in range(len(hashes) - window + 1):
        own = hashes[k : k + window]
        chosen.add(k + max(i for i, h in enumerate(own) if h == min(own)))
    return sorted(chosen)
