"""Plain versions of operators, for comparison."""

import collections
import itertools
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def joined(texts, k, percent):
    """(size of the set, least id of the component) by comparing all pairs."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def _grams(text):
    """Letters with a gap for everything else; n-grams of one to three places that hold a letter, longer ones with a letter in the middle and beside it."""
    low = [(ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if c.isalpha() else 0 for c in text or ""]
    s, out = [0, *low, 0, 0], collections.Counter()
    for a, b, c in zip(s, s[1:], s[2:]):
        if a:
            out[a | 1 << 62] += 1
        if a or b:
            out[a << 21 | b] += 1
        if b and (a or c):
            out[a << 42 | b << 21 | c] += 1
    return out


def _top(counts, top):
    return {g: i for i, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:top])}


def profiles(rows, top):
    """(language, score) of each document by the rank-order distance to profiles of documents outside the held-out fold."""
    counts = collections.defaultdict(collections.Counter)
    for i, (text, lang) in rows.items():
        if text is not None and lang is not None and zlib.crc32(str(i).encode()) % 5:
            counts[lang] += _grams(text)
    known, out = {lang: _top(c, top) for lang, c in sorted(counts.items())}, {}
    for i, (text, _) in rows.items():
        own = _top(_grams(text), top)
        apart = {lang: sum(abs(at - theirs[g]) if g in theirs else top for g, at in own.items()) for lang, theirs in known.items()}
        best = min(apart, key=lambda x: (apart[x], x)) if own else "und"
        out[i] = (best, 1 - apart[best] / (len(own) * top) if own else 0.0)
    return out
