"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, n=5):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} or {tuple(words)}


def components(docs, percent=75):
    """{id: (set size, smallest linked id)} of (id, text) pairs, all pairs compared."""
    sets = {d: shingles(t) for d, t in docs}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = find(a), find(b)
                    up[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


def repeats(docs, window=13):
    """{id: (words, removed, sha256 of the kept words)}."""
    words = {d: WORD.findall(t or "") for d, t in docs}
    least = {}
    for d, w in words.items():
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            least[key] = min(least.get(key, d), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def exact(docs):
    """{id: (keep, size, sha256)}."""
    norm = {d: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for d, t in docs}
    groups = {}
    for d, t in norm.items():
        groups.setdefault(t, []).append(d)
    return {d: (min(groups[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for d, t in norm.items()}


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_base(text, phrases):
    """(words, places, first, last, labels)."""
    words = LICENSE_WORD.findall(ascii_lower(text or ""))
    at, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))
