"""Plain Python versions of the operators for small tables."""

import hashlib
import re

SPACE = re.compile(r"[ \t-\r]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def substring_dedup(rows, window=20):
    """``rows`` of (doc_id, text); distinct numbers."""
    seen, result = set(), {}
    for d, text in sorted(rows):
        w = words(text)
        gone = set()
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            if key in seen:
                gone.update(range(a, a + window))
            seen.add(key)
        result[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return result


def components(rows, n=4, percent=85):
    sets = {}
    for d, text in rows:
        w = words(lower(text))
        k = min(n, len(w))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    index = {}
    for d, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(d)
    for d, s in sorted(sets.items()):
        shared = {}
        for g in s:
            for e in index[g]:
                if e < d:
                    shared[e] = shared.get(e, 0) + 1
        for e, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[e]) - both):
                a, b = sorted((top(d), top(e)))
                root[b] = a
    return {d: (len(s), top(d)) for d, s in sets.items()}


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
