"""Plain restatements of the contracts, for small inputs."""

import hashlib
from collections import Counter


def union_find(items, links):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_duplicates(docs, n, percent):
    sets = {i: shingles(t, n) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    part = union_find(ids, links)
    return {i: (i, len(sets[i]), part[i], part[i] == i) for i in ids}


def repeated_words(docs, window=20):
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if k in seen:
                gone[s:s + window] = [True] * window
            seen.add(k)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (i, len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def repeated_bytes(docs, window=200):
    count = Counter()
    for _, text in docs:
        b = (text or "").encode()
        count.update(b[s:s + window] for s in range(len(b) - window + 1))
    out = {}
    for i, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if count[b[s:s + window]] > 1:
                gone[s:s + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out[i] = (i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
