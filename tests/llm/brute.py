"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

A_Z = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text):
    """Words between the six ASCII white-space bytes."""
    return (text or "").encode().split()


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    found = [w.decode() for w in words(text)]
    places = defaultdict(list)
    for i in range(len(found) - 4):
        places[tuple(found[i : i + 5])].append(i)
    repeated = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(found)
    return (
        n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
        len(repeated), n < 10 or 100 * len(repeated) > 20 * n,
    )


def shingles(text, width):
    found = (text or "").encode().translate(A_Z).split()
    if len(found) < width:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def components(rows, width, percent=80):
    """Least id reachable by links of similar sets, for rows of (id, text)."""
    sets = {k: shingles(t, width) for k, t in rows}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


def unrepeated(texts, length):
    """Per text: removed mask over its bytes, for strings of ``length`` bytes that start twice."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        out.append((d, gone))
    return out


def digest(d, gone):
    kept = bytes(b for b, g in zip(d, gone) if not g)
    spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
    return len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def segmentations(text, score, unknown):
    """Every segmentation of ``text`` as (score, pieces), best first."""
    found = []

    def go(i, total, parts):
        if i == len(text):
            found.append((total, parts))
            return
        for j in range(i + 1, len(text) + 1):
            value = score.get(text[i:j], unknown if j == i + 1 else None)
            if value is not None:
                go(j, total + value, [*parts, text[i:j]])

    go(0, 0.0, [])
    return sorted(found, key=lambda x: -x[0])
