"""Plain versions of what the operators compute, for small inputs."""

import re
from collections import Counter


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def shingles(text):
    w = words(text)
    if not w:
        return Counter()
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def similarity(a, b):
    every = sum((a | b).values())
    return sum((a & b).values()) / every if every else 1.0


def classes(rows, least=0.8):
    """The smallest id of the connected documents, for every id; rows of (id, text), all ids given."""
    ids = sorted({i for i, _ in rows})
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if similarity(a, b) >= least:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def holds(text, item):
    """Whether the words of an item occur in a text, in order and without a gap."""
    w, x = words(text), words(item)
    return bool(x) and any(w[k:k + len(x)] == x for k in range(len(w) - len(x) + 1))
