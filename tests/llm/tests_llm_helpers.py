"""Brute force shared by tests."""

from collections import Counter, defaultdict


def shingle_components(texts: dict) -> dict:
    """id -> least id of the component of 5-word shingle sets with similarity 0.75 or more."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in texts}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        for g in sets[i]:
            holders[g].append(i)
    common = Counter((a, b) for h in holders.values() for k, b in enumerate(h) for a in h[:k])
    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in texts}
