"""Plain versions of what the operators compute, for small inputs."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size=3):
    w = words((text or "").translate(LOWER))
    if 0 < len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def roots(nodes, linked):
    """Least node reachable from each; ``linked``: pairs."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(rows, percent=90, size=3):
    """(id, text) pairs to {id: (set size, component)}."""
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(i for i in sets if sets[i])
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    root = roots(sets, links)
    return {i: (len(sets[i]), root[i]) for i in sets}


def without_boilerplate(rows, ratio=0.01, least=5):
    """(text, host) pairs to texts without boilerplate lines."""
    from collections import Counter

    gap = "\x20\x09\x0a\x0b\x0c\x0d"
    pages = Counter(h for _, h in rows)
    seen = Counter((h, x) for t, h in rows for x in {y.strip(gap) for y in (t or "").split("\n")} - {""})
    out = []
    for t, h in rows:
        if t is None:
            out.append(None)
            continue
        drop = lambda x: x and seen[h, x] >= least and seen[h, x] > pages[h] * ratio
        out.append("\n".join(y for y in t.split("\n") if not drop(y.strip(gap))))
    return out
