"""Plain versions of the operators, for comparison on small tables."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, n=5):
    found = WORD.findall(lower(text))
    return {tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1))} if found else set()


def jaccard_components(rows, percent=75):
    """{doc_id: (size, component)} by comparing every pair that shares a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    common = {}
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                pair = (min(ids[a], ids[b]), max(ids[a], ids[b]))
                common[pair] = common.get(pair, 0) + 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}
