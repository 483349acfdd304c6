"""Plain Python versions of the training-data operators, for small tables."""

import hashlib
import re


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def jaccard_rows(rows, percent=75):
    """{(doc_id, n_shingles, component_id)} for rows with distinct, non-null ids."""
    sets = {i: shingles(t) for i, t in rows}
    by_word, links = {}, set()
    for i, s in sets.items():
        for x in s:
            by_word.setdefault(x, []).append(i)
    for ids in by_word.values():
        links.update((a, b) for a in ids for b in ids if a < b)
    good = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(sets, good)
    return {(i, len(s), comp[i]) for i, s in sets.items()}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
