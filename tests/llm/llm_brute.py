"""Plain-Python versions of the operators' results, for small tables."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def folded(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]


def shingles(text, n=5):
    w = folded(text)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def near_duplicates(docs):
    """doc_id -> (shingles, component) of (doc_id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    posted = {}
    for i, s in sets.items():
        for g in s:
            posted.setdefault(g, []).append(i)
    links = []
    for i, s in sets.items():
        common = Counter(j for g in s for j in posted[g] if j < i)
        links += [(i, j) for j, k in common.items() if 100 * k >= 75 * (len(s) + len(sets[j]) - k)]
    component = components(sets, links)
    return {i: (len(s), component[i]) for i, s in sets.items()}


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)
