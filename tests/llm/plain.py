"""Plain single-machine versions of the corpus operators, for small tables."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]


def shingles(text, width=5):
    w = lowered(text)
    if not w:
        return frozenset()
    width = min(width, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


class Groups:
    """Union by smallest member."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def near_duplicates(docs, percent=80):
    """doc_id -> (set size, component), over all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    holders = collections.defaultdict(list)
    groups = Groups()
    for i, s in sets.items():
        common = collections.Counter(j for x in s for j in holders[x])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                groups.join(i, j)
        for x in s:
            holders[x].append(i)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def statistics(text):
    w = words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {p for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


def repeated_words(docs, length=50):
    """doc_id -> word places in runs of ``length`` words that stand in two documents or twice in one."""
    places = collections.defaultdict(list)
    for i, t in docs:
        w = lowered(t)
        for k in range(len(w) - length + 1):
            places[tuple(w[k : k + length])].append((i, k))
    found = collections.defaultdict(set)
    for held in places.values():
        if len(held) > 1:
            for i, k in held:
                found[i].update(range(k, k + length))
    return found
