"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

from collections import Counter, defaultdict
from hashlib import sha256


def words(text):
    return (text or "").encode().split()


def repeats(docs: dict[int, str], length: int) -> dict[int, tuple]:
    """(words, removed, sha of what is kept); ids ascending."""
    seen, out = set(), {}
    for i in sorted(docs):
        w = words(docs[i])
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            window = tuple(w[s : s + length])
            if window in seen:
                gone[s : s + length] = [True] * length
            seen.add(window)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), sha256(kept).hexdigest())
    return out


def shingles(text, size: int) -> frozenset:
    w = [x.lower() for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1)))


def near(docs: dict[int, str], size: int, percent: int) -> dict[int, tuple]:
    """(set size, smallest id reachable)."""
    sets = {i: shingles(t, size) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in docs}


def rule_counts(text, window: int = 8) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = words(text)
    runs = [tuple(w[j : j + window]) for j in range(len(w) - window + 1)]
    count, covered = Counter(runs), set()
    for j, run in enumerate(runs):
        if count[run] > 1:
            covered.update(range(j, j + window))
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)
