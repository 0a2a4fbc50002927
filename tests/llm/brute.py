"""Plain statements of what the operators must give, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(text):
    return (text or "").translate(LOWER)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def link_components(sets):
    """Smallest key reachable from every key of ``sets`` over links of Jaccard 0.8 or more."""
    holders, root = defaultdict(list), {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in sorted(sets):
        common = Counter(other for s in sets[k] for other in holders[s])
        for other, n in common.items():
            if 100 * n >= 80 * (len(sets[k]) + len(sets[other]) - n):
                a, b = find(k), find(other)
                root[max(a, b)] = min(a, b)
        for s in sets[k]:
            holders[s].append(k)
    return {k: find(k) for k in sets}


def windows(text, size=10):
    w = words(text)
    n = min(len(w), size)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def contaminated(text, benchmark, size=10):
    w = words(text)
    tests = set().union(*[windows(t, size) for t in benchmark])
    sizes = {len(t) for t in tests}
    return any(tuple(w[i : i + n]) in tests for n in sizes for i in range(len(w) - n + 1))
