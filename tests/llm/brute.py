"""What the operators should give, by the plainest means."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [w.translate(LOWER) for w in found] if lower else found


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rank(key):
    """Nulls before all other keys."""
    return (key is not None, key or 0)


def line_dedup(rows):
    holders = defaultdict(set)
    keys = {}
    for key, text in rows:
        keys[key, text] = [line.strip(WHITE).translate(LOWER) for line in (text or "").split("\n")]
        for k in keys[key, text]:
            if len(k) >= 10:
                holders[k].add(key)
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line, k in zip(lines, keys[key, text])
            if len(k) < 10 or len(holders[k]) < 2 or min(holders[k], key=rank) == key
        ]
        out.append((key, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def substring_dedup(rows, length):
    seen = defaultdict(int)
    texts = [(key, words(text)) for key, text in rows]
    for _, w in texts:
        for i in range(len(w) - length + 1):
            seen[tuple(w[i : i + length])] += 1
    out = []
    for key, w in texts:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(rows):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        groups[root(i)].append(key)
    return [(key, len(s), min(groups[root(i)], key=rank)) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def containments(rows, items):
    out = []
    for key, text in rows:
        own, flat = shingles(text), words(text, lower=True)
        for item, wanted in items:
            w = words(wanted, lower=True)
            if 0 < len(w) < 5:
                if any(flat[i : i + len(w)] == w for i in range(len(flat) - len(w) + 1)):
                    out.append((key, item, 1, 1))
            elif w:
                s = shingles(wanted)
                if 100 * len(s & own) >= 80 * len(s):
                    out.append((key, item, len(s), len(s & own)))
    return out


def exact_groups(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(LOWER)].append(key)
    return {norm: (max(keys, key=rank), len(keys)) for norm, keys in groups.items()}
