"""Plain Python forms of the operators' definitions, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(text, k: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def union_find(nodes, edges) -> dict:
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(texts: dict, k: int, percent: int) -> dict:
    """doc_id -> component by full Jaccard over an inverted index."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    edges = []
    for i, s in sets.items():
        common = Counter(j for x in s for j in at[x] if j > i)
        edges += [(i, j) for j, n in common.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
    return union_find(texts, edges)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii_base(t: str) -> list:
    """(kind number, start, end) by the contract's patterns."""
    digits = lambda m: re.sub(r"[^0-9]", "", m)
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, t) if ok(m.group())]


def secret_base(t: str) -> list:
    """(start, kind number, end) by the contract's patterns."""
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    rules = [(assign, lambda m: len(m.group(2)) >= 8), (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), (r"[0-9a-f]+", lambda m: len(m.group()) >= 32)]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, t) if ok(m))


def tokens(t: str) -> list:
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", lower(t or ""))


def lcs(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]
