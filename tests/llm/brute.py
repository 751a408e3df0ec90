"""Plain reference versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def substring_dedup(rows, window=13):
    first = {}
    tokens = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in tokens:
        for k in range(len(w) - window + 1 if i is not None else 0):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in tokens:
        gone = set()
        for k in range(len(w) - window + 1):
            f = first.get(tuple(w[k : k + window]))
            if f is not None and (i is None or f < i):
                gone.update(range(k, k + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for rank, (kind, pattern) in enumerate(plain.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def stats(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(rows, k=3, percent=90):
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for j, (i, _) in enumerate(rows):
        if i is not None:
            least[find(j)] = min(least.get(find(j), i), i)
    return [(i, len(sets[j]), least.get(find(j))) for j, (i, _) in enumerate(rows)], len({find(j) for j in range(len(rows))})
