"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def low_words(text):
    return words((text or "").translate(LOWER))


def shingles(text, k=5):
    w = low_words(text)
    if not w:
        return []
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)]


def near(docs):
    """``doc_id -> (n_shingles, component)`` for distinct ids."""
    sets = {i: set(shingles(t)) for i, t in docs}
    label = {i: i for i in sets}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    return {i: (len(sets[i]), label[i]) for i in sets}


def leaks(docs, items):
    found = {}
    for i, t in docs:
        for k, item in items:
            size = min(5, len(low_words(item)))
            if not size:
                continue
            want = Counter(shingles(item, size))
            n = sum(want.values())
            have = shingles(t, size) if len(low_words(t)) >= size else []
            for a in range(len(have)):
                window = Counter(have[a : a + n])
                s = sum((window & want).values()) / sum((window | want).values())
                if s >= 0.75:
                    found[i, k] = max(found.get((i, k), 0), s)
    return found


def without_repeats(docs, size=50):
    first = {}
    for i, t in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        w = words(t)
        for a in range(len(w) - size + 1):
            first.setdefault(tuple(w[a : a + size]), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for a in range(len(w) - size + 1):
            j = first[tuple(w[a : a + size])]
            if j is not None and (i is None or j < i):
                gone[a : a + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    n_dup = len(lines) - len(set(lines))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), symbols, n_dup, len(covered), failed)


def licenses(text, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [
        (i, label) for phrase, label in phrases for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    base = sorted({label for _, label in places})
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(base))


def later_lines(docs):
    """``(doc_id, line_no) -> removed``."""
    first, lines = {}, {}
    for i, t in docs:
        for k, line in enumerate((t or "").split("\n")):
            if s := frozenset(low_words(line)):
                lines[i, k] = s
                first.setdefault(s, (i, k))
    order = sorted(first, key=first.get)
    hit = {
        s for n, s in enumerate(order) if any(100 * len(s & o) >= 75 * len(s | o) for o in order[:n])
    }
    return {p: first[s] != p or s in hit for p, s in lines.items()}


def line_links(docs):
    """``(doc_id, line_no) -> (other lines alike, first line of the first class before its own that is alike)``."""
    lines = {(i, k): s for i, t in docs for k, line in enumerate((t or "").split("\n")) if (s := frozenset(low_words(line)))}
    first = {}
    for p in sorted(lines):
        first.setdefault(lines[p], p)
    alike = lambda s, o: 100 * len(s & o) >= 75 * len(s | o)
    return {
        p: (
            sum(q != p and alike(s, o) for q, o in lines.items()),
            min((q for o, q in first.items() if o != s and q < first[s] and alike(s, o)), default=None),
        )
        for p, s in lines.items()
    }


def tilted_rates(sizes, target, most=2.0):
    """Rates ``min(most, exp(b * size))`` that take ``target`` words, by halving."""
    import math

    rate = lambda b, s: most if b * s >= math.log(most) else math.exp(b * s)
    if target >= most * sum(sizes):
        return [most if s else 1.0 for s in sizes]
    low, high = -100.0, 100.0
    for _ in range(200):
        b = (low + high) / 2
        low, high = (b, high) if sum(s * rate(b, s) for s in sizes) < target else (low, b)
    return [rate(low, s) for s in sizes]
