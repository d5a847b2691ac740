"""Brute-force versions of the operators with exact results."""

import collections
import hashlib
import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def decontamination(rows, items):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each (doc_id, text)."""
    windows = collections.defaultdict(set)
    for name, text in items:
        w = PLAIN_WORDS.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k:k + 13])].update([] if name is None else [str(name)])
    out = []
    for doc, text in rows:
        w = PLAIN_WORDS.findall((text or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                names = windows.get(tuple(w[k:k + n]))
                if names is not None:
                    found |= names
                    hit[k:k + n] = [True] * n
        n = sum(hit)
        out.append((doc, len(w), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(w)))
    return out


def shingle_set(text):
    w = BLANK_WORDS.findall((text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < 4 else zip(w, w[1:], w[2:], w[3:]))


def jaccard(rows):
    """(doc_id, n_shingles, component_id) of each (doc_id, text), all pairs compared."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(d, s) for d, s in sets if d is not None and s]
    for i, (a, s) in enumerate(known):
        for b, t in known[:i]:
            if 100 * len(s & t) >= 85 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(d, len(s), None if d is None else root(d)) for d, s in sets]


def near_copies(rows, width, least):
    """(doc_id, n_shingles, component_id) as by jaccard(), for shingles of ``width`` words and ``least`` hundredths of similarity."""
    sets = []
    for d, text in rows:
        w = BLANK_WORDS.findall((text or "").translate(LOWER))
        sets.append((d, frozenset([tuple(w)] if 0 < len(w) < width else zip(*[w[k:] for k in range(width)]))))
    name = {d: d for d, _ in sets if d is not None}
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and 100 * len(s & t) >= least * len(s | t):
                x, y = sorted((name[a], name[b]))
                name = {d: x if c == y else c for d, c in name.items()}
    return [(d, len(s), None if d is None else name[d]) for d, s in sets]


def repeated(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each (doc_id, text)."""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            if d is not None:
                w = b[i:i + 50]
                first[w] = min(d, first.get(w, d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if d is not None and first[b[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, kept))
    return out


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = BLANK_WORDS.findall(text)
    three = list(zip(w, w[1:], w[2:]))
    count, covered = collections.Counter(three), set()
    for k, x in enumerate(three):
        if count[x] > 1:
            covered |= {k, k + 1, k + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK_WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))
