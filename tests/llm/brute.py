"""Plain Python twins of the operators, for small tables."""

from __future__ import annotations

import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width=5):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard(rows, percent=75):
    """{row index: (n, component)} for (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1:]}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root, least = roots(range(len(rows)), links), {}
    for i, r in root.items():
        if rows[i][0] is not None:  # a null id names no component
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], len(sets[i]), least.get(root[i], rows[i][0])) for i in range(len(rows))), key=repr)


def token_rows(rows, tokenizer, end=1):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out
