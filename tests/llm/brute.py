"""Plain definitions of the operators, on lists."""

from __future__ import annotations

import hashlib

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def substring_dedup(rows, n=13):
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text) rows."""
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - n + 1):
            at = tuple(w[k:k + n])
            first[at] = min(key(i), first.get(at, float("inf")))
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < key(i):
                gone[k:k + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n=4):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def jaccard_components(rows, percent=85):
    """doc_id to (n_shingles, component) of (doc_id, text) rows with different ids."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def line_dedup(rows, n=3):
    """(doc_id, n_lines, n_removed, kept) of (doc_id, text) rows with different ids."""
    filled = {i: [k for k, x in enumerate(t.split("\n")) if x.encode().split()] for i, t in rows}
    first = {}
    for i, text in sorted(rows):
        lines, at = text.split("\n"), filled[i]
        for k in range(len(at) - n + 1):
            first.setdefault(tuple(lines[p] for p in at[k:k + n]), (i, k))
    out = []
    for i, text in rows:
        lines, at, gone = text.split("\n"), filled[i], set()
        for k in range(len(at) - n + 1):
            if first[tuple(lines[p] for p in at[k:k + n])] != (i, k):
                gone.update(at[k:k + n])
        out.append((i, len(at), len(gone),
                    "\n".join(x for p, x in enumerate(lines) if p not in gone)))
    return out
