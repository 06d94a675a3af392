"""Small corpora with copies, near copies, shared passages and odd rows."""

from __future__ import annotations

import random

ODD = [None, "", " \n\t ", "a", "one two", "x" * 5_000, "Ünï cödé ß 𝒳 é", "\x00 \x1c   b"]


def texts(n: int = 120, seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    base = rng.choices(vocabulary, k=90)
    out: list[str | None] = list(ODD)
    while len(out) < n:
        kind = rng.random()
        if kind < 0.25:  # near copy of one text
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
        elif kind < 0.45:  # a passage inside other words
            a, b = (rng.choices(vocabulary, k=rng.randrange(30)) for _ in range(2))
            cut = rng.randrange(30)
            out.append("\n".join([" ".join(a), " ".join(passage[cut:]), " ".join(b)]))
        elif kind < 0.55 and len(out) > 20:  # exact copy
            out.append(rng.choice(out[len(ODD):]))
        elif kind < 0.65:  # repetition
            out.append(" ".join(rng.choices(vocabulary[:2], k=rng.randrange(60))))
        else:
            out.append(" ".join(rng.choices(vocabulary, k=rng.randrange(1, 120))).title()
                       if kind < 0.7 else " ".join(rng.choices(vocabulary, k=rng.randrange(120))))
    return out
