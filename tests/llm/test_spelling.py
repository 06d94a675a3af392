from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from coldloop.llm import spelling
from coldloop.llm.queries import op12_spelling
from coldloop.llm.spelling import Numbering, common

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = common(a, b)
    if len(a) == len(b):
        return a[i + 1:] == b[i + 1:]
    a, b = sorted((a, b), key=len)
    return a[i:] == b[i + 1:]


def expected(rows, damaged=199):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if damaged and h % damaged == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    close = {w: [v for v in words if near(w, v)] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, len(close[w]), words.get(forms[w])))
    return out


def corpus(seed: int):
    """Texts of a few stems with edits at all places, runs of equal letters and chains of forms."""
    rng = random.Random(seed)
    stems = ["connection", "aaaaaa", "aabbaabb", "straßenbahn", "élévation", "connexion", "abcdef"]
    words = []
    for stem in stems:
        words += [stem] * 200
        for _ in range(25):
            at, kind, letter = rng.randrange(len(stem) + 1), rng.random(), rng.choice("abcdeéßÿ")
            word = stem[:at] + (letter if kind < .7 else "") + stem[at + (kind > .4):]
            words += [word] * rng.choice([4, 5, 7, 40])
    words += ["chainaaa"] * 700 + ["chainaab"] * 140 + ["chainabb"] * 28 + ["chainbbb"] * 5
    words += ["Éclairs", "éclairs", "ÉCLAIRS"] * 5 + ["short"] * 50 + ["×÷×÷×÷×"] * 6
    rng.shuffle(words)
    cuts = sorted(rng.sample(range(len(words)), 60))
    parts = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)])]
    return [(i, rng.choice([" ", "-", "\n", "1"]).join(p)) for i, p in enumerate(parts)]


@pytest.mark.parametrize("seed, per_range", [(1, 100_000), (2, 9), (3, 2)])
def test_equals_brute_force(spark, documents, monkeypatch, seed, per_range):
    monkeypatch.setattr(spelling, "PER_RANGE", per_range)
    rows = [*corpus(seed), (None, "nullid " * 9), (7, None), (8, ""), (9, "z" * 3000 + " " + "z" * 3000)]
    rows += [(9, "y" * 2000 + " " + "y" * 1999)] * 5
    got = {tuple(r) for r in op12_spelling(spark, documents(rows)).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == expected(rows)
    assert sum(form is not None for _, form, *_ in got) > 10
    assert any(form and root != form for _, form, root, *_ in got)


def test_a_higher_rate_of_damage_and_other_limits(spark, documents):
    rows = corpus(4)
    docs = spark.read.parquet(documents(rows) + "/documents.parquet")
    rule = spelling.Spelling(damaged=3)
    assert {tuple(r) for r in spelling.variants(docs, rule).collect()} == expected(rows, 3)
    assert {tuple(r) for r in spelling.variants(docs, spelling.Spelling(damaged=None)).collect()
            } == expected(rows, None)


def test_no_words(spark, documents):
    assert op12_spelling(spark, documents([])).collect() == []
    assert op12_spelling(spark, documents([(1, None), (2, "tiny words"), (3, "lonelyword")])).collect() == []


@pytest.mark.parametrize("cuts", [[0], [0, 3], [0, 1, 2, 3, 4, 5, 6]])
def test_numbers_are_equal_for_equal_prefixes_only(cuts):
    words = sorted({"", "a", "ab", "abc", "abcd", "abd", "b", "ba", "bab", "babab", "bb" * 50})
    firsts = [words[c] for c in cuts]
    node_of, prefix_of = {}, {}
    for q, (start, stop) in enumerate(zip(cuts, [*cuts[1:], len(words)])):
        numbering = Numbering(q, firsts)
        for word in words[start:stop]:
            nodes = numbering.of(word)
            assert len(nodes) == len(word) + 1
            for i, node in enumerate(nodes):
                assert node_of.setdefault(word[:i], node) == node
                assert prefix_of.setdefault(node, word[:i]) == word[:i]
