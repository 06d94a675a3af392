from __future__ import annotations

import itertools
import random
import re
from collections import defaultdict

import pytest

from coldloop.llm import filter_audit as fa
from coldloop.llm.queries import op13_filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"
FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text: str, again: bool) -> str:
    words = WORD.findall(text)
    return "".join(letter for letter, bad in zip("ABCDE", (
        len(words) < 100, 100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text)),
        again)) if bad)


def expected(rows, labels):
    """Every order applied to every document, one by one."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    parts = defaultdict(list)
    for i, text, lang in rows:
        again = i is not None and i > first[text or ""]
        parts[lang or ""].append((i, fails(text or "", again)))
    out, sums = {}, defaultdict(int)
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                failing = [d for d in docs if letter in d[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone),
                    sum(d[1] == letter for d in docs), sum(d[0] in good for d in gone),
                    sum(d[0] in toxic for d in gone)]
                sums[part, letter] += len(gone)
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def corpus(seed: int, n: int = 250):
    rng = random.Random(seed)
    texts = [None, "", "A", "a $", " ".join(f"w{i}" for i in range(120)), "x " * 150, "X" * 300,
             " ".join(f"W{i}" for i in range(20)), "| ".join(f"w{i}" for i in range(130))]
    texts += [" ".join(rng.choices("abcdefgh$ABC", k=rng.randrange(200))) for _ in range(8)]
    rows = [(rng.choice([None, *range(n)]), rng.choice(texts), rng.choice(["en", "de", None, ""]))
            for _ in range(n)]
    labels = [(rng.choice([None, *range(n)]), rng.choice([0, 1, None]), rng.choice([0, 1, None]))
              for _ in range(n)]
    return rows, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_applying_every_order(spark, documents, seed):
    rows, labels = corpus(seed)
    rows += rows[:20]
    documents(labels, LABELS, "labels")
    path = documents(rows, "doc_id long, text string, lang string, good int, n long")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[f] for f in FIELDS)
           for r in op13_filter_audit(spark, path).collect()}
    assert got == expected(rows, labels)


def test_no_documents_and_no_labels(spark, documents):
    documents([], LABELS, "labels")
    assert op13_filter_audit(spark, documents([], "doc_id long, text string, lang string")).collect() == []
    path = documents([(1, None, None)], "doc_id long, text string, lang string")
    rows = op13_filter_audit(spark, path).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""}
    assert sum(r["removed"] for r in rows) == 120  # an empty text fails A alone, once an order


def test_very_long_text(spark, documents):
    documents([], LABELS, "labels")
    path = documents([(1, "w " * 400_000, "en")], "doc_id long, text string, lang string")
    assert sum(r["unique_fails"] for r in op13_filter_audit(spark, path).collect()) == 120


@pytest.mark.parametrize("n", range(2, 7))
def test_plain_changes_visit_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for at in fa.plain_changes(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n))))
    assert sum(1 for _ in fa.plain_changes(n)) == len(seen) - 1


def test_swapping_levels_twice_gives_the_same_diagram():
    rng = random.Random(5)
    masks = {m: (rng.randrange(1, 9), 0, 1) for m in rng.sample(range(32), 17)}
    diagrams = fa.Diagrams()
    top = diagrams.of_masks(masks, 0, 5)
    assert top[0] == tuple(map(sum, zip(*masks.values())))
    for at in range(4):
        once = diagrams.swapped(top, at, {})
        assert once[0] == top[0] and diagrams.swapped(once, at, {}) is top


def test_more_filters_than_orders_allow(spark):
    with pytest.raises(ValueError):
        fa.audit(spark.createDataFrame([], "part string, failures int"), "ABCDEFGH")
