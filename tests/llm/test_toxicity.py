from __future__ import annotations

import random
import zlib

import pytest

from coldloop.llm import toxicity
from coldloop.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i, *row[1:]]
        last = i - 1
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(1)
    terms = ["idiot", "moron", "scum", "stupid", "stump"]
    lexicon = toxicity.Lexicon(tuple((t, 9.0) for t in terms), (("low", 3.0),))
    machine = toxicity.Automaton(lexicon)
    words = terms + ["".join(rng.choices("idotmrnsucpl", k=rng.randrange(9))) for _ in range(3_000)]
    for t in terms:
        for _ in range(60):
            letters = list(t)
            for _ in range(rng.randrange(1, 3)):
                at = rng.randrange(len(letters) + 1)
                letters[at: at + rng.randrange(2)] = rng.choice(["", "x", "i"])
            words.append("".join(letters))
    for word in words:
        reach = [(distance(word, t), t) for t in terms]
        near = [d for d, t in reach if d == 0 or (d == 1 and len(t) >= toxicity.FUZZY_LENGTH)]
        want = 0 if word.startswith("low") else min(near, default=None)
        got = machine.look_up(word)
        assert (got and got[0]) == want, word


@pytest.fixture
def tables(documents):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("aeiouklmnprst", k=rng.randrange(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(240):
        text = rng.choices(vocabulary, k=rng.randrange(20, 80))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(["vermin", "dunghead", "creep"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    docs += [(900, None), (901, ""), (None, "vermin creep vermin dunghead creep"),
             (902, "vermim and dunghaed creap and verrmin you dungheed")]
    labels += [(None, 1, 1), (903, 1, None), (5, None, None)]
    documents(labels, "doc_id long, quality int, toxic int", "labels")
    return documents(docs), {i: t for i, _, t in labels}


def test_held_out_and_odd_rows(spark, tables):
    folder, toxic = tables
    got = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, folder).collect()}
    assert len(got) == 244
    held = [r for i, r in got.items() if i is not None and i < 240 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
               for i, r in got.items() if i is not None)
    right = [r.predicted == toxic[r.doc_id] for r in held if toxic[r.doc_id] is not None]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[None].predicted == 1 and got[900].predicted == got[901].predicted == 0
    assert got[902].score > got[901].score


def test_quotation_counts_apart():
    import pyarrow as pa
    lexicon = toxicity.Lexicon((("idiot", 9.0),), ())
    plain, quoted, reported = toxicity.features(pa.array([
        "you idiot go", 'they used the "idiot" word', "then said idiot twice"]), lexicon)
    assert plain[2] > 0 and plain[4] == 0
    assert quoted[2] == 0 and quoted[4] > 0 and reported[4] > 0


def test_one_class_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", 7)], "doc_id long, text string, score int")
    rows = spark.createDataFrame([(1, "a", 0)], "id long, text string, label int")
    assert toxicity.learn(rows) is None
    assert [r.score for r in toxicity.score(docs, None).collect()] == [0.0]
    model = toxicity.Model(toxicity.Lexicon((), ()), (0.0,) * 8)
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.5]
