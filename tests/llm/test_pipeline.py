from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from coldloop.llm import mixture
from coldloop.llm.queries import END_ID
from tests.llm import brute

WORDS = {"en": [f"the{a}{b}" for a in "abcdef" for b in "nmst"],
         "fr": [f"é{a}{b}eux" for a in "abcdef" for b in "nmst"]}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = np.random.default_rng(9)
    items = [(i, " ".join(rng.choice(WORDS["en"], 25))) for i in range(3)]
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        text = " ".join(rng.choice(WORDS[lang], int(rng.integers(30, 90))))
        if i % 10 == 4:
            text = text + " " + items[i % 3][1]
        if i % 10 == 6:
            text = rows[i - 3][1]
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
    rows += [(60, "12 34 56", "en", None, 8), (61, None, None, None, None), (62, "", "fr", "s1", 0)]
    return rows, items


def test_stages_against_plain_steps(spark, documents):
    rows, items = corpus()
    documents(items, "item_id long, text string", "benchmark")
    folder = documents(rows)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, docs, folder).cache())
        docs = kept[-1]
    assert all(df.columns == COLUMNS for df in kept[:-1])

    plain = [r for r in rows if r[0] < 60]
    assert sorted(map(tuple, kept[0].collect())) == plain
    component = brute.jaccard_components([(r[0], r[1]) for r in plain])
    plain = [r for r in plain if component[r[0]][1] == r[0]]
    assert sorted(map(tuple, kept[1].collect())) == plain and len(plain) < 60
    runs = {tuple(v[p: p + 8]) for _, t in items for v in [t.split()] for p in range(1, len(v) - 7)}
    plain = [r for r in plain if not any(
        tuple(r[1].split()[p: p + 8]) in runs for p in range(len(r[1].split()) - 7))]
    assert sorted(map(tuple, kept[2].collect())) == plain and {r[0] % 10 for r in plain} == {
        *range(10)} - {4, 6}
    taken = {r.doc_id: r.taken for r in mixture.mix(kept[2]).collect()}
    mixed = kept[3].collect()
    sums = {i: sum(len(brute.words(r.text)) for r in mixed if r.doc_id == i) for i in taken}
    assert sums == taken and sum(taken.values()) > 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert END_ID == 2
    start = 0
    files = sorted(kept[4].collect(), key=lambda r: r.start)
    for row, doc in zip(files, sorted(mixed, key=lambda r: (r.doc_id, r.text)), strict=True):
        n = len(tokenizer.encode(doc.text, add_special_tokens=False).ids) + 1
        assert (row.doc_id, row.start, row.n_tokens) == (doc.doc_id, start, n)
        start += n


def test_near_copies_are_judged_on_five_words_at_eighty_hundredths(spark, documents, monkeypatch):
    """Two far changes in 100 words give 86 / 106 on five words, but 89 / 105 on four."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(40):
        text = [f"w{i}x{k}" for k in range(100)]
        rows.append((3 * i, " ".join(text)))
        for j in (1, 2):
            copy = list(text)
            for k in rng.choice(100, int(rng.integers(1, 5)), replace=False):
                copy[k] = f"n{i}x{j}x{k}"
            rows.append((3 * i + j, " ".join(copy)))
    rows += [(200, " ".join(f"y{k}" for k in range(100))),
             (201, " ".join("new" if k in (30, 60) else f"y{k}" for k in range(100)))]
    folder = documents(rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.distinct_documents(spark, docs, folder).collect()}
    four = brute.shingles
    monkeypatch.setattr(brute, "shingles", lambda text: four(text, 5))
    component = brute.jaccard_components(rows, percent=80)
    assert kept == {i for i, (_, c) in component.items() if i == c}
    assert 200 in kept and 201 not in kept and 40 < len(kept) < 120


def test_rows_are_dropped_by_row(spark, documents):
    """Repeated rows, null ids and clean namesakes; a column that has the name of the row number."""
    item = "one apple falls far from that old tree near our house"
    documents([(1, item)], "item_id long, text string", "benchmark")
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    given = [(5, a), (5, a), (None, a), (3, a), (None, b), (None, b), (7, item + " x"), (7, "clean"),
             (None, item)]
    folder = documents([(i, t, None, None, k) for k, (i, t) in enumerate(given)])
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumnRenamed("n_chars", "_row")

    def kept(stage):
        return sorted((given[r._row] for r in stage(spark, docs, folder).collect()), key=str)

    assert kept(corpus_pipeline.distinct_documents) == sorted(
        [(3, a), (None, b), (7, item + " x"), (7, "clean")], key=str)
    assert kept(corpus_pipeline.decontaminated) == sorted(given[:6] + [(7, "clean")], key=str)


def test_short_texts_stay(spark, documents):
    """Too few n-grams for a rank order: only what has no letter goes."""
    rows, items = corpus()
    documents(items, "item_id long, text string", "benchmark")
    short = [(100, "OK.", None, None, 3), (101, "Zq!", None, None, 3), (102, "7 %", None, None, 3)]
    folder = documents(rows + short)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.identified(spark, docs, folder).collect()}
    assert {100, 101} <= kept and 102 not in kept


def test_empty_documents(spark, documents):
    documents([(1, "a b c")], "item_id long, text string", "benchmark")
    assert corpus_pipeline.run(spark, documents([])).count() == 0
