from __future__ import annotations

import itertools

from coldloop.llm import jaccard_join, text
from coldloop.llm.queries import QUERIES
from tests.llm import brute, corpus


def test_equals_brute_force(spark, documents):
    rows = list(enumerate(corpus.texts(250, seed=3)))
    got = QUERIES["op8_jaccard_join"](spark, documents(rows)).collect()
    want = brute.jaccard_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert any(i != c for i, (_, c) in want.items())


def test_large_groups_are_compared_in_blocks(spark, documents, monkeypatch):
    """A group beyond one block gives the same components, and no more rows than sets."""
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i % 50] + [f"n{i}"] + base[i % 50 + 1:])) for i in range(300)]
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in QUERIES["op8_jaccard_join"](spark, documents(rows)).collect()}
    assert got == brute.jaccard_components(rows)


def test_boundary_decides_cost_only(spark, documents, monkeypatch):
    rows = list(enumerate(corpus.texts(120, seed=5)))
    folder, want = documents(rows), brute.jaccard_components(rows)
    for boundary in (0, 60, 10_000):
        monkeypatch.setattr(jaccard_join, "cheapest_boundary", lambda _, b=boundary: b)
        got = QUERIES["op8_jaccard_join"](spark, folder).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_cheapest_boundary_counts_rows(spark):
    """A subset is a row, an entry two: three shingles make 3 against 6, nine make 36 against 18."""
    def sets(n, begin, count):
        return [(n, 100 * n // 85, begin, list(range(begin + 1))) for _ in range(count)]

    ordered = spark.createDataFrame(sets(10, 2, 5) + sets(60, 9, 50),
                                    "n long, largest long, begin long, common array<long>")
    # Sets of 10 may link with those of 11, of which there are none.
    assert jaccard_join.cheapest_boundary(ordered) == 0
    few = spark.createDataFrame(sets(6, 1, 50) + sets(7, 2, 5) + sets(8, 2, 5) + sets(60, 9, 50),
                                ordered.schema)
    assert jaccard_join.cheapest_boundary(few) == 8
    assert jaccard_join.cheapest_boundary(few.limit(0)) == 0


def test_written_tables_are_removed(spark, tmp_path, monkeypatch):
    """Left is what the result is read from: sizes and the last round of its components."""
    def numbered(_, label):
        return f"{tmp_path}/{label}-{next(count)}"

    count = itertools.count()
    for module in (text, jaccard_join):
        monkeypatch.setattr(module, "scratch_path", numbered)
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i % 9}") for i in range(60)],
                                 "doc_id long, text string")
    assert jaccard_join.join(docs).count() == 60
    left = {p.name.split("-")[0] for p in tmp_path.iterdir()}
    assert left == {"edges", "set"} and next(count) > 10 > len(list(tmp_path.iterdir()))


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d e", 1), (4, "a b c d e", 2), (4, "x", 3), (2, "A B c d E", 4), (7, None, 5)],
        "doc_id long, text string, component int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard_join.join(docs).collect()), key=str)
    assert got == sorted([(None, 2, None), (4, 2, 2), (4, 1, 2), (2, 2, 2), (7, 0, 7)], key=str)
    assert jaccard_join.join(docs.limit(0)).count() == 0
