from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest

from coldloop.llm import mixture
from coldloop.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import brute


def rows_of(sizes: dict[str | None, list[int]]):
    i, out = 0, []
    for source, each in sizes.items():
        for n in each:
            out.append((i, None if n == 0 else " ".join([f"w{k}" for k in range(n)]), "en", source))
            i += 1
    return out


SIZES = {"b": [300] * 40, "a": [5, 90, 2_000], None: [40] * 30, "ä": [0, 0], "c": [700] * 9}


@pytest.fixture
def folder(documents):
    return documents(rows_of(SIZES))


def test_targets_follow_weights_up_to_twice_the_size(spark, folder):
    got = QUERIES["op2_mixture"](spark, folder).collect()
    totals = {s: sum(n) for s, n in SIZES.items()}
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    open_, target, left = set(order), {}, 1.5 * sum(totals.values())
    while True:
        share = left / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if share * weight[s] > 2 * totals[s]}
        if not above:
            break
        target |= {s: 2 * totals[s] for s in above}
        left -= sum(target[s] for s in above)
        open_ -= above
    target |= {s: share * weight[s] for s in open_}
    source = {i: s for i, _, _, s in rows_of(SIZES)}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == totals[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in order:
        assert taken[s] == pytest.approx(target[s], rel=0.02, abs=40)


def test_equals_its_statement_and_itself(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = sorted(con.execute(ORACLE_SQL["op2_mixture"]).fetchall())
    for _ in range(2):
        assert sorted(map(tuple, QUERIES["op2_mixture"](spark, folder).collect())) == want


def test_apportionment_equals_giving_seats_one_by_one(spark):
    rows = [(g, p, float(v), seats) for g, votes, seats in (
        ("x", [53, 24, 23, 1], 7), ("y", [10, 10, 10], 4), ("z", [0, 0], 0), ("t", [1000, 1], 500),
        ("u", [1] * 30, 45)) for p, v in enumerate(votes)]
    got = mixture.apportion(spark.createDataFrame(
        rows, "g string, p long, votes double, seats long"), ["g"], "p").collect()
    won = {(r.g, r.p): 0 for r in got}
    votes = {(g, p): v for g, p, v, _ in rows}
    for g, seats in {g: n for g, _, _, n in rows}.items():
        for _ in range(seats):
            best = max((k for k in won if k[0] == g),
                       key=lambda k: (votes[k] / (2 * won[k] + 1), -k[1]))
            won[best] += 1
    assert {(r.g, r.p): r.won for r in got} == won


def test_texts_are_taken_as_planned(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = {r.doc_id: r for r in QUERIES["op2_mixture"](spark, folder).collect()}
    rows = mixture.taken_texts(mixture.mix(docs, keep_rows=True)).collect()
    taken = defaultdict(int)
    original = {i: t for i, t, *_ in rows_of(SIZES)}
    for r in rows:
        taken[r.doc_id] += len(brute.words(r.text))
        assert r.text in original[r.doc_id]
        assert r.text == original[r.doc_id] or r.n_chars == len(r.text)
    assert {i: taken[i] for i in plan} == {i: r.taken for i, r in plan.items()}
    assert mixture.mix(docs.limit(0)).count() == 0


def test_fully_taken_documents_keep_their_text(spark):
    """Also those that a shard's run takes after it has wrapped past the end."""
    rows = [(i, "\n\n".join(f"w{i}   x{k}" for k in range(9 + i % 40)), f"s{i % 3}", -1)
            for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    plan = mixture.mix(docs, keep_rows=True).cache()
    want = {r.doc_id: r.copies + (r.words1 == r.size) + (r.words2 == r.size) for r in plan.collect()}
    assert plan.where("words2 = size").count() > 0
    text, whole = {i: t for i, t, *_ in rows}, defaultdict(int)
    for r in mixture.taken_texts(plan).collect():
        if r.text == text[r.doc_id]:
            assert r.n_chars == -1
            whole[r.doc_id] += 1
        else:
            assert len(brute.words(r.text)) < len(brute.words(text[r.doc_id]))
    assert {i: whole[i] for i in want} == want


def test_null_and_repeated_ids_and_clashing_names(spark):
    docs = spark.createDataFrame([(None, "a b", None, 1), (None, "a b", None, 1), (1, "c", "s", 2)],
                                 "doc_id long, text string, source string, shard int")
    got = mixture.mix(docs).collect()
    assert len(got) == 3 and all(r.taken <= 2 * r.size for r in got)
    assert mixture.taken_texts(mixture.mix(docs, keep_rows=True)).columns == docs.columns
