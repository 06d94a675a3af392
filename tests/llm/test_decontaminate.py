from __future__ import annotations

import pyarrow as pa

import corpus_pipeline
from coldloop.llm import decontaminate
from coldloop.llm.queries import QUERIES

ITEM = ("A train leaves Paris at 9 o'clock and travels 120 km before it meets the second train "
        "that left Paris at 9 o'clock too. How far is it?")
ITEMS = [(1, ITEM), (2, None), (3, ""), (4, "Short item."), (5, "12 13 14 15 16 17 18 19 20")]
DOCS = {
    10: "before. " + ITEM + " After",
    11: ITEM.replace("Paris", "Berlin").replace("9", "7").replace("120", "80"),
    12: ITEM.replace("Paris", "Berlin", 1).replace("9", "7"),  # Paris stands for two names
    13: ITEM.upper(),
    14: "nothing to see here, only other words of no importance at all",
    15: None, 16: "", 17: "we saw a Short item. indeed", 18: "12 13 14 15 16 17 18 19 20",
    19: "it meets the second train that left nobody",
}


def found(spark, rows, items=ITEMS):
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return decontaminate.leaks(docs, bench).collect()


def test_templates_are_found_and_slots_checked(spark):
    rows = [(i, t) for i, t in DOCS.items()]
    got = {(r.doc_id, r.item_id): r for r in found(spark, rows)}
    assert got[10, 1].kind == "verbatim" and got[10, 1].matched_words >= got[10, 1].item_words - 1
    assert got[11, 1].kind == "reparameterised"
    assert got[13, 1].matched_words >= 8
    assert (17, 4) in got
    assert not {14, 15, 16, 18, 19} & {d for d, _ in got}
    # The part around the two different names is left out of the match.
    assert (12, 1) not in got or got[12, 1].matched_words < got[11, 1].matched_words


def matched(text, item):
    """(matched words, first word, kind) of one text against one item, or None."""
    index = decontaminate.Index([1], [item])
    got = list(decontaminate.matches(decontaminate.templates(pa.array([text])), index))
    return got[0][2:] if got else None


def test_runs_that_disagree_are_cut(spark):
    got = {r.doc_id: r for r in found(spark, list(DOCS.items()))}
    # The first name is left out with what is before it; the rest agrees on 7 for 9.
    assert got[12].matched_words == got[11].matched_words - 3 and got[12].at_word == 4
    assert got[12].kind == "reparameterised"
    lots = ("they bought 12 red apples and then again at the market on the far side of the river "
            "they sold 12 of them to a man who gave nothing back for all of these")
    assert matched(lots.replace("12", "31", 1), lots)[0] >= 25
    two = "if you have 3 apples and 4 pears then how much fruit is it that you have"
    assert matched(two.replace("3", "5").replace("4", "5"), two)[2] == "reparameterised"
    # No eight words agree: the number stands for something else every few words.
    often = "a 5 b c 5 d e 5 f g 5 h i 5 j k 5 l"
    assert matched("a 1 b c 2 d e 3 f g 4 h i 6 j k 7 l", often) is None


def test_verbatim_copies_of_numbers_and_names_are_found(spark, documents):
    """The query and the pipeline's stage, on items that have windows with few literal words."""
    long = "Add them: 12 13 14 15 16 17 18 19 20 and then you have the whole sum of it"
    items = [(1, "12 13 14 15 16 17 18 19 20"), (2, "Meet Ada Byron Alan Turing Grace Hopper Kurt Goedel"),
             (3, "Sum 41 42 43"), (4, long)]
    documents(items, "item_id long, text string", "benchmark")
    folder = documents([
        (1, "x 12 13 14 15 16 17 18 19 20, y"), (2, "12 13 14 15 16 17 18 19 21"),
        (3, "we saw Meet Ada Byron Alan Turing Grace Hopper Kurt Goedel again"),
        (4, "we saw Meet Eve Byron Adam Turing Grace Murray Kurt Goedel again"),
        (5, "the sum 41 42 43 here"), (6, "the sum 41 42 44 here and 42 43"), (7, long)])
    got = {(r.doc_id, r.item_id): r for r in QUERIES["op4_decontamination"](spark, folder).collect()}
    assert set(got) == {(1, 1), (1, 4), (2, 4), (3, 2), (5, 3), (7, 1), (7, 4)}
    assert {r.kind for r in got.values()} == {"verbatim"}
    assert got[7, 4].matched_words == got[7, 4].item_words - 1
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.decontaminated(spark, docs, folder)
    assert {r.doc_id for r in kept.collect()} == {4, 6}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rows = [(i, t) for i, t in DOCS.items()] * 2 + [(None, ITEM)]
    once = sorted(map(tuple, found(spark, rows)), key=str)
    monkeypatch.setattr(decontaminate, "ITEMS", 2)
    assert sorted(map(tuple, found(spark, rows)), key=str) == once
    assert [r for r in once if r[0] is None] and len([r for r in once if r[0] == 10]) == 2


def test_empty_tables(spark):
    assert found(spark, [(1, ITEM)], items=[(1, None)]) == []
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.leaks(docs, bench).count() == 0


def test_equals_plain_search_on_lower_case_words(spark):
    """Without numbers and names a template match is a run of equal words."""
    import random
    rng = random.Random(3)
    words = [f"q{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(5)]
    items = [(i, " ".join(rng.choices(words, k=20))) for i in range(6)]
    docs = []
    for i in range(60):
        text = rng.choices(words, k=30)
        item = items[rng.randrange(6)][1].split()
        a = rng.randrange(20)
        docs.append((i, " ".join(text[:10] + item[a: a + rng.randrange(14)] + text[10:])))
    want = set()
    for i, text in docs:
        w = text.split()
        for k, item in items:
            v = item.split()[1:]
            runs = {tuple(v[p: p + 8]) for p in range(len(v) - 7)}
            if any(tuple(w[p: p + 8]) in runs for p in range(len(w) - 7)):
                want.add((i, k))
    assert {(r.doc_id, r.item_id) for r in found(spark, docs, items)} == want and want
