from __future__ import annotations

import zlib

import numpy as np

from coldloop.llm import language_id
from coldloop.llm.queries import QUERIES

WORDS = {"en": "the and of that with this which from have were".split(),
         "fr": "les des une est pour dans qui avec être été".split(),
         "de": "der die und nicht mit für auch über schön groß".split()}


def rows(n=90):
    rng = np.random.default_rng(4)
    out = [(i, " ".join(rng.choice(WORDS[lang], 40)), lang)
           for i, lang in ((i, list(WORDS)[i % 3]) for i in range(n))]
    return out + [(1_000, None, "en"), (1_001, "", "fr"), (1_002, "12 :: 34", "de"),
                  (1_003, "der die und", None), (None, "les des une", "fr")]


def test_held_out_languages_and_odd_rows(spark, documents):
    given = rows()
    got = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, documents(given)).collect()}
    assert len(got) == len(given)
    for i, text, lang in given:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode() if i is not None else b"") % 3 == 1)
        assert 0 <= r.score <= 1
        if i is None or i < 1_000:
            assert r.lang_pred == lang
    assert [got[i].lang_pred for i in (1_000, 1_001, 1_002, 1_003)] == ["und"] * 3 + ["de"]


def test_counts_of_n_grams():
    codes, counts = language_id.grams("Ab, ab!")
    code = {"_": 1, "a": ord("a"), "b": ord("b")}
    want = {}
    for gram in ("a", "b", "_a", "ab", "b_", "_ab", "ab_"):
        packed = 0
        for letter in gram:
            packed = packed << 21 | code[letter]
        want[packed] = 2
    assert dict(zip(codes.tolist(), counts.tolist())) == want
    assert language_id.grams("1 2")[0].size == 0 and language_id.grams("")[0].size == 0


def test_distance_is_out_of_place():
    """Ranks 0, 1, 2 of the document against each profile; an absent n-gram costs the length."""
    codes, counts = language_id.grams("Ab, ab!")
    own = language_id.top(codes, counts, 9).tolist()
    assert own == sorted(own)  # all counts are equal
    known = np.array(own[:3])
    profiles = language_id.Profiles(("x", "y"), known, np.array([[1, 0], [0, 9], [9, 1]]), 9)
    apart = {"x": 1 + 1 + 9 + 4 * 9, "y": 0 + 9 + 1 + 4 * 9}
    assert language_id.nearest("Ab, ab!", profiles) == ("y", 1 - apart["y"] / (9 * 7))


def test_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "les des", "fr", 2)], "doc_id long, text string, lang string, "
                                                           "score int")
    none = language_id.learn(docs.limit(0))
    assert [r.lang_pred for r in language_id.identify(docs, none).collect()] == ["und"]
    profiles = language_id.learn(docs)
    row = language_id.identify(docs, profiles).first()
    assert row.lang_pred == "fr" and row.score == 1.0
    assert language_id.identify(docs.limit(0), profiles).count() == 0
