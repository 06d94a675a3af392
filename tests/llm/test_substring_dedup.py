from __future__ import annotations

import pytest

from coldloop.llm import substring_dedup
from coldloop.llm.queries import QUERIES
from tests.llm import brute, corpus


def test_equals_brute_force(spark, documents):
    rows = list(enumerate(corpus.texts(200)))
    got = QUERIES["op1_substring_dedup"](spark, documents(rows)).collect()
    assert sorted(map(tuple, got)) == brute.substring_dedup(rows)


def test_null_and_repeated_ids_and_clashing_names(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(5, passage), (5, passage), (None, "x " + passage), (None, None), (9, passage + " y")]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows],
                                 "doc_id long, text string, bucket int, slice string")
    got = substring_dedup.deduplicate(docs).drop("kept", "spans").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.substring_dedup(rows), key=str)
    spans = substring_dedup.deduplicate(docs).where("doc_id = 9").first()
    assert spans.kept == "y" and [tuple(s) for s in spans.spans] == [(0, 30)]
    assert substring_dedup.deduplicate(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.deduplicate(docs, window=12)
