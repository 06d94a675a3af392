from __future__ import annotations

import random
import time

import duckdb

from coldloop.llm import line_dedup
from coldloop.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import brute


def rows(n=80):
    rng = random.Random(7)
    lines = ["", " ", *(f"line {i}" for i in range(9)), "\t"]
    return [(i, "\n".join(rng.choices(lines, k=rng.randrange(14)))) for i in range(n)]


def test_equals_brute_force_and_statement(spark, documents):
    given = rows()
    folder = documents(given)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = sorted(map(tuple, line_dedup.deduplicate(docs).collect()))
    assert got == brute.line_dedup(given)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, QUERIES["op6_line_dedup"](spark, folder).collect())) == sorted(
        con.execute(ORACLE_SQL["op6_line_dedup"]).fetchall())


def test_long_documents_take_linear_time(spark):
    """Two equal documents of 60,000 lines: one keeps all, one loses all."""
    text = "\n".join(f"line {i}" for i in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, text + "\nits own")], "doc_id long, text string")
    begin = time.monotonic()
    got = sorted(map(tuple, line_dedup.deduplicate(docs).collect()))
    assert got == [(1, 60_000, 0, text), (2, 60_001, 60_000, "its own")]
    assert time.monotonic() - begin < 60


def test_odd_rows(spark):
    text = "a\nb\nc"
    docs = spark.createDataFrame(
        [(None, text, 1), (3, text, 2), (3, text, 3), (4, None, 4), (5, "", 5), (6, "a\n\nb\r\n", 6)],
        "doc_id long, text string, row int")
    got = sorted(map(tuple, line_dedup.deduplicate(docs).collect()), key=str)
    assert got == sorted([(None, 3, 3, ""), (3, 3, 0, text), (3, 3, 0, text), (4, 0, 0, None),
                          (5, 0, 0, ""), (6, 2, 0, "a\n\nb\r\n")], key=str)
    assert line_dedup.deduplicate(docs.limit(0)).count() == 0
