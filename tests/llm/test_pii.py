from __future__ import annotations

import hashlib
import re
import time

from coldloop.llm import pii
from coldloop.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "a@b.c_d@e.f.", "x@y @a.b a@b a@@b.c x%+@q-.1.2,", "1.2.3.4.5 256.1.1.1 0001.2.3.004",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 4111111111111111",
    "é +1 (826) 555-4081 190.137.223.204 du", "+1 555 1234567. +12 +1((((", "é4111111111111111é",
    "IBAN GB82 WEST 1234 5698 7654 32 and GB83WEST12345698765432", "++1 234-567-8 900+3",
]


def valid(kind: str, text: str) -> bool:
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text: str | None) -> list[tuple[str, int, int]]:
    return [(kind, *m.span()) for kind, pattern in PATTERNS.items()
            for m in re.finditer(pattern, text or "") if valid(kind, m[0])]


def test_base_spans_equal_plain_search(spark, documents):
    rows = list(enumerate(TEXTS))
    got = QUERIES["op3_pii"](spark, documents(rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        want = brute(TEXTS[row.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), TEXTS[row.doc_id]
        for kind in PATTERNS:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in want)
        assert set(joined.split(",")) <= {*row.spans.split(","), ""}


def test_spans_inside_failed_runs_and_accounts_are_added():
    kinds = [(s.kind, s.base) for s in pii.find_spans(TEXTS[6])]
    assert kinds == [("card", False), ("card", False)]
    assert [(s.kind, s.start, s.end) for s in pii.find_spans(TEXTS[7]) if not s.base] == [
        ("phone", 2, 19)]
    assert [(s.kind, s.start, s.end) for s in pii.find_spans(TEXTS[10])] == [("iban", 5, 32)]


def test_context_words_move_the_score():
    plain, told = (pii.find_spans(t)[0].score for t in ("x 10.0.0.1", "server 10.0.0.1"))
    assert told > plain > pii.find_spans("version 10.0.0.1")[0].score


def test_context_admits_weak_candidates():
    """A number without a country's prefix and a card of 15 digits, with and without a word."""
    def found(text):
        return [(s.kind, text[s.start: s.end], s.base) for s in pii.find_spans(text)]

    for number, kind, word, against in (("(030) 1234 5678", "phone", "Tel:", "serial"),
                                        ("3782 822463 10005", "card", "visa", "order")):
        assert found(f"took {number} of them") == []
        assert found(f"{word} {number} today") == [(kind, number, False)]
        assert found(f"{word} {against} {number} today") == []
        assert found(f"{word} {'far ' * 20} {number}") == []
    assert found("visa 3782 822463 10006") == []  # fails Luhn
    assert found("call +49 030 1234 5678") == [("phone", "+49 030 1234 5678", True)]
    assert pii.outline([(5, 9), (1, 3), (8, 12), (2, 3)]) == [(1, 3), (5, 12)]
    assert [pii.meets([(1, 3), (5, 12)], *s) for s in ((3, 5), (0, 2), (11, 20), (12, 13))] == [
        False, True, True, False]


def test_long_runs_take_linear_time():
    begin = time.perf_counter()
    for text in ("1" * 300_000 + "@", "a" * 300_000 + "@x", "1 " * 150_000, "+1" * 100_000, "(0" * 150_000, "01 " * 100_000):
        pii.find_spans(text)
    assert time.perf_counter() - begin < 20


def test_redaction_keeps_other_columns_and_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "mail a@b.cd now", 5), (None, None, None), (1, "mail a@b.cd now", 5)],
        "doc_id long, text string, pii int")
    rows = sorted(pii.redact(docs).collect(), key=str)
    assert [tuple(r) for r in rows] == [
        (1, "mail <EMAIL> now", 5), (1, "mail <EMAIL> now", 5), (None, None, None)]
    assert pii.detect(docs).count() == 3 and pii.detect(docs.limit(0)).count() == 0
