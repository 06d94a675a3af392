from __future__ import annotations

import re

import pytest

from coldloop.llm import quality_rules as q
from coldloop.llm.queries import op11_quality_rules
from tests.llm.corpus import texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
CASES = [
    *texts(60), "a b c a b c", "a a a a", "a b c\nb c a b c", "# * $ % & | < >", "x\n\nx\n x\nx",
    "- one\n* two\n• three", "so …\nand so...\n...\nend", PROSE, PROSE.upper(), PROSE + " $$$$$$$",
    "\n".join([PROSE, *["same line"] * 9]), "1234 5678 " * 40, "Ä ö é ß ж 字", (PROSE + " ") * 400,
]


def expected(text: str | None) -> dict[str, int]:
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    seen: dict[tuple, list[int]] = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    inside = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    joined = "".join(words)
    return {
        "n_words": len(words), "word_chars": len(joined), "n_repeat_words": len(inside),
        "n_symbols": sum(joined.count(c) for c in "#*$%&|<>"), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_letter_words": sum(any(c.isalpha() for c in w) for w in words),
        "n_letters": sum(c.isalpha() for c in joined), "n_upper": len(re.findall("[A-Z]", joined)),
        "n_digits": len(re.findall("[0-9]", joined)),
        "n_bullet_lines": sum(x.lstrip("\t\n\v\f\r ")[:1] in "-*•" for x in lines),
        "n_ellipsis_lines": sum(x.rstrip("\t\n\v\f\r ").endswith(("...", "…")) for x in lines),
    }


def test_measurements_equal_brute_force(spark, documents):
    path = documents([(i, t) for i, t in enumerate(CASES)])
    got = {r["doc_id"]: r for r in q.ledger(spark.read.parquet(f"{path}/documents.parquet")).collect()}
    assert len(got) == len(CASES)
    for i, text in enumerate(CASES):
        assert {m: got[i][m] for m in q.MEASURES} == expected(text), text


def test_each_rule_has_a_document_that_fails_it_alone(spark, documents):
    by_rule = {
        "many_words": " ".join(f"wort{chr(97 + i % 26)}{i % 997}x{i}" for i in range(100_001)),
        "symbols": PROSE + " $$$$$$$", "upper_case": PROSE.upper(),
        "repeated_lines": "\n".join([*PROSE.split()[:60], *["again"] * 60]),
        "words_without_letters": PROSE + " !" * 20 + " ?" * 3,
        "bullets": "\n".join("- " + w for w in PROSE.split()),
        "ellipses": "\n".join(w + "..." for w in PROSE.split()),
        "word_length": " ".join(w * 3 for w in PROSE.split()),
    }
    path = documents(list(enumerate(by_rule.values())))
    rows = q.ledger(spark.read.parquet(f"{path}/documents.parquet")).collect()
    bits = {r.name: 1 << r.bit for r in q.RULES}
    names = list(by_rule)
    for row in rows:
        assert row["failures"] & bits[names[row["doc_id"]]], names[row["doc_id"]]
    assert q.RULES[0].bit == 0 and {r.bit for r in q.RULES} == set(range(len(q.RULES)))


@pytest.fixture
def entries(spark):
    rows = [(i, "en" if i % 3 else "de", (i * 37) % 2048) for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, lang string, failures long"), rows


def test_policies_and_ablations_equal_a_loop(entries):
    table, rows = entries
    mask = q.SECOND.mask()
    kept = {r["doc_id"]: (r["kept"], r["policy"]) for r in q.apply_policy(table, q.SECOND).collect()}
    assert kept == {i: (f & mask == 0, "2") for i, _, f in rows}
    counts = q.mask_counts(table, ["lang"])
    got = {(r["lang"], r["rule"]): r for r in q.ablations(counts, q.SECOND, by=["lang"]).collect()}
    for rule in (r for r in q.RULES if r.name in q.SECOND.rules):
        bit = 1 << rule.bit
        for lang in ("en", "de"):
            mine = [f & mask for _, part, f in rows if part == lang]
            row = got[lang, rule.name]
            assert (row["failing"], row["alone"], row["kept"], row["kept_without"], row["kept_by_it"]) == (
                sum(f & bit > 0 for f in mine), sum(f == bit for f in mine), mine.count(0),
                sum(f & ~bit == 0 for f in mine), sum(f & bit == 0 for f in mine))
    changes = q.policy_changes(q.mask_counts(table), q.FIRST, q.SECOND).first()
    old, new = q.FIRST.mask(), q.SECOND.mask()
    assert changes["now_removed"] == sum(f & old == 0 and f & new > 0 for *_, f in rows)
    assert changes["now_kept"] == sum(f & old > 0 and f & new == 0 for *_, f in rows) > 0
    assert sum(changes) == 3000


def test_odd_tables(spark, documents):
    path = documents([(1, None), (None, "a b"), (1, None), (2, ""), (3, PROSE)])
    rows = op11_quality_rules(spark, path).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["base_failed"], r["kept"]) for r in rows) == [
        (0, 2, True, False), (1, 0, True, False), (1, 0, True, False), (2, 0, True, False),
        (3, 60, False, True)]
    assert op11_quality_rules(spark, documents([])).collect() == []
    clash = spark.createDataFrame([(1, PROSE, 5, "x")], "doc_id long, text string, n_words long, kept string")
    assert q.apply_policy(q.ledger(clash), q.SECOND).first()["n_words"] == 60


def test_a_bit_is_given_once():
    with pytest.raises(ValueError):
        q.failure_bits([q.Rule(1, "a", "n_words = 1"), q.Rule(1, "b", "n_words = 2")])
