"""Quality rules: one ledger of failure bits and measurements, policies and ablations on it.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule, so a policy, which is a version and a set of rules, is a mask: a document stays when
no bit of the mask is set, and no text is read again for another version. What each rule of a
policy does alone or beside the others is counted on the distinct masks, of which there are at
most two to the number of rules, whatever the number of documents.

Null texts count as empty: all measurements are 0. Repeated rows, rows without an id and other
columns pass through as they are; an empty table gives an empty ledger. A text is measured as a
whole, however long, inside one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.llm.text import slices, words

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_letter_words", "n_letters", "n_upper", "n_digits", "n_bullet_lines", "n_ellipsis_lines",
)
#: What is counted in each word, as patterns of one character.
IN_WORDS = {"n_symbols": r"[#*$%&|<>]", "n_letters": r"\p{L}", "n_upper": "[A-Z]",
            "n_digits": "[0-9]"}
HAS_WORD = r"[^\x20\x09-\x0D]"
BULLET = r"^[\x20\x09-\x0D]*[-*•]"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09-\x0D]*$"
#: Words per window whose repetition counts.
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """A failure condition over measurements. A bit is never given to another rule."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_words", "n_words > 100000"),
    Rule(3, "word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    Rule(4, "symbols", "10 * n_symbols > n_words"),
    Rule(5, "repeated_lines", "10 * n_dup_lines > 3 * n_lines AND n_dup_lines > 2"),
    Rule(6, "words_without_letters", "10 * n_letter_words < 8 * n_words"),
    Rule(7, "upper_case", "2 * n_upper > n_letters"),
    Rule(8, "digits", "4 * n_digits > word_chars"),
    Rule(9, "bullets", "10 * n_bullet_lines > 9 * n_lines"),
    Rule(10, "ellipses", "10 * n_ellipsis_lines > 3 * n_lines"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the rules that remove documents."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {rule.name: 1 << rule.bit for rule in rules}
        return sum(bits[name] for name in self.rules)


#: The two rules that every other policy holds as well.
BASE = Policy("base", ("few_words", "repeated_words"))
#: The usual limits for web text, of which the greatest length drops long clean documents.
FIRST = Policy("1", (*BASE.rules, "many_words", "word_length", "symbols", "repeated_lines",
                     "words_without_letters", "bullets", "ellipses"))
#: In use: any length, and no documents in capitals or digits.
SECOND = Policy("2", (*BASE.rules, "word_length", "symbols", "repeated_lines",
                      "words_without_letters", "bullets", "ellipses", "upper_case", "digits"))


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    before = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return before[bounds[1:]] - before[bounds[:-1]]


def repeated(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which words lie in a window of three that its text holds twice or more."""
    inside = np.zeros(len(codes) + 1, np.int64)
    if len(codes) >= WINDOW:
        base = int(codes.max()) + 1
        key = codes[:len(codes) - WINDOW + 1]
        for k in range(1, WINDOW):  # numbers of the runs so far keep the key within 64 bits
            key = np.unique(key, return_inverse=True)[1] * base
            key = key + codes[k:len(codes) - WINDOW + 1 + k]
        first = np.flatnonzero(text[:len(key)] == text[WINDOW - 1:])
        order = first[np.argsort(key[first], kind="stable")]
        twice = (key[order[1:]] == key[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        starts = np.union1d(order[1:][twice], order[:-1][twice])
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + WINDOW, -1)
    return np.cumsum(inside[:-1]) > 0


def measured(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of a slice of texts."""
    n = len(texts)
    bounds, codes, distinct = words(texts)
    out = {"n_words": np.diff(bounds)}
    for name, pattern in IN_WORDS.items():
        counts = pc.count_substring_regex(distinct, pattern).to_numpy(zero_copy_only=False)
        out[name] = per_text(counts[codes], bounds)
    lengths = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
    letters = pc.match_substring_regex(distinct, r"\p{L}").to_numpy(zero_copy_only=False)
    out["word_chars"] = per_text(lengths[codes], bounds)
    out["n_letter_words"] = per_text(letters[codes], bounds)
    text = np.repeat(np.arange(n), out["n_words"])
    out["n_repeat_words"] = per_text(repeated(codes, text), bounds)

    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines, of = split.flatten(), pc.list_parent_indices(split)
    filled = pc.match_substring_regex(lines, HAS_WORD)
    lines, of = lines.filter(filled), of.filter(filled).to_numpy(zero_copy_only=False)
    out["n_lines"] = np.bincount(of, minlength=n)
    coded = lines.dictionary_encode()
    line = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    different = np.unique(of * (len(coded.dictionary) + 1) + line) // (len(coded.dictionary) + 1)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(different, minlength=n)
    for name, pattern in (("n_bullet_lines", BULLET), ("n_ellipsis_lines", ELLIPSIS)):
        found = pc.match_substring_regex(coded.dictionary, pattern).to_numpy(zero_copy_only=False)
        out[name] = np.bincount(of[found[line]], minlength=n)
    return out


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """One row per document: its id, the measurements and ``failures``, a bit per failed rule."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)]
                          + [T.StructField(name, T.LongType()) for name in MEASURES])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = measured(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)],
                names=["id", *MEASURES])

    measures = rows.mapInArrow(measure, schema)
    return measures.select(F.col("id").alias(id_column), *MEASURES,
                           failure_bits(rules).alias("failures"))


def failure_bits(rules: Sequence[Rule]) -> Column:
    if len({rule.bit for rule in rules}) < len(rules):
        raise ValueError("two rules have the same bit")
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0)
                              .cast("long"))
    return bits


def broken(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """The bits of the policy's rules that a document fails."""
    return F.col("failures").bitwiseAND(F.lit(policy.mask(rules)).cast("long"))


def apply_policy(entries: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Ledger rows with ``kept`` and ``policy``, the version that decided."""
    return entries.withColumns({"kept": broken(policy, rules) == 0,
                                "policy": F.lit(policy.version)})


def mask_counts(entries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Documents per distinct failure mask: few rows, on which every ablation is counted."""
    return entries.groupBy(*by, "failures").agg(F.count("*").alias("documents"))


def ablations(counts: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES,
              by: Sequence[str] = ()) -> DataFrame:
    """Per rule of the policy, over ``mask_counts``.

    ``failing`` fail it, ``alone`` fail no other rule of the policy, ``kept`` is what the policy
    keeps, ``kept_without`` what it keeps without the rule, ``kept_by_it`` what the rule keeps if
    it is the only one.
    """
    mine = [rule for rule in rules if rule.name in policy.rules]
    bit = F.col("rule.bit")
    hit, rest = (broken(policy, rules).bitwiseAND(bit),
                 broken(policy, rules).bitwiseAND(F.bitwise_not(bit)))

    def documents(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("documents"))), F.lit(0)).cast("long")

    table = F.array(*(F.struct(F.lit(r.name).alias("name"),
                               F.lit(1 << r.bit).cast("long").alias("bit")) for r in mine))
    return (
        counts.select("*", F.explode(table).alias("rule"))
        .groupBy(*by, F.col("rule.name").alias("rule"))
        .agg(documents(hit != 0).alias("failing"),
             documents((hit != 0) & (rest == 0)).alias("alone"),
             documents((hit == 0) & (rest == 0)).alias("kept"),
             documents(rest == 0).alias("kept_without"),
             documents(hit == 0).alias("kept_by_it")))


def policy_changes(counts: DataFrame, old: Policy, new: Policy,
                   rules: Sequence[Rule] = RULES, by: Sequence[str] = ()) -> DataFrame:
    """Documents that both versions keep, only one keeps, or none."""
    before, after = broken(old, rules) == 0, broken(new, rules) == 0
    return counts.groupBy(*by).agg(*(
        F.coalesce(F.sum(F.when(condition, F.col("documents"))), F.lit(0)).cast("long").alias(name)
        for name, condition in (("kept_by_both", before & after), ("now_removed", before & ~after),
                                ("now_kept", ~before & after), ("removed_by_both", ~before & ~after))))
