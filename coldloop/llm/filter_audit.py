"""What each filter of a chain does in each order of the chain, from diagrams of failure masks.

A document's failure mask has one bit per filter. Masks are counted per part (a language, say)
before anything else, so a part is at most two to the number of filters rows, whatever its
documents. A part's masks become a decision diagram: a node per filter and distinct remainder,
with what passes and what fails below it, and the weight of all documents that reach it. The order
of two neighbouring filters is changed by swapping two levels of the diagram, and plain changes
walk through all orders that way. In any order, the path on which every filter passes has the
steps of the chain: what fails at a node is removed there, and what passes is kept.

Null texts count as empty, null parts as the empty part. A document fails the filter of repeated
texts when a smaller id has the same text anywhere in the table; rows without an id neither fail
it nor make others fail, and rows that repeat an id are no smaller ids. Texts are compared by
their SHA-256. An empty table has no parts and no rows. Labels may repeat an id: one row that
holds suffices. All filters see the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coldloop.llm.text import WORD, word_count

Weights = tuple[int, ...]
STEPS = ("part string, filter_order string, step int, filter string, kept long, removed long, "
         "redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")
#: Orders grow as the factorial of the filters, and every one has its rows in the result.
MOST_FILTERS = 7


def few_words(text: Column) -> Column:
    return word_count(text) < 100


def repetitive(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return 100 * F.size(F.array_distinct(words)) < 80 * F.size(words)


def upper_case(text: Column) -> Column:
    return 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text)


def symbols(text: Column) -> Column:
    return text.rlike(r"[#$%&*|]")


#: Filters that see one text, and the letter of the one that sees all texts.
ROW_FILTERS: dict[str, Callable[[Column], Column]] = {
    "A": few_words, "B": repetitive, "C": upper_case, "D": symbols}
REPEATED = "E"


def counted_masks(docs: DataFrame, labels: DataFrame,
                  filters: dict[str, Callable[[Column], Column]] | None = None,
                  repeated: str | None = REPEATED, part: str = "lang", id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """(part, failures, documents, good, toxic): documents per part and mask, all and labelled.

    Bit k stands for the k-th letter, that of repeated texts last.
    """
    filters = ROW_FILTERS if filters is None else filters
    text = F.coalesce(F.col(text_column), F.lit(""))
    bits = F.lit(0)
    for k, fails in enumerate(filters.values()):
        bits = bits.bitwiseOR(F.when(fails(text), 1 << k).otherwise(0))
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        bits.alias("failures"), F.unhex(F.sha2(text, 256)).alias("digest"))
    marks = labels.groupBy(F.col(id_column).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    of = ["digest", "part", "failures", "good", "toxic"]
    rows = (rows.join(marks, "id", "left")
            .fillna(False, ["good", "toxic"]).groupBy("id", *of).agg(F.count("*").alias("n")))
    # Copies of one text become a few rows here, before their smallest id is looked for.
    kinds = rows.groupBy(*of).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n"))).alias("unnamed"),
        F.min("id").alias("least"), F.min_by("n", "id").alias("at_least"))
    first = F.min("least").over(Window.partitionBy("digest"))
    stay = F.coalesce("unnamed", F.lit(0)) + F.when(F.col("least") == F.col("first"),
                                                    F.col("at_least")).otherwise(0)
    again = F.col("failures").bitwiseOR(F.lit(1 << len(filters)))
    split = kinds.withColumn("first", first).withColumn(
        "stay", F.col("n") if repeated is None else stay).select(
            "part", "good", "toxic", F.inline(F.array(
                F.struct(F.col("failures"), F.col("stay").alias("n")),
                F.struct(again.alias("failures"), (F.col("n") - F.col("stay")).alias("n")))))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    return split.where("n > 0").groupBy("part", "failures").agg(
        total(F.lit(True)).alias("documents"), total(F.col("good")).alias("good"),
        total(F.col("toxic")).alias("toxic"))


class Diagrams:
    """Shared nodes: a leaf is (weights,), a node is (weights, passing, failing).

    ``None`` is the diagram of no documents, at any level. Equal diagrams are one object, so a
    remainder that several branches have in common is swapped once.
    """

    def __init__(self) -> None:
        self.known: dict[tuple, tuple] = {}

    def shared(self, key: tuple) -> tuple:
        return self.known.setdefault(key, key)

    def node(self, passing: tuple | None, failing: tuple | None) -> tuple | None:
        if passing is None and failing is None:
            return None
        weights = tuple(map(sum, zip(*(side[0] for side in (passing, failing) if side))))
        return self.shared((weights, passing, failing))

    def of_masks(self, masks: dict[int, Weights], level: int, levels: int) -> tuple | None:
        """The diagram of masks that agree on the filters above ``level``."""
        if not masks:
            return None
        if level == levels:
            return self.shared((next(iter(masks.values())),))
        sides: tuple[dict, dict] = ({}, {})
        for mask, weights in masks.items():
            sides[mask >> level & 1][mask] = weights
        return self.node(*(self.of_masks(side, level + 1, levels) for side in sides))

    def swapped(self, top: tuple | None, level: int, done: dict[int, tuple | None]) -> tuple | None:
        """``top`` with the filters at ``level`` and the one below it exchanged."""
        if top is None:
            return None
        if id(top) not in done:
            _, passing, failing = top
            if level:
                sides = (self.swapped(passing, level - 1, done),
                         self.swapped(failing, level - 1, done))
            else:
                (_, pp, pf), (_, fp, ff) = passing or (0, None, None), failing or (0, None, None)
                sides = self.node(pp, fp), self.node(pf, ff)
            done[id(top)] = self.node(*sides)
        return done[id(top)]


def plain_changes(n: int) -> Iterator[int]:
    """Positions of the neighbours to swap, one by one, to pass through all orders of ``n``."""
    if n < 2:
        return
    for turn, inner in enumerate([*plain_changes(n - 1), None]):
        yield from range(n - 2, -1, -1) if turn % 2 == 0 else range(n - 1)
        if inner is not None:  # the last element stands at the front, then at the back
            yield inner + 1 if turn % 2 == 0 else inner


def all_pass_path(top: tuple | None, levels: int, zero: Weights) -> list[tuple[Weights, Weights]]:
    """What is kept and removed at each level when all filters above pass."""
    path = []
    for _ in range(levels):
        passing, failing = (top[1], top[2]) if top else (None, None)
        path.append((passing[0] if passing else zero, failing[0] if failing else zero))
        top = passing
    return path


def audited(masks: dict[int, Weights], letters: str) -> Iterator[tuple]:
    """(order, step, letter, kept, removed, redundant, unique, good, toxic, shapley) of a part."""
    n, zero = len(letters), (0, 0, 0)
    diagrams, order = Diagrams(), list(letters)
    top = diagrams.of_masks(masks, 0, n)
    paths = {letters: all_pass_path(top, n, zero)}
    for at in plain_changes(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        top = diagrams.swapped(top, at, {})
        paths["".join(order)] = all_pass_path(top, n, zero)
    # A filter that comes first removes all that fail it; one that comes last, those of its own.
    failing, alone = {}, {}
    shapley = dict.fromkeys(letters, 0)
    for name, path in paths.items():
        failing[name[0]], alone[name[-1]] = path[0][1][0], path[-1][1][0]
        for letter, (_, removed) in zip(name, path):
            shapley[letter] += removed[0]
    for name in sorted(paths):
        for step, (letter, (kept, removed)) in enumerate(zip(name, paths[name]), 1):
            yield (name, step, letter, kept[0], removed[0], failing[letter] - removed[0],
                   alone[letter], removed[1], removed[2], shapley[letter])


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """All orders and steps of the filters ``letters`` per part of ``counted_masks``."""
    if len(letters) > MOST_FILTERS:
        raise ValueError(f"{math.factorial(len(letters))} orders; at most {MOST_FILTERS} filters")

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        masks = {int(r.failures): (int(r.documents), int(r.good), int(r.toxic))
                 for r in rows.itertuples()}
        steps = pd.DataFrame(audited(masks, letters), columns=[
            "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails",
            "good_lost", "toxic_lost", "shapley"])
        steps.insert(0, "part", rows["part"].iloc[0])
        return steps

    return counts.groupBy("part").applyInPandas(of_part, STEPS)


def letters_of(filters: Sequence[str] = tuple(ROW_FILTERS), repeated: str | None = REPEATED) -> str:
    return "".join(filters) + (repeated or "")
