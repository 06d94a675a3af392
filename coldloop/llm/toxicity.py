"""Toxicity: a lexicon trie walked by Levenshtein automata, with context-window scores.

The lexicon is learned: words, and beginnings of words, that occur in many different contexts of
toxic documents and hardly in others. A word is looked up by running it through the
intersection of the lexicon's trie with a Levenshtein automaton of distance 1, made
deterministic as it is needed, so a lookup costs one step per letter and catches misspelled
terms. A window around each hit tells quotation (quotation marks, words of reporting) from abuse
(further hits nearby). A logistic model turns a document's hits into its score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.llm.text import WORD, slices, stored, words

#: Labelled documents per class that the model is learned from (the expected number, by a hash
#: of the id; a class with fewer gives all).
DOCS_PER_CLASS = 3_000
#: Lexicon: contexts a term must have in toxic documents, how many times as frequent it must be
#: there, the lengths of beginnings, and from which frequency and length on a word may be misspelled.
LEAST_CONTEXTS, LEAST_RATIO, SHORTEST, LONGEST_BEGINNING = 6, 8.0, 3, 8
FUZZY_RATIO, FUZZY_LENGTH = 100.0, 5
#: Words on either side of a hit that count as its context.
WINDOW = 6
# Marks around words, quotation marks among them, and words of reporting.
MARKS = ".,!?;:\"'()[]{}*%$&#|<>-_/\\“”«»„‘’"
QUOTES = "\"“”«»„"
REPORTING = frozenset("said says quote quoted wrote called dit citait sagte schrieb dijo".split())


@dataclass(frozen=True)
class Lexicon:
    """Whole words and beginnings of words, each with the logarithm of how many times as frequent
    it is in toxic documents; whole words from ``FUZZY_RATIO`` on may be misspelled."""

    whole: tuple[tuple[str, float], ...]
    beginnings: tuple[tuple[str, float], ...]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: tuple[float, ...]


class Automaton:
    """The trie of a lexicon intersected with Levenshtein automata, as a lazy DFA.

    A state is a set of (trie node, edits used). Node 0 is the root; a node's children are in
    ``next``. The result of a word is the least number of edits to a term and its weight, or None.
    """

    def __init__(self, lexicon: Lexicon) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.whole: dict[int, float] = {}
        self.beginning: dict[int, float] = {}
        self.fuzzy: set[int] = set()  # nodes on the way to a word that may be misspelled
        for terms, ends in ((lexicon.whole, self.whole), (lexicon.beginnings, self.beginning)):
            for term, weight in terms:
                path = [0]
                for letter in term:
                    at = self.next[path[-1]]
                    if letter not in at:
                        at[letter] = len(self.next)
                        self.next.append({})
                    path.append(at[letter])
                ends[path[-1]] = weight
                if (ends is self.whole and len(term) >= FUZZY_LENGTH
                        and weight >= np.log(FUZZY_RATIO)):
                    self.fuzzy.update(path)
        self.start = self._closed({(0, 0)})
        self.steps: dict[frozenset, dict[str, frozenset]] = {}

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """With the nodes that are reached by leaving out a letter of the term."""
        more = {(child, 1) for node, edits in states if edits == 0
                for child in self.next[node].values() if child in self.fuzzy}
        return frozenset(states | more)

    def _step(self, states: frozenset, letter: str) -> frozenset:
        found = set()
        for node, edits in states:
            if letter in self.next[node]:
                child = self.next[node][letter]
                if edits == 0 or child in self.fuzzy:
                    found.add((child, edits))
            if edits == 0:
                if node in self.fuzzy:
                    found.add((node, 1))
                found.update((child, 1) for child in self.next[node].values()
                             if child in self.fuzzy)
        return self._closed(found)

    def look_up(self, word: str) -> tuple[int, float] | None:
        states, begun = self.start, 0.0
        for letter in word:
            step = self.steps.setdefault(states, {})
            following = step.get(letter)
            if following is None:
                following = step[letter] = self._step(states, letter)
            states = following
            if not states:
                break
            for node, edits in states:
                if edits == 0 and node in self.beginning:
                    begun = max(begun, self.beginning[node])
        ends = [(edits, self.whole[node]) for node, edits in states if node in self.whole
                and (edits == 0 or node in self.fuzzy)]
        exact = max([begun, *(weight for edits, weight in ends if edits == 0)])
        if exact:
            return 0, exact
        return max(ends, default=None)


@cache
def automaton(lexicon: Lexicon) -> Automaton:
    """One automaton per Python worker and lexicon."""
    return Automaton(lexicon)


def bare(word: str) -> str:
    return word.lower().strip(MARKS)


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """What a text's hits say, one row per whole text.

    Weights of exact hits (as sum and as density), numbers of hits that are nearly certain,
    misspelled, quoted and close to another, and the length, from 20 words on. A quoted hit
    counts as such only.
    """
    bounds, codes, distinct = words(texts)
    machine, listed = automaton(lexicon), distinct.to_pylist()
    found = [machine.look_up(bare(word)) for word in listed]
    flag = np.fromiter((f is not None for f in found), bool, len(found))
    at = np.flatnonzero(flag[codes]) if len(codes) else np.zeros(0, np.int64)
    doc = np.searchsorted(bounds, at, "right") - 1
    size = np.diff(bounds)
    weight, counts = np.zeros(len(texts)), np.zeros((len(texts), 4))
    for place, d in zip(at.tolist(), doc.tolist()):
        low, high = max(bounds[d], place - WINDOW), min(bounds[d + 1], place + WINDOW + 1)
        edits, value = found[codes[place]]
        if is_quoted([listed[c] for c in codes[low:high].tolist()], place - low):
            counts[d, 2] += 1
        elif edits:
            counts[d, 1] += 1
        else:
            counts[d, 0] += value >= np.log(FUZZY_RATIO)
            weight[d] += value
    together = np.flatnonzero((np.diff(doc) == 0) & (np.diff(at) <= WINDOW))
    np.add.at(counts[:, 3], doc[together], 1)
    return np.column_stack([
        np.log1p(weight), np.log1p(100 * weight / np.maximum(size, 20)), np.log1p(counts),
        np.log1p(np.maximum(size, 20)), np.ones(len(texts))])


def is_quoted(near: list[str], i: int) -> bool:
    """Whether the word stands between quotation marks or beside a word of reporting."""
    opened = any(w[0] in QUOTES for w in near[: i + 1])
    closed = any(w.rstrip(".,!?;:")[-1:] in QUOTES for w in near[i:] if w)
    return (opened and closed) or any(bare(w) in REPORTING for w in near)


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, other): how often words and beginnings (closed by ``*``) occur.

    In toxic documents different neighbourhoods of a word count, so that copies of a document
    do not make a term; in others all occurrences do.
    """
    bare_words = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(f"({WORD})"), F.lit(1)),
                             lambda w: F.btrim(w, F.lit(MARKS)))

    def with_context(word: Column, i: Column) -> Column:
        around = F.xxhash64(F.get("words", i - 1), F.get("words", i + 1))
        return F.struct(word.alias("word"), around.alias("around"))

    each = rows.withColumn("words", bare_words).select(
        "label", F.inline(F.transform("words", with_context)))
    by_word = each.groupBy("word").agg(
        F.countDistinct(F.when(F.col("label") == 1, F.col("around"))).alias("toxic"),
        F.count(F.when(F.col("label") == 0, 1)).alias("other"))
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST_BEGINNING)))
    terms = F.concat(F.array("word"), F.transform(lengths, lambda n: F.concat(
        F.substring(F.col("word"), F.lit(1), n), F.lit("*"))))
    return (
        by_word.where(F.length("word") >= SHORTEST)
        .select(F.explode(terms).alias("term"), "toxic", "other")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """The terms that tell the classes apart.

    Of terms with nearly the same occurrences the longest stays; below a beginning only clearly
    more telling terms do.
    """
    counts = stored(term_counts(rows), "terms")
    size = [n or 1 for n in counts.where(~F.col("term").endswith("*")).agg(
        F.sum("toxic"), F.sum("other")).first()]
    often = (F.col("toxic") / size[0]) / ((F.col("other") + 0.5) / size[1])
    # Bounded by the sample: a term needs several contexts in it.
    telling = {r.term: (r.toxic, r.often) for r in counts.withColumn("often", often).where(
        (F.col("toxic") >= LEAST_CONTEXTS) & (F.col("often") >= LEAST_RATIO)).collect()}
    longer: dict[str, int] = {}
    for term, (n, _) in telling.items():
        stem = term.rstrip("*")
        for k in range(SHORTEST, len(stem) + (not term.endswith("*"))):
            longer[stem[:k]] = max(n, longer.get(stem[:k], 0))
    kept: dict[str, float] = {}
    for term in sorted(telling, key=lambda t: (len(t.rstrip("*")), not t.endswith("*"), t)):
        n, ratio = telling[term]
        stem = term.rstrip("*")
        if any(3 * kept.get(stem[:k] + "*", 0) >= ratio for k in range(SHORTEST, len(stem) + 1)):
            continue
        if term.endswith("*") and longer.get(stem, 0) >= 0.95 * n:
            continue
        kept[term] = ratio
    weights = {t: float(np.log(r)) for t, r in kept.items()}
    return Lexicon(tuple((t, w) for t, w in weights.items() if not t.endswith("*")),
                   tuple((t[:-1], w) for t, w in weights.items() if t.endswith("*")))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic model by Newton's method with a ridge penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(y) + penalty * w / len(y) ** 0.5
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.eye(len(w)) * penalty / len(y) ** 0.5
        w = w - np.linalg.solve(bend, slope)
    return w


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, id_column: str,
                  text_column: str, label_column: str,
                  docs_per_class: int = DOCS_PER_CLASS) -> DataFrame:
    """(id, text, label) of a hashed share of the usable labelled documents of each class."""
    labels = labels.where(usable & F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    counts = {r[label_column]: r["count"] for r in labels.groupBy(label_column).count().collect()}
    share = F.when(F.col(label_column) == 1, min(1.0, docs_per_class / max(1, counts.get(1, 0)))
                   ).otherwise(min(1.0, docs_per_class / max(1, counts.get(0, 0))))
    draw = F.pmod(F.xxhash64(F.lit("toxic"), id_column), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = labels.where(draw < share).select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label")).distinct()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # About twice ``docs_per_class`` ids, whatever the size of the tables.
    return texts.join(F.broadcast(drawn), "id").where(F.col("text").isNotNull())


def learn(rows: DataFrame) -> Model | None:
    """A model from the bounded rows of ``training_rows``; None unless both labels occur.

    The driver sees the telling terms and eight numbers per row of the sample.
    """
    rows = stored(rows, "labelled")
    lexicon = learn_lexicon(rows)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = features(batch.column("text"), lexicon)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label").cast(pa.int32()), pa.array(list(x))],
                names=["id", "label", "x"])

    seen = rows.select(F.col("id").cast("string").alias("id"), "label", "text").mapInArrow(
        measured, "id string, label int, x array<double>").collect()
    seen = sorted((r.id, r.label, r.x) for r in seen)
    y = np.array([label for _, label, _ in seen], float)
    if len(set(y)) < 2:
        return None
    return Model(lexicon, tuple(fit_logistic(np.array([x for *_, x in seen]), y)))


def score(docs: DataFrame, model: Model | None, text_column: str = "text",
          result: str = "score") -> DataFrame:
    """Every row of ``docs`` with a score from 0 to 1, higher where label 1 is likelier.

    Null and empty texts have no hits and get the score of such texts; without a model all get 0.
    A column that already has the result's name is replaced. Only the text is looked at, whole;
    repeated rows get equal scores, and an empty table gives an empty one.
    """
    docs = docs.drop(result)
    if model is None:
        return docs.withColumn(result, F.lit(0.0))
    weights = np.array(model.weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            logit = features(batch.column(text_column), model.lexicon) @ weights
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)],
                                             names=[*batch.schema.names, result])

    return docs.mapInArrow(scored, T.StructType(
        [*docs.schema.fields, T.StructField(result, T.DoubleType())]))
