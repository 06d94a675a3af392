"""Spelling variants: words one edit apart, by pairs of trie nodes, and the form each stands for.

The distinct prefixes of all words are the nodes of a trie, the distinct suffixes those of a
trie of reversed words. A word without its i-th code point is the pair (node before it, node
after it), and two words that differ by a replaced code point have such a pair in common. A word
cut between two code points is a pair as well, and it meets the pair of a word that has one more
code point there. Pairs are two integers, so one exchange by pair finds exact neighbours, and no
string but the words themselves is ever compared or sent. A pair has at most one word that is cut
there and one word per letter of the alphabet that skips a code point, so no group is large.

Nodes are numbered in sorted order, range by range: a word inherits the numbers of what it has in
common with the word before it. Ranges have the same number of words, and what words of several
ranges have in common is numbered by the first word of the ranges, of which there is one a task.

Null texts have no words; a null id counts as empty in the deletion rule; repeated rows count
again; an empty table, or one whose words are all too short or too rare, gives no rows. Words of
any length are taken: work and memory grow with the length of a word, not with its square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from coldloop.llm.text import stored


@dataclass(frozen=True)
class Spelling:
    """What counts as a word, and how much commoner a form is than its variant."""

    letters: str = r"a-zÀ-ÿ"
    least_length: int = 6
    least_count: int = 5
    #: A form has at least so many times the occurrences of its variant; 2 or more.
    commoner: int = 5
    #: One in so many pairs of a document and a run loses a code point; None: none does.
    damaged: int | None = 199


#: Words per range of sorted words, which one task numbers at a time.
PER_RANGE = 100_000
#: Node numbers: the first ones of a range lie above these bits, those of prefixes that reach
#: beyond their range below.
RANGE_BITS, LENGTH_BITS = 36, 24


def vocabulary(docs: DataFrame, rule: Spelling = Spelling(), id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """(word, n): the words of whole texts that are long and frequent enough."""
    lowered = F.translate(F.col(text_column), ascii_uppercase, ascii_lowercase)
    pattern = f"[{rule.letters}]{{{rule.least_length},}}"  # a shorter run is no word, cut or not
    run = F.col("run")
    word = run
    if rule.damaged is not None:
        key = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), run)
        h = F.crc32(key.cast("binary"))
        at = (h % F.length(run)).cast("int")
        word = F.when(h % rule.damaged == 0,
                      F.concat(F.substring(run, F.lit(1), at),
                               F.substring(run, at + 2, F.length(run)))).otherwise(run)
    return (
        docs.select(F.col(id_column).alias("id"),
                    F.explode(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))).alias("run"))
        .select(word.alias("word")).where(F.length("word") >= rule.least_length)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rule.least_count))


def common(a: str, b: str) -> int:
    """Code points that two words have in common at their beginnings."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def reaching(firsts: Sequence[str], q: int) -> list[int]:
    """Numbers of the prefixes of ``firsts[q]``: by the first range that begins with them."""
    word = firsts[q]
    numbers, p, shared = [0] * (len(word) + 1), q, common(firsts[q - 1], word) if q else -1
    for i in range(len(word), 0, -1):
        while p and shared >= i:
            p -= 1
            shared = common(firsts[p - 1], word) if p else -1
        numbers[i] = (p + 1) << LENGTH_BITS | i
    return numbers


class Numbering:
    """Numbers the nodes on the way to each of the sorted words of one range."""

    def __init__(self, q: int, firsts: Sequence[str]) -> None:
        self.borders = [(firsts[p], reaching(firsts, p)) for p in (q, q + 1) if p < len(firsts)]
        self.before, self.nodes, self.fresh = "", [0], (1 << 62) | q << RANGE_BITS

    def of(self, word: str) -> list[int]:
        """From the root, the empty prefix, to the whole word."""
        nodes = self.nodes[:common(self.before, word) + 1]
        for border, numbers in self.borders:  # prefixes that other ranges have as well
            nodes += numbers[len(nodes):common(border, word) + 1]
        missing = len(word) + 1 - len(nodes)
        nodes += range(self.fresh, self.fresh + missing)
        self.fresh += missing
        self.before, self.nodes = word, nodes
        return nodes


def trie_nodes(words: DataFrame, key: Column, name: str) -> DataFrame:
    """(word, ``name``): numbers of the trie nodes on the way to ``key``, from the root on."""
    ranges = max(1, math.ceil(words.count() / PER_RANGE))
    dealt = stored(
        words.select("word", key.alias("key")).repartitionByRange(ranges, "key")
        .withColumn("range", F.spark_partition_id()), "ranges")
    firsts = sorted((row["first"], row["range"]) for row in dealt.groupBy("range").agg(
        F.min("key").alias("first")).collect())  # a word per range
    place = {of: i for i, (_, of) in enumerate(firsts)}
    beginnings = [first for first, _ in firsts]
    schema = T.StructType([T.StructField("word", T.StringType()),
                           T.StructField(name, T.ArrayType(T.LongType()))])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, numbering = None, None
        for batch in batches:
            found = []
            for of, k in zip(batch.column("range").to_pylist(), batch.column("key").to_pylist()):
                if of != current:
                    current, numbering = of, Numbering(place[of], beginnings)
                found.append(numbering.of(k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(found, pa.list_(pa.int64()))], names=["word", name])

    return (dealt.repartition(ranges, "range").sortWithinPartitions("range", "key")
            .mapInArrow(number, schema))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best): near words counted, and of those commoner than the word itself
    the commonest (ties: the first in code-point order) as a struct (rank, word), rank = -n."""
    ahead = trie_nodes(words, F.col("word"), "ahead")
    behind = trie_nodes(words, F.reverse("word"), "behind")
    letters, last = F.split("word", ""), F.length("word") - 1
    # A word that loses any letter of a run of equal ones is the same word: its first one counts.
    skips = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        F.get("ahead", i).alias("p"), F.get("behind", last - i).alias("s"), F.lit(True).alias("skip"),
        ((i == 0) | (F.get("letters", i) != F.get("letters", i - 1))).alias("first")))
    cuts = F.transform(F.sequence(F.lit(0), last + 1), lambda i: F.struct(
        F.get("ahead", i).alias("p"), F.get("behind", last + 1 - i).alias("s"),
        F.lit(False).alias("skip"), F.lit(False).alias("first")))
    pairs = (words.join(ahead, "word").join(behind, "word").withColumn("letters", letters)
             .select("word", "n", F.inline(F.concat(skips, cuts))))
    pair, me = Window.partitionBy("p", "s"), F.struct((-F.col("n")).alias("rank"), "word")
    met = pairs.select(
        "word", "n", "skip", "first", me.alias("me"),
        F.count_if("skip").over(pair).alias("skips"),
        F.count_if("first").over(pair).alias("firsts"),
        F.min(F.when(F.col("skip"), me)).over(pair).alias("skipping"),
        F.min(F.when(F.col("first"), me)).over(pair).alias("longer"),
        F.min(F.when(~F.col("skip"), me)).over(pair).alias("shorter"))
    # The commonest word of a pair finds no commoner one there and needs none.
    found = met.select(
        "word", "n",
        F.when(F.col("skip"), F.col("skips") - 1
               + F.when(F.col("first") & F.col("shorter").isNotNull(), 1).otherwise(0))
        .otherwise(F.col("firsts")).alias("near"),
        F.when(F.col("skip"), F.least(
            F.when(F.col("skipping") != F.col("me"), F.col("skipping")),
            F.when(F.col("first"), F.col("shorter")))).otherwise(F.col("longer")).alias("best"))
    return found.groupBy("word", "n").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def rooted(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root): where the forms of a word end, twice as far in each round.

    A round is written, as its plan would hold that of the round before twice.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        reached = stored(reached.join(onward, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root")), "roots")
    return reached


def variants(docs: DataFrame, rule: Spelling = Spelling(), id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``docs``."""
    words = stored(vocabulary(docs, rule, id_column, text_column), "vocabulary")
    best = F.col("best.rank")
    with_form = stored(neighbours(words).withColumn(
        "form_n", F.when(-best >= rule.commoner * F.col("n"), -best)).select(
            "word", F.when(F.col("form_n").isNotNull(), F.col("best.word")).alias("form"),
            "n", "n_near", "form_n"), "neighbours")
    most = words.agg(F.max("n")).first()[0] or rule.least_count
    steps = 1 + math.log(max(most / rule.least_count, 1), rule.commoner)  # counts grow by a factor
    roots = rooted(with_form.where("form IS NOT NULL"), math.ceil(math.log2(steps)) + 1)
    return with_form.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
