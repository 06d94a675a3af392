"""Language identification by rank-order profiles.

A language's profile lists its most frequent character n-grams by rank. A document goes to the
language whose profile is nearest to the ranks of its own most frequent n-grams, by out-of-place
distance: the sum of rank differences, the profile length where a profile lacks an n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.llm.text import slices

#: N-grams per profile, and the number of documents per language that profiles are learned
#: from (the expected number, by a hash of the id; languages with fewer give all).
PROFILE_LENGTH, DOCS_PER_LANGUAGE = 400, 2_000
#: More values of the language column than this are taken for a mistake.
MAX_LANGUAGES = 10_000
UNDETERMINED = "und"
#: Bits of a code point, so that three fit into 63, and what stands for a word boundary: not
#: zero, so that n-grams of different length differ.
_BITS, _BOUNDARY = 21, 1


@dataclass(frozen=True)
class Profiles:
    """Languages in code point order, all n-grams sorted, and a rank per n-gram and language."""

    languages: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    length: int


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (n up to 3) of a text, and how often each occurs.

    Letters are lower-cased; a run of anything else is one word boundary, also at both ends.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, _BOUNDARY).astype(np.int64)
    points = np.concatenate([[_BOUNDARY], points, [_BOUNDARY]])
    inner = points != _BOUNDARY
    points = points[np.concatenate([[True], inner[1:] | inner[:-1]])]
    letter = points != _BOUNDARY
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = (points[:-1] << _BITS) | points[1:]
    three = ((two[:-1] << _BITS) | points[2:])[letter[1:-1]]
    found = np.sort(np.concatenate([points[letter], two, three]))
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    return found[first], np.diff(first, append=len(found))


def top(codes: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The most frequent codes by rank; equal counts go by code."""
    if len(codes) > length:
        least = np.partition(counts, len(counts) - length)[len(counts) - length]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")][:length]


def training_rows(docs: DataFrame, usable: Column, id_column: str, lang_column: str,
                  docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """Rows that profiles are learned from: all of a language with few, else a hashed share."""
    rows = docs.where(usable & F.col(lang_column).isNotNull())
    counts = rows.groupBy(lang_column).count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_column}")
    if not counts:
        return rows.limit(0)
    share = F.create_map(*(F.lit(x) for lang, n in counts
                           for x in (lang, min(1.0, docs_per_language / n))))
    draw = F.pmod(F.xxhash64(F.lit("profile"), id_column), F.lit(1 << 30)) / F.lit(1 << 30)
    return rows.where(draw < F.element_at(share, F.col(lang_column)))


def learn(rows: DataFrame, text_column: str = "text", lang_column: str = "lang",
          length: int = PROFILE_LENGTH) -> Profiles:
    """Profiles of the languages in ``rows``; null texts and languages teach nothing."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(),
                                  batch.column("text").to_pylist()):
                found.setdefault(lang, []).append(grams(text))
            for lang, parts in found.items():
                codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                sums = np.bincount(at, np.concatenate([n for _, n in parts]), len(codes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes)), pa.array(codes),
                     pa.array(sums.astype(np.int64))], names=["lang", "gram", "n"])

    texts = rows.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    by_rank = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = (
        texts.dropna().mapInArrow(counted, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(by_rank) - 1).where(F.col("rank") < length)
        .collect())  # ``length`` rows per language
    languages = tuple(sorted({r.lang for r in ranked}))
    codes = np.unique(np.array([r.gram for r in ranked], np.int64))
    ranks = np.full((len(codes), len(languages)), length, np.int64)
    for r in ranked:
        ranks[np.searchsorted(codes, r.gram), languages.index(r.lang)] = r["rank"]
    return Profiles(languages, codes, ranks, length)


def nearest(text: str | None, profiles: Profiles) -> tuple[str, float]:
    """The nearest language and 1 - distance / largest distance; equal ones go by code point."""
    own = top(*grams(text), profiles.length) if text else np.zeros(0, np.int64)
    if not len(own) or not profiles.languages:
        return UNDETERMINED, 0.0
    at = np.minimum(np.searchsorted(profiles.grams, own), len(profiles.grams) - 1)
    known = profiles.grams[at] == own
    place = np.arange(len(own))[known]
    apart = np.abs(profiles.ranks[at[known]] - place[:, None])
    missing = profiles.ranks[at[known]] == profiles.length
    distance = np.where(missing, profiles.length, apart).sum(axis=0)
    distance += profiles.length * (len(own) - len(place))
    best = int(np.argmin(distance))
    return profiles.languages[best], 1.0 - float(distance[best]) / (profiles.length * len(own))


def identify(docs: DataFrame, profiles: Profiles, text_column: str = "text",
             predicted: str = "lang_pred", score: str = "score") -> DataFrame:
    """Every row of ``docs`` with the language of its whole text and a score from 0 to 1.

    Texts that are null or have no letter get ``und`` and 0. Columns that already have the
    names of the results are replaced. No other column than the text is looked at; repeated
    rows get the same answer, and an empty table gives an empty one.
    """
    docs = docs.drop(predicted, score)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            found = [nearest(t, profiles) for t in batch.column(text_column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.float64())],
                names=[*batch.schema.names, predicted, score])

    added = [T.StructField(predicted, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(judged, T.StructType([*docs.schema.fields, *added]))
