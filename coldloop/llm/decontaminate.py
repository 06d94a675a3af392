"""Benchmark decontamination by template canonicalisation.

Words become a template: numbers, units after numbers and names turn into typed placeholders, the
others are lower-cased without marks around them. Runs of template words of a document
are looked up among those of the benchmark items, so a question with other numbers or names is
still found. The values in the placeholders must then agree: along a match, equal values of the item stand
for equal values of the document. A match that does not agree as a whole is cut into parts that do.

Windows with few literal words would match any numbers or names; they count where a document has
the very words of the item (``few_literals``).

The benchmark is the query set: it goes to all tasks in blocks of at most ``ITEMS`` items, one
pass over the documents per block.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldloop.llm.text import slices, windows, words

#: Template words of a window, literal words it must hold, and items per block.
WINDOW, LEAST_LITERALS, ITEMS = 8, 4, 20_000
FACTOR = 0xC2B2AE3D27D4EB4F
#: Text bytes handled at once: template words take some twenty bytes for each byte of text.
SLICE = 1 << 20
# Marks around words, what a number is, and units after a number.
MARKS = ".,!?;:\"'()[]{}*%$€£&#|<>-_/\\“”«»„‘’"
NUMBER = re.compile(r"[0-9][0-9.,:/]*")
UNITS = frozenset((
    "mm cm m km in inch inches ft feet foot yd yards mile miles g kg mg lb lbs pound pounds ton tons "
    "oz ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr "
    "hour hours day days week weeks month months year years dollar dollars euro euros cent cents "
    "percent degree degrees mph kmh kw kwh w v a hz").split())
WORD, NUM, UNIT, NAME = range(4)
PLACEHOLDER = np.array([0, *(xxhash.xxh3_64_intdigest(p) for p in ("<num>", "<unit>", "<name>"))],
                       np.uint64)
FOUND = "doc_id long, item_id long, item_words long, matched_words long, at_word long, kind string"


def look(word: str) -> tuple[str, int, int, bool]:
    """A word without marks, its own hash, its flags and whether a sentence ends with it.

    Flags: 1 number, 2 unit, 4 capital letter at the start only.
    """
    bare = word.strip(MARKS)
    low = bare.lower()
    # Words in capitals throughout are shouted, not names.
    capital = bare[:1].isupper() and not bare.isupper()
    flags = bool(NUMBER.fullmatch(bare)) + 2 * (low in UNITS) + 4 * capital
    return low, xxhash.xxh3_64_intdigest(low), flags, word.rstrip("\"'”»)]}").endswith((".", "!", "?"))


@dataclass(frozen=True)
class Templates:
    """Template words of texts, one text after the other: bounds, hashes, kinds and values.

    ``plain`` has the hashes of the words themselves, also where a placeholder stands for them.
    """

    bounds: np.ndarray
    hashes: np.ndarray
    plain: np.ndarray
    kinds: np.ndarray
    codes: np.ndarray
    values: list[str]


def templates(texts: pa.Array) -> Templates:
    """Canonical words; a capital letter makes a name unless a sentence begins there."""
    bounds, codes, distinct = words(texts)
    seen = [look(w) for w in distinct.to_pylist()]
    own = np.fromiter((s[1] for s in seen), np.uint64, len(seen))[codes]
    flags = np.fromiter((s[2] for s in seen), np.int8, len(seen))[codes]
    ends = np.fromiter((s[3] for s in seen), bool, len(seen))[codes]
    opening = np.ones(len(codes), bool)
    opening[1:] = ends[:-1]
    opening[bounds[:-1][bounds[:-1] < len(codes)]] = True
    after_number = np.zeros(len(codes), bool)
    after_number[1:] = flags[:-1] & 1
    kinds = np.where(flags & 1, NUM, np.where((flags & 2 > 0) & after_number & ~opening, UNIT, np.where(
        (flags & 4 > 0) & ~opening, NAME, WORD))).astype(np.int8)
    return Templates(bounds, np.where(kinds == WORD, own, PLACEHOLDER[kinds]), own, kinds, codes,
                     [s[0] for s in seen])


class Index:
    """Windows of a block of items by hash.

    An item's first word is left out, as what precedes it in a document decides its kind; items
    with fewer words than a window has are one window. With ``few_literals`` the windows below
    the least number of literal words are looked up by their very words, an item that is one
    window by all of its words.
    """

    def __init__(self, ids: list[int], texts: list[str], few_literals: bool = False) -> None:
        self.ids = ids
        self.items = templates(pa.array(texts, pa.string()))
        found, few = (defaultdict(lambda: defaultdict(list)) for _ in range(2))
        bounds, kinds = self.items.bounds, self.items.kinds
        for i in range(len(ids)):
            whole, end = int(bounds[i]), int(bounds[i + 1])
            start = whole + (end - whole > 1)
            length = min(WINDOW, end - start)
            if not length:
                continue
            for at, key in enumerate(windows(self.items.hashes[start:end], length, FACTOR).tolist()):
                literals = int((kinds[start + at: start + at + length] == WORD).sum())
                if literals >= min(LEAST_LITERALS, length):
                    found[length][key].append((i, start + at))
                elif few_literals:
                    a, n = (whole, end - whole) if end - whole <= WINDOW else (start + at, length)
                    few[n][int(windows(self.items.plain[a: a + n], n, FACTOR)[0])].append((i, a))
        self.found, self.few = ({length: (np.sort(np.fromiter(keys, np.uint64, len(keys))), dict(keys))
                                 for length, keys in table.items()} for table in (found, few))
        self.size = np.diff(bounds)

    def hits(self, text: Templates) -> Iterator[tuple[int, int, int, int]]:
        """(position, item, position in the items, length) of every window found."""
        return looked_up(text, text.hashes, self.found)

    def few_literal_hits(self, text: Templates) -> Iterator[tuple[int, int, int, int]]:
        """The same of windows with few literal words."""
        return looked_up(text, text.plain, self.few)


def looked_up(text: Templates, hashes: np.ndarray,
              table: dict[int, tuple[np.ndarray, dict]]) -> Iterator[tuple[int, int, int, int]]:
    """(position, item, position in the items, length) of every window of ``table``."""
    doc = np.repeat(np.arange(len(text.bounds) - 1), np.diff(text.bounds))
    for length, (keys, places) in table.items():
        if len(doc) < length:
            continue
        probe = windows(hashes, length, FACTOR)
        known = np.zeros(1 << 20, bool)
        known[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        maybe = np.flatnonzero(known[(probe & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, probe[maybe]), len(keys) - 1)
        maybe = maybe[keys[at] == probe[maybe]]
        maybe = maybe[doc[maybe] == doc[maybe + length - 1]]
        for p in maybe.tolist():
            for item, q in places[int(probe[p])]:
                yield p, item, q, length


def joined(starts: list[int], length: int) -> Iterator[list[int]]:
    """Sorted starts of windows, in runs of windows that overlap or touch."""
    cuts = [0, *(i for i in range(1, len(starts)) if starts[i] > starts[i - 1] + length),
            len(starts)]
    for a, b in zip(cuts, cuts[1:]):
        yield starts[a:b]


def agreeing(text: Templates, items: Templates, run: list[int], length: int,
             shift: int) -> Iterator[tuple[int, int, bool]]:
    """(from, to, whether all values are equal) of the parts of a run whose placeholders agree.

    The longest part comes first, then those of what is left on its sides. A part holds a
    window at least. Windows whose values are the item's own count whatever else their run does.
    """
    low, high = run[0], run[-1] + length
    places = low + np.flatnonzero(items.kinds[low - shift: high - shift] != WORD)
    # Of each value of the item: what stands for it, where last, and where last something else.
    seen: dict[tuple[int, str], tuple[str, int, int]] = {}
    begin, begins, changed = low, {}, []
    for p in places.tolist():
        key = int(items.kinds[p - shift]), items.values[items.codes[p - shift]]
        mine = text.values[text.codes[p]]
        if mine != key[1]:
            changed.append(p)
        value, last, other = seen.get(key, (mine, p, low - 1))
        seen[key] = mine, p, other if mine == value else last
        if seen[key][2] >= begin:
            begin = begins[p] = seen[key][2] + 1
    if not begins:
        yield low, high, not changed
        return
    # First words of the longest agreeing parts that end with each word.
    first = np.full(high - low, low)
    for p, start in begins.items():
        first[p - low:] = start
    windows_before = np.zeros(high - low + 1, np.int64)
    windows_before[np.array(run) - low + 1] = 1
    windows_before = np.cumsum(windows_before)
    unequal = np.zeros(high - low + 1, np.int64)
    unequal[np.array(changed, np.int64) - low + 1] = 1
    unequal = np.cumsum(unequal)
    open_parts = [(low, high)]
    while open_parts:
        a, b = open_parts.pop()
        if b - a < length:
            continue
        ends = np.arange(a + length, b + 1)
        starts = np.maximum(first[ends - 1 - low], a)
        held = windows_before[np.maximum(ends - length + 1 - low, 0)] > windows_before[starts - low]
        size = np.where(held, ends - starts, 0)
        best = int(np.argmax(size))
        if size[best] < length:
            continue
        start, end = int(starts[best]), int(ends[best])
        yield start, end, bool(unequal[end - low] == unequal[start - low])
        open_parts += [(a, start), (end, b)]
    for p in run:
        if unequal[p + length - low] == unequal[p - low]:
            yield p, p + length, True


def matches(text: Templates, index: Index) -> Iterator[tuple[int, int, int, int, str]]:
    """(document, item, matched words of the item, first word of the match, kind)."""
    runs: dict[tuple[int, int, int, int], set] = defaultdict(set)
    for p, item, q, length in index.hits(text):
        doc = int(np.searchsorted(text.bounds, p, "right")) - 1
        runs[doc, item, p - q, length].add(p)
    found: dict[tuple[int, int], dict] = {}

    def take(doc: int, item: int, a: int, b: int, shift: int, equal: bool) -> None:
        entry = found.setdefault((doc, item), {"words": set(), "at": a, "equal": True})
        entry["words"].update(range(a - shift, b - shift))
        entry["at"] = min(entry["at"], a)
        entry["equal"] = entry["equal"] and equal

    for (doc, item, shift, length), starts in runs.items():
        for run in joined(sorted(starts), length):
            for a, b, equal in agreeing(text, index.items, run, length, shift):
                take(doc, item, a, b, shift, equal)
    for p, item, q, length in index.few_literal_hits(text):
        doc = int(np.searchsorted(text.bounds, p, "right")) - 1
        take(doc, item, p, p + length, p - q, True)
    for (doc, item), entry in found.items():
        yield (doc, item, len(entry["words"]), entry["at"] - int(text.bounds[doc]),
               "verbatim" if entry["equal"] else "reparameterised")


def leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
          text_column: str = "text", item_column: str = "item_id",
          item_text_column: str = "text", few_literals: bool = False) -> DataFrame:
    """One row per row of ``docs`` and benchmark item of which it holds a passage.

    doc_id, item_id, item_words, matched_words, at_word (first matched word of the document) and
    kind: ``verbatim`` if all placeholders hold the item's values, else ``reparameterised``.
    Windows of an item with fewer than ``LEAST_LITERALS`` literal words are left out, and with
    them items that have no others, unless ``few_literals`` is set: then verbatim copies of them
    are found. Null and empty texts or items match nothing; repeated rows each give their own matches, and
    a null doc_id stays null. Other columns are not read; empty tables give an empty result.
    """
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"),
                             F.col(item_text_column).alias("text")).where(F.col("text").isNotNull())
    blocks = max(1, -(-items.count() // ITEMS))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    passes = []
    for block in range(blocks):
        listed = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        listed = sorted(map(tuple, listed.collect()), key=str)
        passes.append(texts.mapInArrow(finder(listed, few_literals), FOUND))
    return reduce(DataFrame.unionByName, passes)


def finder(listed: list[tuple[int, str]], few_literals: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index([i for i, _ in listed], [t for _, t in listed], few_literals)
        for batch in slices(batches, "text", SLICE):
            found = list(matches(templates(batch.column("text")), index))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array([d for d, *_ in found], pa.int64())),
                pa.array([index.ids[i] for _, i, *_ in found], pa.int64()),
                pa.array([int(index.size[i]) for _, i, *_ in found], pa.int64()),
                pa.array([n for _, _, n, _, _ in found], pa.int64()),
                pa.array([at for *_, at, _ in found], pa.int64()),
                pa.array([kind for *_, kind in found], pa.string()),
            ], names=["doc_id", "item_id", "item_words", "matched_words", "at_word", "kind"])
    return find
