"""Personal data: expressions propose spans, checksums confirm them, context adjusts the score.

Four base kinds follow fixed patterns (leftmost matches that do not overlap within a kind; a
match that fails its check is dropped). Three more steps add spans and never remove any: a card
or phone number hidden in a longer run of digits whose whole failed its check, bank account
numbers that pass mod-97, and weak candidates, which only a word nearby admits: shorter cards that
pass Luhn and phone numbers without a country's prefix. Positions count code points, ends are
exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldloop.llm.text import slices

# The kinds in their order, and the patterns of the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits never starts inside another one, so the look-behind changes no match; it
# keeps the search linear on long runs.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
                  r"(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![A-Za-z0-9+.-])\(?0[0-9](?:[\x20().-]{0,2}[0-9]){6,9}(?![0-9])")
DIGITS = re.compile(r"[0-9]+")
#: Score of a confirmed span before its context is seen.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9}
#: The same for a candidate whose form alone proves little: below ``LEAST``, above it with one step.
WEAK = 0.4
#: Words that make a kind likelier or less likely when they stand nearby.
FOR = {"email": {"email", "mail", "contact"}, "ip": {"ip", "address", "host", "server"},
       "card": {"card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta"},
       "phone": {"phone", "tel", "call", "mobile", "fax"},
       "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"}}
AGAINST = {"ip": {"version", "release", "build"}, "card": {"order", "serial", "isbn", "token"},
           "phone": {"serial", "order", "version"}}
#: Characters on either side in which context words count, what one adds, and the least score
#: of a span beyond the base ones.
REACH, STEP, LEAST = 48, 0.15, 0.5

SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, ``@`` and domain, found from each ``@`` outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def hidden_cards(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Runs of whole digit groups with 13 to 19 digits that pass Luhn, leftmost first."""
    groups = [m.span() for m in DIGITS.finditer(text, start, end)]
    lengths = [0]
    for a, b in groups:
        lengths.append(lengths[-1] + b - a)
    i = 0
    while i < len(groups):
        # The longest run first; the lengths are increasing, so both ends are searched.
        low, high = bisect_left(lengths, lengths[i] + 13), bisect_left(lengths, lengths[i] + 20)
        for j in range(high - 1, low - 1, -1):
            if luhn(only_digits(text[groups[i][0]: groups[j - 1][1]])):
                yield groups[i][0], groups[j - 1][1]
                i = j
                break
        else:
            i += 1


def hidden_phone(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The longest beginning with 8 to 15 digits that ends before a space."""
    found, digits = None, 0
    for m in DIGITS.finditer(text, start, end):
        digits += m.end() - m.start()
        if digits > 15:
            break
        if digits >= 8 and text[m.end(): m.end() + 1] == " ":
            found = start, m.end()
    return found


def score(text: str, kind: str, start: int, end: int, prior: float) -> float:
    near = text[max(0, start - REACH): start] + " " + text[end: end + REACH]
    found = {w.strip(".,:;()\"'").lower() for w in near.split()}
    value = prior + STEP * bool(found & FOR[kind]) - STEP * bool(
        found & AGAINST.get(kind, set()))
    return round(min(1.0, max(0.0, value)), 3)


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by kind as listed and then by position."""
    found: list[tuple[str, int, int, bool]] = [("email", a, b, True) for a, b in emails(text)]
    weak: list[tuple[str, int, int]] = []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", *m.span(), True))
    for m in CARD.finditer(text):
        digits = only_digits(m[0]) if m.end() - m.start() >= 13 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span(), True))
        elif 13 <= len(digits) <= 15 and luhn(digits):
            weak.append(("card", *m.span()))
        elif len(digits) > 19:
            found += [("card", a, b, False) for a, b in hidden_cards(text, *m.span())]
    for m in PHONE.finditer(text):
        digits = only_digits(m[0])
        if 8 <= len(digits) <= 15:
            found.append(("phone", *m.span(), True))
        elif len(digits) > 15 and (part := hidden_phone(text, *m.span())):
            found.append(("phone", *part, False))
    for m in IBAN.finditer(text):
        account = m[0].replace(" ", "")
        if 15 <= len(account) <= 34 and mod97(account):
            found.append(("iban", *m.span(), False))
    taken = outline([(a, b) for _, a, b, _ in found])
    weak += [("phone", *m.span()) for m in NATIONAL.finditer(text) if not meets(taken, *m.span())]
    order = {kind: i for i, kind in enumerate(KINDS)}
    spans = [Span(kind, a, b, score(text, kind, a, b, PRIOR[kind]), base)
             for kind, a, b, base in found]
    spans += [Span(kind, a, b, score(text, kind, a, b, WEAK), False) for kind, a, b in weak]
    return sorted((s for s in spans if s.base or s.score >= LEAST),
                  key=lambda s: (order[s.kind], s.start))


def outline(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The covered places as runs that do not overlap, in order."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if runs and start < runs[-1][1]:
            runs[-1] = runs[-1][0], max(end, runs[-1][1])
        else:
            runs.append((start, end))
    return runs


def meets(runs: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span overlaps one of the runs."""
    at = bisect_left(runs, (end, 0))
    return at > 0 and runs[at - 1][1] > start


def detect(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column`` and ``pii``, the spans of each whole text, row by row.

    Null and empty texts have no spans; repeated rows are judged each on its own and a null id
    stays null. Other columns of the input are not read. An empty table gives an empty one.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    fields = docs.select(F.col(id_column).alias("id")).schema["id"].dataType.simpleString()

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                   ("end", pa.int32()), ("score", pa.float64()),
                                   ("base", pa.bool_())]))
        for batch in slices(batches, "text"):
            found = [[s._asdict() for s in find_spans(t)] if t else []
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, kind)], names=["id", "pii"])

    return texts.mapInArrow(spans, f"id {fields}, pii {SPANS}").withColumnRenamed("id", id_column)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` with its spans replaced by ``<KIND>``, overlapping ones as one."""
    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            at = batch.schema.get_field_index(text_column)
            texts = pa.array([t and masked_text(t) for t in batch.column(at).to_pylist()],
                             batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

    return docs.mapInArrow(masked, docs.schema)


def masked_text(text: str) -> str:
    out, done = [], 0
    for span in sorted(find_spans(text), key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            out += [text[done: span.start], f"<{span.kind.upper()}>"]
        done = max(done, span.end)
    return "".join([*out, text[done:]])
