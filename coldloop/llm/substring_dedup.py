"""Substring dedup: fixed-block anchors, rolling probes, extension to whole repeated passages.

A window is ``window`` consecutive words of one document. Any two equal windows share a block
of (window + 1) / 2 words that starts at a multiple of its length in the first document. So the
blocks of all documents at such places are the index, and every rolling run of that many words
probes it. Hits from other documents are anchors. Around anchors, windows are compared in full, by 96
bits, against the smallest document that has them; consecutive repeated windows make up the
maximal repeats, and the words they cover are removed.

The two comparisons run through ``exchange``: hashes travel packed, texts stay in files of the
shared folder. Equal windows of one slice are settled there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from coldloop.llm.exchange import (
    PACKED, Slice, answered, ask, bucket_count, dealt, gathered, pack_positions, packed, recall,
    same_runs, unpack_positions)
from coldloop.llm.text import windows, word_hashes, words
from coldloop.session import scratch_path

WINDOW = 13
#: Odd factors of the polynomial hashes: of blocks, and two of windows.
BLOCK_FACTOR, FACTOR, FACTOR_2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
RESULT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, "
          "spans array<struct<start:long,end:long>>")
NO_ID = np.iinfo(np.int64).max


class Words:
    """The words of a slice, one document after the other."""

    def __init__(self, part: Slice) -> None:
        self.bounds, codes, self.distinct = words(part.texts)
        self.codes = codes
        self.hashes = word_hashes(self.distinct)[codes]
        self.doc = np.repeat(np.arange(len(part.texts)), np.diff(self.bounds))

    def runs(self, n: int, least: int = 0) -> np.ndarray:
        """Where runs of ``n`` words start that stay within a document of ``least`` words."""
        if len(self.doc) < n:
            return np.zeros(0, np.int64)
        inside = self.doc[n - 1:] == self.doc[: len(self.doc) - n + 1]
        long = np.diff(self.bounds)[self.doc[: len(inside)]] >= least
        return np.flatnonzero(inside & long)


def deduplicate(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """Per document what is left without passages of documents with a smaller id.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space),
    kept (null where nothing was removed, else the kept words so joined) and spans (removed
    runs of words). Windows are judged on the input, not on what is left.

    Null and empty texts have no words. A null id counts as larger than all others; documents
    with equal ids do not remove each other's words. Other columns are not read. An
    empty table gives an empty result.
    """
    if window % 2 == 0:
        raise ValueError("the window must have an odd number of words")
    folder, n = scratch_path(docs.sparkSession, "slices"), bucket_count(docs, text_column)
    docs = docs.withColumn(id_column, docs[id_column].cast("long"))
    asked = ask(docs, id_column, text_column, folder, lambda part: probes(part, window, n))
    anchored = answered(asked, hits)
    verified = gathered(anchored, lambda name, own, replies: around_anchors(
        recall(name, folder), own, replies, window, n), PACKED)
    judged = answered(verified, later_windows)
    return gathered(judged, lambda name, own, replies: without_repeats(
        recall(name, folder), own, replies, window), RESULT)


def probes(part: Slice, window: int, n: int) -> list[tuple]:
    """Block hashes of all positions: those at index places apart from the others.

    A hash that several documents of the slice have is sent once, without a position: its
    positions are anchors already and go into the slice's own row.
    """
    text, size = Words(part), (window + 1) // 2
    at = text.runs(size, window)
    hashes = windows(text.hashes, size, BLOCK_FACTOR)[at]
    index = (at - text.bounds[text.doc[at]]) % size == 0
    order = np.argsort(hashes, kind="stable")
    doc = text.doc[at][order]
    rows: list[tuple] = []
    shared = np.zeros(len(at), bool)
    if len(at):
        run, first = same_runs(hashes[order])
        # Positions increase within a run, so its documents differ if its ends do.
        ends = np.append(first[1:], len(at)) - 1
        several = doc[first] != doc[ends]
        shared[order] = several[run]
        known = np.flatnonzero(several)
        once = order[first[known]]
        indexed = np.logical_or.reduceat(index[order], first)[known]
        sent = np.concatenate([np.flatnonzero(~shared), once])
        own = np.concatenate([np.ones((~shared).sum(), bool), np.zeros(len(once), bool)])
        flag = np.concatenate([index[~shared], indexed])
        bucket = (hashes[sent] & np.uint64(0xFFFFFFFF)) % np.uint64(n)
        mark = (hashes[sent] >> np.uint64(32)).astype("<u4")
        place, starts = dealt(bucket, n)
        for b in range(n):
            some = place[starts[b]: starts[b + 1]]
            if len(some):
                mine = some[own[some]]
                theirs = some[~own[some]]
                rows.append((b, mark[mine].tobytes(), pack_positions(at[sent[mine]]),
                             mark[theirs].tobytes(),
                             np.packbits(np.concatenate([flag[mine], flag[theirs]])).tobytes()))
    rows.append((-1, pack_positions(at[shared]), b"", b"", b""))
    return rows


def hits(table: pa.Table) -> Iterable[tuple]:
    """For each slice the positions whose block another document has, one of the two indexed."""
    marks, places, index, origin = [], [], [], []
    for i, row in enumerate(table.select(["a", "b", "c", "d"]).to_pylist()):
        mine = np.frombuffer(row["a"], "<u4")
        theirs = np.frombuffer(row["c"], "<u4")
        total = len(mine) + len(theirs)
        marks += [mine, theirs]
        places += [unpack_positions(row["b"]), np.full(len(theirs), -1)]
        index.append(np.unpackbits(np.frombuffer(row["d"], np.uint8), count=total).astype(bool))
        origin.append(np.full(total, i, np.int32))
    mark, place = np.concatenate(marks), np.concatenate(places)
    indexed, source = np.concatenate(index), np.concatenate(origin)
    order = np.argsort(mark, kind="stable")  # keeps the slices of a run in order
    run, first = same_runs(mark[order])
    ends = np.append(first[1:], len(mark)) - 1
    found = (source[order][first] != source[order][ends]) | (place[order][first] < 0)
    found &= np.logical_or.reduceat(indexed[order], first)
    hit = np.sort(order[found[run]])
    hit = hit[place[hit] >= 0]
    for i, part in split(source[hit], place[hit]):
        yield i, pack_positions(part), b"", b"", b""


def split(source: np.ndarray, values: np.ndarray) -> Iterable[tuple[int, np.ndarray]]:
    """The values of each source; sources are in order."""
    if len(source):
        run, first = same_runs(source)
        for i, part in zip(source[first].tolist(), np.split(values, first[1:])):
            yield i, part


def around_anchors(part: Slice, own: dict, replies: list[dict], window: int, n: int) -> pa.Table:
    """Windows that contain an anchor, by bucket, as the next question of the slice."""
    text, size = Words(part), (window + 1) // 2
    near = np.zeros(len(text.doc) + 1, np.int64)
    for raw in (own["a"], *(r["a"] for r in replies)):
        # An anchor at p belongs to the windows that start at p - size + 1 to p.
        at = unpack_positions(raw)
        np.add.at(near, np.maximum(at - size + 1, 0), 1)
        np.add.at(near, at + 1, -1)
    at = text.runs(window)
    at = at[np.cumsum(near)[at] > 0]
    key = windows(text.hashes, window, FACTOR)[at]
    more = (windows(text.hashes, window, FACTOR_2)[at] >> np.uint64(32)).astype("<u4")
    ids = part.ids.fill_null(NO_ID).to_numpy()[text.doc[at]]
    order = np.lexsort((ids, more, key))
    rows: list[tuple] = []
    later = np.zeros(len(at), bool)
    if len(at):
        new = np.concatenate([[True], (key[order][1:] != key[order][:-1])
                              | (more[order][1:] != more[order][:-1])])
        smallest = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        later[order] = ids[order] > smallest
        open_ = np.flatnonzero(~later)
        place, starts = dealt(key[open_] % np.uint64(n), n)
        for b in range(n):
            some = open_[place[starts[b]: starts[b + 1]]]
            if len(some):
                rows.append((b, key[some].astype("<u8").tobytes(), more[some].tobytes(),
                             ids[some].astype("<i8").tobytes(), pack_positions(at[some])))
    rows.append((-1, pack_positions(at[later]), b"", b"", b""))
    return pa.Table.from_batches([packed(part.name, rows)])


def later_windows(table: pa.Table) -> Iterable[tuple]:
    """For each slice the windows that a document with a smaller id has."""
    rows = table.select(["a", "b", "c", "d"]).to_pylist()
    key, more, ids = (np.concatenate([np.frombuffer(r[c], kind) for r in rows])
                      for c, kind in (("a", "<u8"), ("b", "<u4"), ("c", "<i8")))
    places = [unpack_positions(r["d"]) for r in rows]
    source = np.repeat(np.arange(len(rows)), [len(p) for p in places])
    order = np.lexsort((ids, more, key))
    new = np.concatenate([[True], (key[order][1:] != key[order][:-1])
                          | (more[order][1:] != more[order][:-1])])
    smallest = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.sort(order[ids[order] > smallest])
    for i, part in split(source[later], np.concatenate(places)[later]):
        yield i, pack_positions(part), b"", b"", b""


def without_repeats(part: Slice, own: dict, replies: list[dict], window: int) -> pa.Table:
    """Result rows of a slice: covered words dropped."""
    bounds, codes, distinct = words(part.texts)
    covered = np.zeros(len(codes) + 1, np.int64)
    for raw in (own["a"], *(r["a"] for r in replies)):
        at = unpack_positions(raw)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + window, -1)
    gone = np.cumsum(covered)[:-1] > 0
    listed = distinct.to_pylist()
    removed, kept, digests, spans = [], [], [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        drop = gone[a:b]
        left = " ".join([listed[c] for c in codes[a:b][~drop].tolist()])
        removed.append(int(drop.sum()))
        kept.append(left if removed[-1] else None)
        digests.append(hashlib.sha256(left.encode()).hexdigest())
        turns = np.flatnonzero(np.diff(np.concatenate([[False], drop, [False]]).astype(np.int8)))
        spans.append([{"start": s, "end": e} for s, e in turns.reshape(-1, 2).tolist()])
    return pa.table({
        "doc_id": part.ids.cast(pa.int64()), "n_words": pa.array(np.diff(bounds)),
        "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string()),
        "kept": pa.array(kept, pa.string()),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})
