"""A task that is run again, as after a lost executor, gives the same slices and answers."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest

from coldloop.llm import exchange
from coldloop.session import scratch_path
from tests.llm.corpus import texts


def batches(rows):
    ids, values = zip(*rows)
    whole = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.string())],
                                       names=["id", "text"])
    return [whole.slice(0, 40), whole.slice(40)]


def test_a_partition_cut_twice_gives_the_same_names_and_bytes(spark, monkeypatch):
    monkeypatch.setattr(exchange, "SLICE", 2_000)
    rows = list(enumerate(texts(120)))
    folders = [scratch_path(spark, "slices") for _ in range(2)]
    first, again = ([part.name for part in exchange.cut(batches(rows), f)] for f in folders)
    assert first == again and len(set(first)) == len(first) > 5
    for name in first:
        one, other = (open(os.path.join(f, name), "rb").read() for f in folders)
        assert one == other
    # In the same folder a second run replaces the files by themselves.
    assert [part.name for part in exchange.cut(batches(rows), folders[0])] == first
    assert sorted(os.listdir(folders[0])) == sorted(first)
    other = [part.name for part in exchange.cut(batches(rows[::-1]), folders[0])]
    assert not set(other) & set(first)


def test_equal_slices_of_two_partitions_stay_apart(spark):
    folder = scratch_path(spark, "slices")
    docs = spark.createDataFrame([(1, "a b c")] * 4, "id long, text string").repartition(4)
    names = exchange.ask(docs, "id", "text", folder, lambda part: [(-1, b"", b"", b"", b"")]).select(
        "slice")
    found = [r.slice for r in names.collect()]
    assert len(set(found)) == len(found) and sorted(found) == sorted(r.slice for r in names.collect())


def test_answers_without_their_slice_are_an_error(spark):
    replies = spark.createDataFrame([("gone", 3, b"", b"", b"", b"")], exchange.PACKED)
    done = exchange.gathered(replies, lambda name, own, rows: pa.table({"n": [1]}), "n long")
    with pytest.raises(Exception, match="its input changed"):
        done.collect()
