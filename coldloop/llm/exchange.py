"""Questions about hashes, answered across all slices of a corpus.

A task cuts its documents into slices, keeps a slice's texts as one compressed file in the
shared folder and sends the hashes of the slice to buckets, packed: one row per slice and
bucket with arrays inside, so a hash costs a few bytes. A bucket sees all hashes with its
remainder and answers each slice in the same packed form. The answers of a slice then meet its
texts again. Within a slice, equal hashes of several documents are resolved on the spot and sent
once, so even a hash of a third of all documents reaches its bucket once per slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldloop.llm.text import file_system, give_back, publish, slices

#: Text bytes of a slice and, about, of all documents per bucket.
SLICE, PER_BUCKET = 2 << 20, 16 << 20
#: Rows in flight: an array per name, ``slice`` and ``bucket`` say where from and where to;
#: bucket -1 is the slice's own row, which carries what the answers will need.
PACKED = "slice string, bucket int, a binary, b binary, c binary, d binary"


@dataclass(frozen=True)
class Slice:
    """Documents with their ids and texts (null: None), under a name."""

    name: str
    ids: pa.Array
    texts: pa.Array


def bucket_count(docs: DataFrame, text_column: str) -> int:
    """One bucket per ``PER_BUCKET`` bytes of text, and enough to occupy every task."""
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(-(-size // PER_BUCKET), 3 * tasks)


def cut(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[Slice]:
    """Slices of rows (id, text), each kept as a file.

    A name says which slice of which partition it is and what is in it, so a task that is run
    again after an executor is lost gives the same slices, and answers to either run fit.
    """
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    context = TaskContext.get()
    partition = context.partitionId() if context else 0
    for number, batch in enumerate(slices(batches, "text", SLICE)):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        content = sink.getvalue()
        name = f"{partition}-{number}-{xxhash.xxh3_128_hexdigest(content)}"
        publish(fs, f"{path}/{name}", zstandard.ZstdCompressor(3).compress(content))
        yield Slice(name, batch.column("id"), batch.column("text"))


def recall(name: str, folder: str) -> Slice:
    """A slice read back from its file."""
    fs, path = file_system(folder)
    with fs.open_input_file(f"{path}/{name}") as source:
        raw = zstandard.ZstdDecompressor().decompress(source.read())
    batch = pa.ipc.open_stream(raw).read_all().combine_chunks().to_batches()[0]
    return Slice(name, batch.column("id"), batch.column("text"))


def packed(name: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows (bucket, a, b, c, d) of one slice."""
    buckets, *arrays = zip(*rows) if rows else [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(rows), pa.string()), pa.array(buckets, pa.int32()),
         *(pa.array(x, pa.binary()) for x in arrays)],
        names=["slice", "bucket", "a", "b", "c", "d"])


def dealt(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings the members of each bucket together, and where each one starts."""
    order = np.argsort(bucket.astype(np.uint32), kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def pack_positions(x: np.ndarray) -> bytes:
    """Increasing positions as differences, two bytes each where they fit."""
    steps = np.diff(x, prepend=0)
    small = len(steps) == 0 or steps.max() < 1 << 16
    return (b"2" + steps.astype("<u2").tobytes()) if small else b"4" + steps.astype("<u4").tobytes()


def unpack_positions(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, f"<u{raw[:1].decode()}", offset=1), dtype=np.int64)


def column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def ask(docs: DataFrame, id_column: str, text_column: str, folder: str,
        question: Callable[[Slice], list[tuple]]) -> DataFrame:
    """The packed rows of every slice of ``docs``."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cut(batches, folder):
            yield packed(part.name, question(part))

    return rows.mapInArrow(sent, PACKED)


def answered(asked: DataFrame, reply: Callable[[pa.Table], Iterable[tuple]]) -> DataFrame:
    """Replies to all slices, beside the slices' own rows.

    ``reply`` gets the rows of one bucket and gives (index of row, a, b, c, d). The own rows travel
    through the same shuffle, spread over the buckets, as computing them twice would cost more.
    """
    def answer(table: pa.Table) -> pa.Table:
        own = table.filter(pc.less(table.column("bucket"), 0)).select(
            ["slice", "bucket", "a", "b", "c", "d"])
        others = table.filter(pc.greater_equal(table.column("bucket"), 0))
        found = list(reply(others)) if len(others) else []
        names = column(others, "slice")
        replies = pa.table([
            pa.array([names[i] for i, *_ in found], pa.string()),
            pa.array([0] * len(found), pa.int32()),
            *(pa.array([row[k] for row in found], pa.binary()) for k in range(1, 5)),
        ], names=["slice", "bucket", "a", "b", "c", "d"])
        return pa.concat_tables([own, replies.cast(own.schema)])

    spread = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(
        F.pmod(F.hash("slice"), F.lit(1 << 20)) + (1 << 20))
    return asked.withColumn("to", spread).groupBy("to").applyInArrow(answer, PACKED)


def gathered(replies: DataFrame, finish: Callable[[str, dict, list[dict]], pa.Table],
             schema: str) -> DataFrame:
    """``finish`` once per slice, on the name, its own row and the replies to it."""
    def collect(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        mine = [r for r in rows if r["bucket"] < 0]
        if len(mine) != 1:  # answers to a slice that its partition, run again, has no more
            raise RuntimeError(f"{len(mine)} rows of slice {rows[0]['slice']}: its input changed "
                               "between runs; write the input first")
        done = finish(mine[0]["slice"], mine[0], [r for r in rows if r["bucket"] >= 0])
        give_back()
        return done

    return replies.groupBy("slice").applyInArrow(collect, schema)


def same_runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the run of equal keys each entry belongs to, and where each run starts."""
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    return np.cumsum(new) - 1, np.flatnonzero(new)


