"""Words, text slices and files in the shared folder, as the operators need them."""

from __future__ import annotations

import ctypes
import os
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldloop.session import scratch_path

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes handled at once inside a task.
SLICE_BYTES = 4 << 20
#: At most this many 64-bit ids are broadcast.
BROADCAST_IDS = 1_000_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shelf:
    """Written tables that one call needs for a while.

    ``add`` writes a table and reads it back; ``clear`` removes the named ones, or all. A table may
    go once everything made from it is written, as reading it again is then never needed.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def add(self, df: DataFrame, label: str) -> DataFrame:
        self.paths[label] = path = scratch_path(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, *labels: str) -> None:
        for label in labels or list(self.paths):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(label))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def without(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose ``column`` is not among ``ids``; null ones stay.

    Up to ``BROADCAST_IDS`` ids go to all tasks and ``docs`` is not shuffled; more are joined.
    """
    ids = stored(ids.select(column).distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, column, "left_anti")


def give_back() -> None:
    """Return freed memory to the system, as an idle worker would keep it from its neighbours."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``size`` bytes; a longer text stays whole."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
        give_back()


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per text: where its words start, codes of all words, and the distinct words.

    Null texts have no words. The first result has one entry more than there are texts.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values, bounds = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    full = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    kept_before = np.concatenate([[0], np.cumsum(full)])
    coded = values.filter(pa.array(full)).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return kept_before[bounds].astype(np.int64), codes, coded.dictionary


def word_hashes(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in distinct.to_pylist()), np.uint64, len(distinct))


def windows(values: np.ndarray, n: int, factor: int) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of all runs of ``n`` values."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    total, step = np.zeros(len(values) - n + 1, np.uint64), np.uint64(factor)
    for i in range(n):
        total = total * step + values[i: len(values) - n + 1 + i]
    return mixed(total)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit value (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ragged(starts: np.ndarray, lengths: np.ndarray, dtype: type = np.int64) -> np.ndarray:
    """Indexes start, start + 1, … of every run, one run after the other."""
    ends = np.cumsum(lengths, dtype=dtype)
    at = np.repeat(starts.astype(dtype) - ends + lengths, lengths)
    at += np.arange(len(at), dtype=dtype)
    return at


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store behind a folder name; names without a scheme are local paths."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


def publish(fs: pafs.FileSystem, path: str, content: bytes) -> None:
    """Write a whole file under its final name at once, so a repeated task changes nothing."""
    parent, name = path.rsplit("/", 1)
    partial = f"{parent}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(partial) as out:
        out.write(content)
    fs.move(partial, path)


def discard(folder: str) -> None:
    """Remove a folder of an operator's own, once what was made from it is written."""
    fs, path = file_system(folder)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def quiet_tokenizers() -> None:
    """Tasks already use all cores, so the tokenizer must not start threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
