"""Token ids as flat unsigned integer files with 64-bit document offsets.

A store is a folder. Part ``p`` consists of ``p.ids`` (the ids of its documents, one after the
other, 16-bit where the vocabulary allows and else 32-bit, little endian), ``p.offsets``
(64-bit, one more than documents, counted in ids from the part's start) and ``p.docs``
(64-bit document ids; rows without one come first and hold 0). The manifest has one row per
part; ``base`` is the number of ids in all parts before it, a prefix sum over the manifest.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldloop.llm.text import SLICE_BYTES, file_system, quiet_tokenizers, slices, words

PART = "part int, docs long, without_id long, ids long"
#: Pieces whose ids a Python worker keeps, bytes of the longest one, and new ones encoded as one text.
CACHED_WORDS, LONGEST, RUNS = 400_000, 64, 5_000
#: Bytes of a slice for each kept piece: who asks for small slices has little memory.
PER_PIECE = 10
#: Pieces that are one word to a tokenizer, with one closing id.
LETTERS = r"^[a-zß-öø-ÿ]+$"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@dataclass(frozen=True)
class TokenStore:
    """Where the files are, how wide an id is, and rows (part, docs, without_id, ids, base)."""

    root: str
    width: int
    parts: tuple[tuple[int, int, int, int, int], ...]

    @property
    def dtype(self) -> str:
        return f"<u{self.width}"


class WordEncoder:
    """Encodes texts through their distinct words.

    Exact for byte-level BPE with word ends that drops white space, folds case and puts letters
    and punctuation into separate pieces. Words are folded and parted from closing punctuation
    as arrays; only what is new after that is encoded. Pieces and their ids are kept as arrays
    too, up to a bound; the half asked for last stays.
    """

    def __init__(self, path: str) -> None:
        quiet_tokenizers()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = f"<u{id_width(self.tokenizer)}"
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: By id: whether it closes a word.
        self.closing = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        if suffix:
            self.closing[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        #: Pieces met, their ids as bytes, and the call that last asked for each.
        self.pieces, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used, self.calls = np.zeros(0, np.int64), 0

    def _packed(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """One binary value per piece: ``ids`` up to each of ``ends``."""
        offsets = np.append(0, ends).astype(np.int64) * ids.itemsize
        return pa.Array.from_buffers(
            pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])

    def _together(self, pieces: list[str]) -> pa.Array:
        """Ids of pieces, encoded as one text and told apart by where they start in it."""
        found = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        at = np.fromiter((start for start, _ in found.offsets), np.int64, len(found.ids))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
        return self._packed(np.array(found.ids, self.dtype), np.searchsorted(at, ends))

    def _letters(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces of letters, encoded as one text: each ends with the id that closes a word."""
        text = " ".join(pieces.to_pylist())
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        ids = np.array(found, self.dtype)
        ends = np.flatnonzero(self.closing[ids]) + 1
        return self._packed(ids, ends) if len(ends) == len(pieces) else self._together(text.split(" "))

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """Ids of new pieces: those within Latin-1 many at a time, others each on its own."""
        letters = pc.match_substring_regex(pieces, LETTERS).to_numpy(zero_copy_only=False)
        alone = pc.or_(foreign(pieces), pc.equal(pieces, "")).to_numpy(zero_copy_only=False)
        kinds = [np.flatnonzero(x) for x in (letters, ~letters & ~alone, alone)]
        encoded = [pa.array([], pa.large_binary())]
        for at in range(0, len(kinds[0]), RUNS):
            encoded.append(self._letters(pieces.take(pa.array(kinds[0][at: at + RUNS]))))
        for at in range(0, len(kinds[1]), RUNS):
            encoded.append(self._together(pieces.take(pa.array(kinds[1][at: at + RUNS])).to_pylist()))
        encoded.append(pa.array(
            [np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, self.dtype).tobytes()
             for x in pieces.take(pa.array(kinds[2])).to_pylist()], pa.large_binary()))
        return pa.concat_arrays(encoded).take(pa.array(np.argsort(np.concatenate(kinds))))

    def _ids(self, pieces: pa.Array, bound: int) -> pa.Array:
        """The ids of each of some distinct pieces, as bytes; ``bound`` pieces are kept at most."""
        self.calls += 1
        # The kept pieces are looked up among the asked ones: fewer of those go into a hash table.
        found = pc.index_in(self.pieces, value_set=pieces)
        kept = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        self.used[kept] = self.calls
        at = np.full(len(pieces), -1)
        at[found.drop_null().to_numpy()] = kept
        new = np.flatnonzero(at < 0)
        at[new] = len(self.pieces) + np.arange(len(new))
        asked = pieces.take(pa.array(new))
        learned = self._learn(asked)
        ids = pa.concat_arrays([self.ids, learned])
        short = pc.less_equal(pc.binary_length(asked), LONGEST)
        asked, learned = asked.filter(short), learned.filter(short)
        self.pieces = pa.concat_arrays([self.pieces, asked])
        self.ids = pa.concat_arrays([self.ids, learned])
        self.used = np.append(self.used, np.full(len(asked), self.calls))
        if len(self.used) > bound:
            stay = np.sort(np.argsort(-self.used, kind="stable")[:bound // 2])
            self.pieces, self.ids = self.pieces.take(pa.array(stay)), self.ids.take(pa.array(stay))
            self.used = self.used[stay]
        return ids.take(pa.array(at))

    def encode(self, texts: pa.Array, end_id: int,
               bound: int = CACHED_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and the number of ids of each text."""
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        bounds, codes, distinct = words(texts)
        both = pa.concat_arrays(folded(distinct.cast(pa.large_string()))).dictionary_encode()
        known = self._ids(both.dictionary, bound).take(both.indices)
        stems, tails = known[:len(distinct)], known[len(distinct):]
        ids = pa.concat_arrays([
            pc.binary_join_element_wise(stems, tails, pa.scalar(b"", pa.large_binary())),
            pa.array([np.array(end_id, self.dtype).tobytes()], pa.large_binary())])
        # One more word, the end, after the words of each text.
        all_ids = ids.take(pa.array(np.insert(codes, bounds[1:], len(distinct))))
        _, offsets, flat = all_ids.buffers()
        ends = np.frombuffer(offsets, np.int64)[bounds[1:] + np.arange(1, len(bounds))]
        ends = ends // np.dtype(self.dtype).itemsize
        return np.frombuffer(flat, self.dtype, ends[-1]), np.diff(ends, prepend=0)


def id_width(tokenizer) -> int:
    """Bytes per id."""
    return 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4


def foreign(pieces: pa.Array) -> pa.Array:
    """Whether pieces are the tokenizer's own affair: with an added token's ``<|`` or beyond Latin-1."""
    return pc.or_(pc.invert(pc.match_substring_regex(pieces, r"^[\x{0}-\x{FF}]*$")),
                  pc.match_substring(pieces, "<|"))


def folded(distinct: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words as lower-case stems and closing punctuation, where both encode apart the same.

    Other words stay whole: those with an added token's ``<|`` and those beyond Latin-1, whose
    case and composition rules are the tokenizer's own.
    """
    own = foreign(distinct)
    lower = pc.if_else(own, distinct, pc.utf8_lower(distinct))
    apart = pc.and_(pc.invert(own), pc.match_substring_regex(lower, r"[0-9a-zß-öø-ÿ][.,!?;:]+$"))
    stem = pc.if_else(apart, pc.utf8_rtrim(lower, ".,!?;:"), lower)
    tail = pc.if_else(apart, pc.replace_substring_regex(lower, r"(?s)^.*[^.,!?;:]", ""), "")
    return stem, tail


@cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, kept between tasks."""
    return WordEncoder(path)


def write_tokens(docs: DataFrame, root: str, tokenizer_path: str, end_id: int,
                 id_column: str = "doc_id", text_column: str = "text",
                 slice_bytes: int = SLICE_BYTES, batch_bytes: int | None = None) -> TokenStore:
    """Encode every text (null: empty) and write the ids in ascending document order.

    Documents are dealt by ranges of their id, so the order of parts is the order of ids.
    Equal ids stay together, ordered by text; rows without an id come first. A part is written
    under another name and renamed when whole, so repeated or parallel attempts are harmless.
    The driver sees one row per part. An empty table gives a store without parts. ``slice_bytes`` of
    text are encoded at once; a worker takes some thirty bytes for each, and small slices more time.
    ``batch_bytes``, if given, is the session's limit on bytes per Arrow batch while the files are
    written; an executor holds buffers of up to twice that besides its heap.
    """
    quiet_tokenizers()
    from tokenizers import Tokenizer

    width = id_width(Tokenizer.from_file(tokenizer_path))
    ordered = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"),
                    F.coalesce(F.col(text_column), F.lit("")).alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    conf = docs.sparkSession.conf
    before = conf.get(BATCH_SETTING)
    if batch_bytes is not None:
        conf.set(BATCH_SETTING, f"{batch_bytes}b")
    try:
        written = ordered.mapInArrow(
            _part_writer(root, width, tokenizer_path, end_id, slice_bytes), PART).collect()
    finally:
        conf.set(BATCH_SETTING, before)
    parts, base = [], 0
    for row in sorted(written):
        parts.append((*row, base))
        base += row.ids
    return TokenStore(root, width, tuple(parts))


def _part_writer(root: str, width: int, tokenizer_path: str, end_id: int,
                 slice_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, (fs, folder) = TaskContext.get().partitionId(), file_system(root)
        fs.create_dir(folder, recursive=True)
        names = {kind: f"{folder}/.{part}.{uuid.uuid4().hex}.{kind}"
                 for kind in ("ids", "offsets", "docs")}
        out = {kind: fs.open_output_stream(name) for kind, name in names.items()}
        docs = without_id = ids = 0
        out["offsets"].write(np.zeros(1, "<i8").tobytes())
        for batch in slices(batches, "text", slice_bytes):
            found, each = word_encoder(tokenizer_path).encode(
                batch.column("text"), end_id, min(CACHED_WORDS, slice_bytes // PER_PIECE))
            out["ids"].write(found.astype(f"<u{width}", copy=False).tobytes())
            out["offsets"].write((ids + np.cumsum(each)).astype("<i8").tobytes())
            keys = batch.column("doc_id")
            out["docs"].write(keys.fill_null(0).to_numpy().astype("<i8").tobytes())
            docs, without_id, ids = docs + len(each), without_id + keys.null_count, ids + len(found)
        for kind, stream in out.items():
            stream.close()
            if docs:
                fs.move(names[kind], f"{folder}/{part}.{kind}")
            else:
                fs.delete_file(names[kind])
        if docs:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), *(pa.array([n], pa.int64())
                                                 for n in (docs, without_id, ids))],
                names=["part", "docs", "without_id", "ids"])
    return write


def flat(root: str, name: str, dtype: str) -> np.ndarray:
    """A flat file: memory-mapped where it is local, else read from its store."""
    fs, folder = file_system(root)
    path = f"{folder}/{name}"
    if fs.type_name == "local":
        return np.memmap(path, dtype=dtype, mode="r")
    with fs.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype=dtype)


def read_tokens(spark: SparkSession, store: TokenStore, rows: int = 5_000) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens and ids_crc32.

    ``start`` counts the ids of all documents before it; the checksum is over its ids, end id
    included, as little-endian unsigned 32-bit integers.
    """
    listed = spark.createDataFrame(
        list(store.parts), f"{PART}, base long").repartition(max(1, len(store.parts)))
    root, dtype = store.root, store.dtype

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = flat(root, f"{row['part']}.ids", dtype)
                offsets = flat(root, f"{row['part']}.offsets", "<i8")
                docs = flat(root, f"{row['part']}.docs", "<i8")
                for a in range(0, row["docs"], rows):
                    b = min(a + rows, row["docs"])
                    cuts = np.asarray(offsets[a: b + 1])
                    sums = [zlib.crc32(ids[i:j].astype("<u4").tobytes())
                            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(docs[a:b].astype(np.int64),
                                 mask=np.arange(a, b) < row["without_id"]),
                        pa.array(row["base"] + cuts[:-1]), pa.array(np.diff(cuts)),
                        pa.array(sums, pa.int64()),
                    ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
