from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from coldloop.llm import token_files
from coldloop.llm.queries import END_ID, QUERIES
from tests.llm import corpus

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = corpus.texts(40) + [
    "It's the DOG's, isn't it?! 3.14 a@b.c <|endoftext|> <|STARTOFTEXT|>x", "ÉCOLE naïve Straße, ŒUVRE",
    "ΣΊΣΥΦΟΣ İstanbul é é  wide space", "日本語 テスト 한국어 العربية", "x,y;z:w...!? ,a, 'd' 's",
    "don't,can't. rock'st 12ab34 µ ÿ Ÿ ǅ", "▁ @ @@ a@ \U0001f600 \U0001f1e9\U0001f1ea"]


def whole(text):
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, END_ID], "<u4")


TOKENIZER = Tokenizer.from_file(PATH)


def test_files_hold_what_whole_texts_encode_to(spark, documents):
    rows = list(enumerate(TEXTS))[::-1]
    got = sorted(QUERIES["op7_token_files"](spark, documents(rows)).collect())
    start = 0
    for row, text in zip(got, TEXTS, strict=True):
        ids = whole(text)
        assert tuple(row[1:]) == (start, len(ids), zlib.crc32(ids.tobytes())), text
        start += len(ids)


def test_flat_files_offsets_and_order(spark, tmp_path):
    docs = spark.createDataFrame(
        [(5, "b", 1), (None, "null id", 2), (5, "a", 3), (2, None, 4), (-3, "x y z", 5)],
        "doc_id long, text string, part int")
    root = f"{tmp_path}/store"
    store = token_files.write_tokens(docs, root, PATH, END_ID)
    ids, base = [], 0
    for part, n, _, size, start in store.parts:
        flat = np.fromfile(f"{root}/{part}.ids", store.dtype)
        offsets = np.fromfile(f"{root}/{part}.offsets", "<i8")
        assert start == base and len(flat) == size == offsets[-1] and len(offsets) == n + 1
        ids += flat.tolist()
        base += size
    order = ["null id", "x y z", "", "a", "b"]
    assert ids == np.concatenate([whole(t) for t in order]).tolist()
    got = token_files.read_tokens(spark, store).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -3, 2, 5, 5]
    assert not [p for p in Path(root).iterdir() if p.name.startswith(".") and p.suffix != ".crc"]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    store = token_files.write_tokens(docs, f"{tmp_path}/none", PATH, END_ID)
    assert store.parts == () and token_files.read_tokens(spark, store).count() == 0


def test_long_texts_reach_the_encoder_in_small_batches(spark, tmp_path, monkeypatch):
    """Texts of over 10 MB in one partition came as one batch, and were encoded 4 MB at a time."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["alpha", "beta", f"w{i}", "Gamma,"], 2_000)) for i in range(1_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    seen, cut = tmp_path / "seen", token_files.slices

    def watched(batches, *how):
        def noted(some, kind):
            for batch in some:
                with seen.open("a") as out:
                    print(kind, batch.column("text").nbytes, file=out)
                yield batch
        yield from noted(cut(noted(batches, "batch"), *how), "slice")

    limit = spark.conf.get(token_files.BATCH_SETTING)
    monkeypatch.setattr(token_files, "slices", watched)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        store = token_files.write_tokens(docs, f"{tmp_path}/store", PATH, END_ID,
                                         slice_bytes=corpus_pipeline.ENCODED_SLICE,
                                         batch_bytes=corpus_pipeline.ENCODED_BATCH)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    sizes = {"batch": [], "slice": []}
    for line in seen.read_text().splitlines():
        kind, size = line.split()
        sizes[kind].append(int(size))
    total = sum(map(len, texts))
    assert total > 10 << 20 and sum(sizes["batch"]) >= total
    assert max(sizes["batch"]) < 5 << 20 and max(sizes["slice"]) < 3 << 19
    assert spark.conf.get(token_files.BATCH_SETTING) == limit
    got = token_files.read_tokens(spark, store).orderBy("start").collect()
    assert [r.doc_id for r in got] == list(range(1_000))
    for row in got[::97]:
        ids = whole(texts[row.doc_id])
        assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


class Counted:
    """A tokenizer that counts the words it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, 0

    def encode(self, text, **how):
        self.words += len(text.split())
        return self.tokenizer.encode(text, **how)

    def encode_batch_fast(self, texts, **how):
        self.words += sum(len(text.split()) for text in texts)
        return self.tokenizer.encode_batch_fast(texts, **how)


def letters(n):
    """``n`` distinct words."""
    return ["".join(chr(97 + n // 26 ** k % 26) for k in range(5)) for n in range(n)]


def test_pieces_are_encoded_once_while_they_are_kept():
    """Over 120,000 pieces were forgotten before the next slice and encoded again."""
    encoder = token_files.WordEncoder(PATH)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    text = " ".join(letters(150_000))
    first, each = encoder.encode(pa.array([text, "aaaaa"]), END_ID)
    assert each.tolist() == [len(whole(text)), len(whole("aaaaa"))]
    assert first.tolist() == [*whole(text).tolist(), *whole("aaaaa").tolist()]
    before = counted.words
    again, _ = encoder.encode(pa.array([text.title(), "aaaaa."]), END_ID)
    assert counted.words - before <= 1  # the full stop
    assert again.tolist() == [*whole(text).tolist(), *whole("aaaaa.").tolist()]


@pytest.mark.parametrize("kept", [0, 3, 1_000])
def test_kept_pieces_are_bounded_and_ids_stay_right(kept):
    encoder = token_files.WordEncoder(PATH)
    long = "ab" * token_files.LONGEST
    for texts in (TEXTS, TEXTS[::-1], [None, "", "\xa0", " \xa0 \x85x"], [long, None, f"{long}, {long}"],
                  [" ".join(letters(900)), "Aaaaa"], TEXTS):
        ids, each = encoder.encode(pa.array(texts, pa.string()), END_ID, kept)
        expected = [whole(text) for text in texts]
        assert each.tolist() == [len(x) for x in expected]
        assert ids.tolist() == np.concatenate(expected).tolist()
        assert len(encoder.pieces) == len(encoder.ids) == len(encoder.used) <= kept
        assert long not in encoder.pieces.to_pylist()


def test_words_without_a_closing_id_are_told_apart_by_offsets():
    encoder = token_files.WordEncoder(PATH)
    encoder.closing[:] = False
    ids, each = encoder.encode(pa.array(TEXTS), END_ID)
    assert each.tolist() == [len(whole(text)) for text in TEXTS]
    assert ids.tolist() == np.concatenate([whole(text) for text in TEXTS]).tolist()
