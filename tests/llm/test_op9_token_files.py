import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import token_files as t
from tallyloom.llm.queries import END_ID, QUERIES
from tallyloom.llm.tables import written

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", [t.BYTE_PLANES, t.BIT_PLANES])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 99, 100, 101, 1000])
def test_round_trip_and_ranges(kind, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32 if n % 2 else 50_000, n).astype("<u4")
    counts = [n // 3, 0, n - n // 3]
    file = t.TokenFile(t.file_bytes(ids, [-5, None, 2**62], counts, kind, block_ids=100))
    assert file.documents == [-5, None, 2**62] and file.counts.tolist() == counts
    for start, stop in ((0, n), (n // 2, n), (n // 3, n // 2), (n, n), (99, min(n, 101))):
        assert file.read(start, stop).tolist() == ids[start:stop].tolist()


def test_planes_are_transposed():
    ids = np.array([0x01020304, 0x11121314], "<u4")
    assert t.to_planes(ids, t.BYTE_PLANES).tolist() == [[0x04, 0x14], [0x03, 0x13], [0x02, 0x12], [0x01, 0x11]]
    bits = t.to_planes(np.array([1, 0, 3], "<u4"), t.BIT_PLANES)
    assert bits.shape == (32, 1) and bits[:3, 0].tolist() == [0b101, 0b100, 0]


def test_cut_off_file_is_refused():
    data = t.file_bytes(np.arange(10, dtype="<u4"), [1], [10])
    with pytest.raises(ValueError):
        t.TokenFile(data[:-1])


def test_words_as_the_library_does_whole_texts():
    words = t.WordIds(PATH)
    rnd = random.Random(3)
    parts = ["ab", "İ", "ΑΣ", "é", "́x", " ", "  ", "\n", "\t", " ", "　", "'s", "12", "!?", "<|endoftext|>", "가", "ᄀ", "ᅡ", "ﬁ", "Ab", "²", "_", ".", ",$"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(1500)]
    texts += [chr(c) + mark for c in range(33, 0x260) for mark in ("", "x", ".", "X'")]
    for half in (words.half, 3):
        words.half = half
        for text in texts:
            assert np.frombuffer(words.encode(text), "<u4").tolist() == library(text), repr(text)


def test_marks_of_special_tokens_as_the_library_does_by_default(spark, documents, as_tables):
    default, words, rnd = Tokenizer.from_file(PATH), t.WordIds(PATH), random.Random(4)
    parts = ["ab", "é", " ", "\n", "\t", ".", "'s", "<|", "|>", "İ", "12", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]
    texts = ["<|endoftext|>", "a<|endoftext|>b", "a <|startoftext|>.", *("".join(rnd.choices(parts, k=rnd.randint(0, 9))) for _ in range(2000))]
    for text in texts:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == default.encode(text, add_special_tokens=False).ids, repr(text)
    assert 49407 in np.frombuffer(words.encode("a<|endoftext|>b"), "<u4")
    rows = QUERIES["op9_token_files"](spark, as_tables(documents=documents(*texts[:3]))).orderBy("start").collect()
    ids = [[*default.encode(x, add_special_tokens=False).ids, END_ID] for x in texts[:3]]
    assert [(r.n_tokens, r.ids_crc32) for r in rows] == [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids]


def test_query_edges(spark, documents, as_tables):
    texts = [None, "", "Hello world", "Hello\nWORLD !", "z" * 100_000, "é " * 30_000]
    rows = [(i * 7 - 9, x, "s") for i, x in enumerate(texts)] + [(None, "no id", "s"), (5, "same", "s"), (5, "same", "s")]
    docs = documents(*rows, extra="ids string, part string, id string, payload string")
    got = sorted(QUERIES["op9_token_files"](spark, as_tables(documents=docs)).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    start = 0
    by_id = {}
    for row in rows:
        by_id.setdefault(row[0], set()).add(tuple([*library(row[1]), END_ID]))
    for r in got:
        want = next(ids for ids in by_id[r.doc_id] if len(ids) == r.n_tokens and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32)
        assert r.start == start
        start += len(want)
    assert QUERIES["op9_token_files"](spark, as_tables(documents=docs.where("false"))).count() == 0






def test_many_small_files_keep_the_order(spark, documents):
    docs = documents(*[(i, " ".join(["word"] * (i % 7)), "s") for i in range(300)]).repartition(5)
    files = written(t.encode_files(docs, lambda: t.WordIds.load(PATH).encode, 2, 4, kind=t.BIT_PLANES, file_ids=50), "files")
    assert files.count() > 10
    got = sorted(t.read_files(files).collect(), key=lambda r: r.doc_id)
    assert [r.n_tokens for r in got] == [i % 7 + 1 for i in range(300)]
    assert [r.start for r in got] == np.cumsum([0, *[i % 7 + 1 for i in range(299)]]).tolist()
