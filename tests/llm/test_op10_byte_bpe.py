import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import byte_bpe as b
from tallyloom.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
BPE = b.ByteBpe.load(PATH, PATTERN)
with open(PATH, "rb") as lines:
    RANKS = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text_as_the_library_does(text):
    ids = BPE.encode(text).tolist()
    assert ids == LIBRARY.encode_ordinary(text) and BPE.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 30_000, "é" * 9_999, " " * 10_000 + "x", "\n \n" * 4_000])
def test_very_long_matches(text):
    assert BPE.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_queue_gives_lowest_rank_then_leftmost():
    rnd, queue = random.Random(3), b.RankQueue(262_144)
    entries = [(rnd.choice([0, 63, 64, 4095, 4096, 50_000, 262_143]), rnd.randrange(99)) for _ in range(400)]
    for entry in entries:
        queue.push(*entry)
    got = []
    while queue.top:
        got.append(queue.take())
    assert got == sorted(entries) and not any(queue.words) and not any(queue.buckets)


def test_small_cache_changes_nothing():
    bpe = b.ByteBpe(RANKS, PATTERN)
    bpe.cache.half = 3
    text = " ".join(f"w{i % 11}x{i % 7}" for i in range(500))
    assert bpe.encode(text).tolist() == LIBRARY.encode_ordinary(text) and len(bpe.cache) <= 3


def test_query_edges(spark, documents, as_tables):
    texts = [None, "", "Hello world", "Hello world", "z" * 200_000, "<|endoftext|>"]
    docs = documents(*texts, (None, "x", None), extra="token_ids string, decoded string, id string")
    rows = {r.doc_id: r for r in QUERIES["op10_byte_bpe"](spark, as_tables(documents=docs)).collect()}
    for i, text in enumerate(texts):
        ids = LIBRARY.encode_ordinary(text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert len(rows) == 7
    assert QUERIES["op10_byte_bpe"](spark, as_tables(documents=docs.where("false"))).count() == 0


def test_decode_ids(spark, documents):
    encoded = b.encode_texts(documents("ab é", None), PATH, PATTERN)
    decoded = b.decode_ids(encoded, PATH, PATTERN)
    assert {r.doc_id: bytes(r.decoded) for r in decoded.collect()} == {0: "ab é".encode(), 1: b""}
