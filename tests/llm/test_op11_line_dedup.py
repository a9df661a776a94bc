import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa

from tallyloom.llm import line_dedup as d
from tallyloom.llm.queries import QUERIES

LONG = "this line is quite long enough to count as one, number "


def key(line):
    line = re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), line)


def brute(rows, least_chars=40, least_documents=5):
    """For (id, text): kept text, lines, dropped lines."""
    holders = defaultdict(dict)
    for r, (i, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            holders[key(line)][r] = i
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            found = holders[key(line)].values()
            largest = max((x for x in found if x is not None), default=None)
            if len(key(line)) < least_chars or len(found) < least_documents or i == largest:
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def result(df):
    return sorted(((r[0], r.kept, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_against_brute_force(spark, documents):
    rnd = random.Random(11)
    pool = [f"{LONG}{i % 7}" + "é" * (i % 3) for i in range(14)] + ["short", "", " " * 50, "ÀÉ" * 20, "ÀÉ" * 19 + "x"]
    dress = [str, str.upper, lambda x: f" \t{x}\x0b\r", lambda x: f"\x85{x}", str.title]
    rows = []
    for i in range(120):
        lines = [rnd.choice(dress)(rnd.choice(pool)) for _ in range(rnd.randint(0, 8))]
        rows.append((rnd.choice([i, i, None, 500]), "\n".join(lines)))
    rows += [(7, None), (8, ""), (9, "\n\n"), (3, LONG + "x" * 200_000), (None, "y" * 100)] * 6
    docs = documents(*[(i, t, "s") for i, t in rows], extra="kept string, lost string, key string, shard string")
    for least_chars, least_documents in ((40, 5), (1, 2), (41, 1)):
        got = result(d.dedup_lines(docs, least_chars=least_chars, least_documents=least_documents))
        assert got == sorted(brute(rows, least_chars, least_documents), key=repr)


def test_hot_line_is_dealt_to_copies_of_its_shard(spark, documents, monkeypatch):
    monkeypatch.setattr(d, "PROBES", 16)
    rows = [(i, f"{LONG}0\n{LONG}{i + 1}") for i in range(300)]
    docs = documents(*[(i, t, "s") for i, t in rows])
    index, copies = d.sharded_index(d.counted_lines(docs.withColumnRenamed("doc_id", "id"), 40))
    assert len(copies) == 1 and copies[0] == 1  # four probes per hash before a copy is worth it
    hot = [(i, f"{LONG}0") for i in range(300)]
    docs = documents(*[(i, t, "s") for i, t in hot])
    index, copies = d.sharded_index(d.counted_lines(docs.withColumnRenamed("doc_id", "id"), 40))
    assert copies[0] == 300 // 16 + 1 and index.count() == copies[0]
    assert result(d.dedup_lines(docs)) == sorted(brute(hot), key=repr)
    monkeypatch.setattr(d, "SHARD_KEYS", 3)
    docs = documents(*[(i, t, "s") for i, t in rows])
    assert result(d.dedup_lines(docs)) == sorted(brute(rows), key=repr)


def test_perfect_hash_gives_each_hash_a_slot_of_its_own():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50_000):
        first, second = rnd.integers(0, 1 << 63, (2, n), np.uint64)
        second[: n // 2] = second[:1]  # halves alone need not differ
        index = d.LineIndex.read(d.LineIndex.build(first, second, np.arange(n), -np.arange(n)).arrays())
        assert sorted(index.slots(first, second)) == list(range(n))
        counts, owners = index.found(first, second)
        assert (counts == np.arange(n)).all() and (owners == -np.arange(n)).all()
        strange = rnd.integers(0, 1 << 63, (2, 20_000), np.uint64)
        assert not index.found(*strange)[0].any()
        assert len(index.bits) <= 5 * n + 64 * len(index.levels)


def test_hashes_of_texts():
    row, first, second = d.document_hashes(pa.array([f"{LONG}\n{LONG.upper()} \nx", None, f"\n{LONG}\n{LONG}2"]), 40)
    assert row.tolist() == [0, 2, 2] and first[0] in first[1:]


def test_empty_table(spark, documents, as_tables):
    query = QUERIES["op11_line_dedup"]
    assert query(spark, as_tables(documents=documents("x").where("false"))).collect() == []
    rows = query(spark, as_tables(documents=documents(None, "", "short"))).collect()
    assert sorted((r.n_lines, r.n_dropped) for r in rows) == [(1, 0)] * 3
