import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import importance as m
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.ranking import with_place
from tallyloom.llm.tables import text_buffers, written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def runs(text, order=2):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def brute(docs, target):
    bucket = lambda x: zlib.crc32(x.encode()) % 10_000
    s, t = (Counter(bucket(x) for text in side for x in runs(text)) for side in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (all_s + 10_000)) / ((s[b] + 1) * (all_t + 10_000))))
    out = []
    for i, text in docs:
        gains = [gain(bucket(x)) for x in runs(text)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(gains), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    may = sorted((x for x in out if x[4] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    rank = {id(x): n for n, x in enumerate(may[: 25 * len(may) // 100], 1)}
    return [(*x[:4], rank.get(id(x))) for x in out]


TEXTS = ["Hello  World é foo_bar 12", "", None, "one", "Ünï çödé ÄA zZ", " ".join(f"w{i * i % 97}" for i in range(700)), "x" * 300 + " " + "y" * 70]


@pytest.mark.parametrize("piece, size", [(1 << 20, 1 << 22), (7, 11), (1, 3)])
@pytest.mark.parametrize("order", [1, 2, 4])
def test_crcs_of_all_runs(piece, size, order, monkeypatch):
    monkeypatch.setattr(m, "PIECE", piece)
    monkeypatch.setattr(m, "SLICE", size)
    got = Counter()
    for found in m.scanned(*text_buffers(pa.array(TEXTS * 2)), order):
        for owner, crcs in m.run_crcs(found, order):
            got.update(zip(owner.tolist(), crcs.tolist()))
    assert got == Counter((i, zlib.crc32(x.encode())) for i, t in enumerate(TEXTS * 2) for x in runs(t, order))


def test_shift_cancels_what_stands_before():
    rnd = random.Random(4)
    for size in [0, 1, 7, 63, 64, 65, 1000, 70_001]:
        before, run = rnd.randbytes(50), rnd.randbytes(size)
        moved = m.shifted(np.array([zlib.crc32(before)], np.uint32), np.array([size]))[0]
        assert zlib.crc32(before + run) ^ int(moved) == zlib.crc32(run)


def test_against_brute_force(spark, documents):
    rnd = random.Random(13)
    make = lambda n: " ".join(f"Wörd{rnd.randrange(50)}" for _ in range(n))
    docs = [(rnd.choice([i, i, None, 9]), make(rnd.randint(0, 60))) for i in range(300)] + [(3, None), (4, "")]
    docs += [(900, make(30))] * 1 + [(901, "same text " * 20)] * 40
    target = [make(30), None, "Wörd1 Wörd2 " * 50]
    table = documents(*[(i, t, "s") for i, t in docs], extra="rank string, score string, n string, place string")
    got = m.resample(table, spark.createDataFrame([(x,) for x in target], "text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(brute(docs, target), key=repr)


def test_empty_tables(spark, documents, as_tables):
    query = QUERIES["op13_importance_resampling"]
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert query(spark, as_tables(documents=documents("x").where("false"), benchmark=items)).collect() == []
    docs = [(i, f"word{i} " * 30) for i in range(8)]
    folder = as_tables(documents=documents(*[(i, t, "s") for i, t in docs]), benchmark=items.where("false"))
    assert sorted(tuple(r) for r in query(spark, folder).collect()) == sorted(brute(docs, []))


def test_places_over_many_equal_rows(spark):
    rows = written(spark.range(5000).selectExpr("id % 3 AS a", "cast(null AS string) AS place", "id"), "rows")
    placed = with_place(rows, [F.desc("a")], "n").collect()
    assert sorted(r.n for r in placed) == list(range(1, 5001))
    assert [r.a for r in sorted(placed, key=lambda r: r.n)] == sorted((r.a for r in placed), reverse=True)
