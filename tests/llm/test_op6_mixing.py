import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import mixing as m
from tallyloom.llm import tables
from tallyloom.llm.queries import QUERIES


def fill(sizes, weights):
    """Targets by resharing until none is above its limit."""
    total, held = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in held]
        rest = total - sum(3 * sizes[i] for i in held)
        out = {i: 3 * sizes[i] for i in held} | {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if out[i] > 3 * sizes[i]}
        if not over:
            return [out[i] for i in range(len(sizes))]
        held |= over


def run(df, **options):
    mixed = m.mix(df, "source", m.word_count(F.col("text")), [F.col("doc_id")], **options)
    return mixed.select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 3, 50, 1000, 7777]) for _ in range(rnd.randint(1, 12))]
    df = spark.createDataFrame([(True, f"s{i:02}", x) for i, x in enumerate(sizes)], "named boolean, name string, source_size long")
    got = {r.name: r.target for r in m.source_targets(df).collect()}
    want = fill(sizes, [m.WEIGHTS[i % 3] for i in range(len(sizes))])
    assert [got[f"s{i:02}"] for i in range(len(sizes))] == pytest.approx(want)


def test_taken_words_come_near_targets_and_fill_the_budget(spark, documents):
    rnd = random.Random(6)
    rows = [(" ".join("w" * rnd.randint(1, 40)), rnd.choice("aaaaabcd")) for _ in range(2000)]
    got = run(documents(*rows))
    assert sum(r.taken for r in got) == sum(r["size"] for r in got)
    for source in "abcd":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 40
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert sorted(got) == sorted(run(documents(*rows).repartition(7)))


def brute(rows):
    """One queue over all copies; rows are (place, source, size)."""
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(z for _, s, z in rows if s == name) for name in names]
    targets = fill(sizes, [m.WEIGHTS[i % 3] for i in range(len(names))])
    copies = []
    for turn, name in enumerate(names):
        until = 0
        for e in range(3):
            for place, _, z in sorted(r for r in rows if r[1] == name):
                until += z
                if z and targets[turn]:
                    copies.append((until / targets[turn], turn, until, place, z))
    left, taken = sum(sizes), {}
    for _, _, _, place, z in sorted(copies):
        taken[place] = taken.get(place, 0) + min(z, left)
        left -= min(z, left)
    return taken


def test_against_one_queue(spark, documents):
    import hashlib

    rnd = random.Random(9)
    rows = [(i, " ".join("w" * rnd.choice([0, 1, 5, 30, 400])), rnd.choice(["x", "y", "z", None, "é"])) for i in range(150)]
    place = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    want = brute([(place(i), s, len(t.split())) for i, t, s in rows])
    assert {r.doc_id: r.taken for r in run(documents(*rows))} == {i: want.get(place(i), 0) for i, _, _ in rows}


@pytest.mark.parametrize("ranges, rows", [(2, 1), (3, 5), (4096, 2)])
def test_the_cut_range_is_cut_again(spark, documents, monkeypatch, ranges, rows):
    import hashlib

    monkeypatch.setattr(m, "RANGES", ranges)
    monkeypatch.setattr(m, "RANGE_ROWS", rows)
    found = []
    cut = m.cut_range
    monkeypatch.setattr(m, "cut_range", lambda *x: found.append(cut(*x)) or found[0])
    rnd = random.Random(10)
    texts = [(i, " ".join("w" * rnd.choice([1, 2, 300])), rnd.choice("xyz")) for i in range(120)]
    place = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    want = brute([(place(i), s, len(t.split())) for i, t, s in texts])
    assert {r.doc_id: r.taken for r in run(documents(*texts))} == {i: want.get(place(i), 0) for i, _, _ in texts}
    assert 1 <= found[0][0].count() <= max(rows, 3)


def test_pieces_follow_the_largest_group(monkeypatch):
    assert [tables.piece_digits(n) for n in (0, 256 << 16, (256 << 16) + 1, 4096 << 16, 10**12)] == [2, 2, 3, 3, 6]


def test_query_edges(spark, documents, as_tables):
    docs = documents(None, "", (5, "a b c", None), (5, "a b c", None), (5, "a b c", None), (None, "x " * 50_000, "big"), ("one", "s"), extra="taken string, size string, row string, target string")
    rows = QUERIES["op6_source_mixing"](spark, as_tables(documents=docs)).collect()
    assert len(rows) == 7 and sum(r.taken for r in rows) == sum(r["size"] for r in rows) == 50_010
    for empty in (docs.where("false"), documents(None, "")):
        got = QUERIES["op6_source_mixing"](spark, as_tables(documents=empty)).collect()
        assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)] * empty.count()
