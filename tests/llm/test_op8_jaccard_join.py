import random
import re
import time

import numpy as np
import pytest

from tallyloom.llm import jaccard_join as j
from tallyloom.llm import words as w
from tallyloom.llm.components import components
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.tables import text_buffers


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < j.WIDTH:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + j.WIDTH]) for i in range(len(found) - j.WIDTH + 1)}


def brute(rows):
    """Component of each row, by comparing all pairs; rows are (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and root(a) != root(b):
                if 100 * len(sets[a] & sets[b]) >= j.PERCENT * len(sets[a] | sets[b]):
                    parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def corpus(seed):
    """Chains and groups of near copies around the threshold, with passages that many texts share."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    passages = [[word() for _ in range(rnd.choice([20, 60]))] for _ in range(3)]
    texts = [None, "", " ", "a", "A", "a b c d", "a b c d e", "A B c d e"]
    for _ in range(25):
        base = [word() for _ in range(rnd.choice([3, 6, 12, 30, 90]))]
        if rnd.random() < 0.5:
            base += rnd.choice(passages)
        for _ in range(rnd.randint(1, 6)):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            if rnd.random() < 0.5:
                base = copy
    texts += rnd.choices(texts, k=10)
    rnd.shuffle(texts)
    return [(i if i % 9 else rnd.choice([None, i, 4]), t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, entries", [(1, j.ORDERED), (2, 0), (3, 20)])
def test_against_all_pairs(spark, monkeypatch, seed, entries):
    monkeypatch.setattr(j.frequent_windows, "__defaults__", (entries,))
    rows = corpus(seed)
    got = j.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows))


def test_without_first_links(spark, monkeypatch):
    """The matches alone find every link."""
    none = lambda grouped, percent: grouped.selectExpr("class a", "class b").where("false")
    monkeypatch.setattr(j, "chained_pairs", none)
    rows = corpus(4)
    got = j.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows))


def test_whole_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = QUERIES["op8_ngram_jaccard_join"](spark, "/root/testdata/sf0.001").collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows))


def test_query_edges(spark, documents, as_tables):
    long = " ".join(f"v{i}" for i in range(60_000))
    docs = documents(long, long + " end", None, (7, "x y", None), (7, "x y", None), extra="class string, n string, component_id string, window string")
    got = QUERIES["op8_ngram_jaccard_join"](spark, as_tables(documents=docs)).collect()
    assert ordered(map(tuple, got)) == [(0, 59_996, 0), (1, 59_997, 0), (2, 0, 2), (7, 1, 7), (7, 1, 7)]
    assert QUERIES["op8_ngram_jaccard_join"](spark, as_tables(documents=docs.where("false"))).count() == 0


def test_linked_sets_share_windows_of_their_prefixes():
    rnd = np.random.default_rng(5)
    for _ in range(300):
        x = np.unique(rnd.integers(0, 1 << 62, rnd.integers(1, 60)).astype(np.uint64))
        y = np.unique(np.concatenate([x[rnd.random(len(x)) < 0.93], rnd.integers(0, 1 << 62, 2).astype(np.uint64)]))
        common = len(np.intersect1d(x, y))
        if 100 * common < j.PERCENT * (len(x) + len(y) - common):
            continue
        known = np.sort(rnd.choice(x, min(len(x), 7), replace=False))
        table = known, rnd.integers(2, 9, len(known))
        order = [s[np.argsort(j.frequencies(s, *table), kind="stable")] for s in (x, y)]
        o = [j.needed(len(s), 80) for s in (x, y)]
        for level in range(1, min(o) + 1):
            prefix = [set(s[: len(s) - k + level].tolist()) for s, k in zip(order, o)]
            assert len(prefix[0] & prefix[1]) >= level
            overlap = -(-80 * (len(x) + len(y)) // 180)
            assert len(prefix[0] & prefix[1]) >= overlap - max(k - level for k in o)
        small, large = (0, 1) if len(x) <= len(y) else (1, 0)
        o = [j.needed_of_larger(len(order[small]), 80), j.needed(len(order[large]), 80)]
        for level in range(1, min(o) + 1):
            short = set(order[small][: len(order[small]) - o[0] + level].tolist())
            long = set(order[large][: len(order[large]) - o[1] + level].tolist())
            assert len(short & long) >= level and len(short & long) >= overlap - max(k - level for k in o)
        o = [j.needed(len(s), 80) for s in (x, y)]
        prefix, level = j.prefix_of(x, j.frequencies(x, *table), 80)
        assert prefix.tolist() == order[0][: len(x) - o[0] + level].tolist()


def test_level_grows_with_frequent_windows():
    windows = np.arange(100, dtype=np.uint64)
    assert j.prefix_of(windows, np.zeros(100, np.int64), 80)[1] == 1
    assert j.prefix_of(windows, np.full(100, 50), 80)[1] > 1
    assert j.prefix_of(windows[:1], np.full(1, 50), 80)[1] == 1


def test_words_and_hashes_over_pieces(monkeypatch):
    import pyarrow as pa

    texts = ["Ab cd", "ab CD ", None, "x" * 5000 + " y", "é\x0bÉ", "a\x1cb"] * 3
    whole = [x.tolist() for x in w.text_words(*text_buffers(pa.array(texts)), True)]
    monkeypatch.setattr(w, "_CHUNK", 7)
    assert [x.tolist() for x in w.text_words(*text_buffers(pa.array(texts)), True)] == whole
    assert whole[0] == whole[1] and [len(x) for x in whole[:6]] == [2, 2, 0, 2, 2, 1]
    assert whole[4][0] != whole[4][1]
    assert len({h for x in whole for h in x}) == 7


@pytest.mark.parametrize("n", [0, 1, 40])
def test_components_of_chains_and_stars(spark, n):
    links = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(n)] + [(7000, 7000)]
    links += [(i + 2, i + 1) for i in range(n)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(n + 2)} | {1000 + i: 1000 for i in range(n)} if n else {}
    if n == 1:
        want = {0: 0, 1: 0, 2: 0}
    assert got == want


def test_sketches_differ_no_more_than_their_sets():
    rnd = np.random.default_rng(8)
    for n in (1, 50, 500, 5000):
        x = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
        for share in (0.5, 0.9, 1.0):
            y = np.unique(np.concatenate([x[rnd.random(len(x)) < share], rnd.integers(0, 1 << 63, 3).astype(np.uint64)]))
            bits = np.unpackbits((j.sketch_of(x) ^ j.sketch_of(y)).view(np.uint8)).sum()
            assert bits <= len(np.setxor1d(x, y))


def test_needed_of_larger():
    for n in range(1, 400):
        for percent in (50, 80, 93, 100):
            least = min(-(-percent * (n + m) // (100 + percent)) for m in range(n, 2 * n + 2))
            assert j.needed_of_larger(n, percent) == least and j.needed(n, percent) <= least


def templates(own, n, seed=6):
    """Texts of one template and words of their own, just below the threshold."""
    rnd = random.Random(seed)
    shared = [f"t{i}" for i in range(150)]
    return [" ".join(shared + [f"w{rnd.randrange(10**9)}" for _ in range(own if isinstance(own, int) else rnd.choice(own))]) for _ in range(n)]


def test_a_template_brings_no_pairs(spark, monkeypatch):
    """22 own words after 150 shared ones: 0.77, so no links; 600 texts would make 180,000 pairs a window."""
    seen = []
    whole = j.matched_pairs
    monkeypatch.setattr(j, "matched_pairs", lambda *x: seen.append(whole(*x)) or seen[-1])
    texts = templates(22, 600)
    got = j.linked_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id for r in got) and len(got) == 600
    assert seen[0].count() == 0 and "CartesianProduct" not in seen[0]._jdf.queryExecution().toString()


def test_templates_of_many_sizes_against_all_pairs(spark):
    rows = list(enumerate(templates(range(8, 40), 150) + templates(range(0, 90, 7), 60, 7)))
    got = j.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows))


def test_only_rows_that_can_meet_stay(spark):
    rnd = random.Random(9)
    rows = [(rnd.randrange(12), c, n, 1, rnd.choice([1, 2]), 1) for c in range(60) for n in [rnd.randint(1, 60)] for _ in range(3)]
    rows += rnd.choices(rows, k=20)
    frame = spark.createDataFrame(rows, "window long, class long, n long, level short, short short, own short")
    got = sorted(tuple(r) for r in j.meeting(frame, 80).collect())

    def pair(x, y):
        """Whether x, the smaller one, meets y."""
        return x[0] == y[0] and (x[2], x[1]) < (y[2], y[1]) and x[4] <= x[5] and 100 * x[2] >= 80 * y[2]

    first = {}
    for r in rows:
        first.setdefault(r[:2], []).append(r)
    kept = {r[:2] for r in got}
    assert len(got) == len(kept) and all(r in first[r[:2]] for r in got)
    sure = {k: v[0] for k, v in first.items() if len(set(v)) == 1}
    for k, x in sure.items():
        if all(y[:2] in sure for y in rows if y[0] == x[0]):
            assert (k in kept) == any(pair(x, y) or pair(y, x) for y in sure.values())


def test_a_class_has_one_name(spark, monkeypatch):
    import pyspark.sql.functions as F

    digests = [j.class_of(np.arange(n, dtype=np.uint64)) for n in range(50)]
    classes = spark.createDataFrame([(bytearray(x),) for x in digests], "class binary")
    for seed in (0, 3):
        got = {bytes(r[0]): r[1] for r in classes.select("class", j.named_by(seed)).collect()}
        assert got == {x: j.name_of(x, seed) for x in digests}
    assert j.seed_of_names(classes) == 0
    real = j.named_by
    monkeypatch.setattr(j, "named_by", lambda seed: F.lit(7).cast("long") if seed < 2 else real(seed))
    assert j.seed_of_names(classes) == 2


def test_sets_are_not_written_and_no_pair_is_verified_twice(spark, monkeypatch):
    purposes, verified, write, verify = [], [], j.written, j.verified
    monkeypatch.setattr(j, "written", lambda df, purpose: purposes.append(purpose) or write(df, purpose))

    def noted(docs, width, classes, pairs, *x):
        verified.append({tuple(r) for r in pairs.collect()})
        return verify(docs, width, classes, pairs, *x)

    monkeypatch.setattr(j, "verified", noted)
    rows = corpus(11)
    got = j.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows))
    assert "windows" not in purposes and len(verified) == 2 and verified[0] and not verified[0] & verified[1]


@pytest.mark.parametrize("many, share", [(1, 2), (2, 10**6), (10**6, 1)])
def test_whatever_is_verified_first(spark, monkeypatch, many, share):
    monkeypatch.setattr(j, "MANY", many)
    monkeypatch.setattr(j, "SHARE", share)
    rnd = random.Random(12)
    base = [f"b{k}" for k in range(120)]
    group = []
    for _ in range(60):  # links within hold or fail, so first components fall apart
        copy = list(base)
        for k in rnd.sample(range(120), rnd.choice([1, 1, 2, 3])):
            copy[k] = f"x{rnd.randrange(10**6)}"
        group.append(" ".join(copy))
    rows = corpus(13) + [(1000 + i, t) for i, t in enumerate(group)]
    got = j.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows))


def test_the_filter_loses_nothing_and_lets_little_through(spark):
    rnd = random.Random(14)
    held, others = ([rnd.randrange(-(1 << 63), 1 << 63) for _ in range(n)] for n in (5000, 5000))
    found = j.hash_filter(spark.createDataFrame([(x,) for x in held], "hash long"), len(held))
    assert all(j.may_hold(*found, x % (1 << 64)) for x in held)
    assert sum(j.may_hold(*found, x % (1 << 64)) for x in others) < 100


def near(x, share, rnd):
    """A set with about ``share`` of x's windows and as many others as are missing."""
    stays = x[rnd.random(len(x)) < share]
    return np.unique(np.concatenate([stays, rnd.integers(0, 1 << 63, len(x) - len(stays)).astype(np.uint64)]))


def test_wide_sketches_differ_no_more_than_their_sets():
    rnd = np.random.default_rng(15)
    assert j.wide_sketch_of(np.arange(j.SKETCH, dtype=np.uint64)) is None
    for n in (520, 1020, 1030, 5000):
        x = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
        for share in (0.3, 0.6, 0.9, 1.0):
            y = np.concatenate([near(x, share, rnd), rnd.integers(0, 1 << 63, n // 10).astype(np.uint64)])
            wide = [np.frombuffer(j.wide_sketch_of(np.unique(s)), np.uint8) for s in (x, y)]
            apart = len(np.setxor1d(x, y))
            assert j.wide_difference(*wide) == j.wide_difference(*wide[::-1]) <= apart
            assert share > 0.3 or j.wide_difference(*wide) > 0.25 * n


def test_large_sets_that_differ_are_not_sent(spark, monkeypatch):
    """All pairs of 14 sets, some of more windows than the fixed sketch can tell apart, before their sets are wanted."""
    rnd = np.random.default_rng(16)
    sets = []
    for n in (300, 1000, 3000):
        base = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
        sets += [base, *(near(base, share, rnd) for share in (0.97, 0.95, 0.6, 0.5))]
    wide = [j.wide_sketch_of(s) for s in sets]
    classes = spark.createDataFrame([(i, len(s), w and bytearray(w)) for i, (s, w) in enumerate(zip(sets, wide))], "class long, n long, wide binary")
    pairs = {(a, b) for b in range(len(sets)) for a in range(b)}
    got = {tuple(r) for r in j.likely(spark.createDataFrame(sorted(pairs), "a long, b long"), classes, 80).collect()}
    for a, b in pairs:
        common = len(np.intersect1d(sets[a], sets[b]))
        linked = 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common)
        assert (a, b) in got if linked or wide[a] is None or wide[b] is None else (a, b) not in got


def test_only_likely_pairs_of_long_texts_are_verified(spark, monkeypatch):
    """Long texts that share 60 % of their words in one run are neighbours, but no two of them are linked."""
    asked, verify = [], j.verified

    def noted(docs, width, classes, pairs, *x):
        asked.append(pairs.count())
        return verify(docs, width, classes, pairs, *x)

    monkeypatch.setattr(j, "verified", noted)
    shared = [f"s{i}" for i in range(1500)]
    rows = [(i, " ".join(shared + [f"w{i}x{k}" for k in range(800)])) for i in range(6)]
    copy = rows[0][1].split()
    copy[7] = "other"
    rows.append((6, " ".join(copy)))
    monkeypatch.setattr(j.frequent_windows, "__defaults__", (0,))
    got = j.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows)) and sum(asked) == 1


def test_sizes_and_levels_survive_the_shuffle(spark):
    most = j.MOST_LEVEL
    rows = [(1, c, n, j.LEVELS, short, j.LEVELS) for c, n, short in ((5, 10**9, 1), (6, 10**9 + 7, most), (7, 10**9, j.LEVELS))]
    frame = spark.createDataFrame(rows, "window long, class long, n long, level short, short short, own short")
    assert sorted(map(tuple, j.meeting(frame, 80).collect())) == sorted(rows)
    assert j.meeting(frame, 80).dtypes == frame.dtypes and most < 1 << j.LEVEL_BITS


def test_written_rows_leave_no_shuffle_behind(spark):
    from tallyloom.llm.tables import CLEANUP_SETTING

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {str(x) for x in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    before, setting = held(), spark.conf.get(CLEANUP_SETTING, "false")
    j.written(spark.range(10_000).repartition(7), "some")
    for _ in range(50):
        if not held() - before:
            break
        time.sleep(0.1)
    assert not held() - before and spark.conf.get(CLEANUP_SETTING, "false") == setting
