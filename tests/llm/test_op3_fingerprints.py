import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import fingerprints as f
from tallyloom.llm.queries import QUERIES

MASK = (1 << 64) - 1


def chained(*longs, kind="<q"):
    seed = 42
    for x in longs:
        seed = xxhash.xxh64_intdigest(struct.pack(kind, x), seed=seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_minima(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashed = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in words]
    if 0 < len(words) < f.WIDTH:
        found = {chained(*hashed)}
    else:
        found = {chained(*hashed[i : i + f.WIDTH]) for i in range(len(words) - f.WIDTH + 1)}
    minima = {}
    for x in sorted(x >> 1 for x in found):
        minima.setdefault(x >> 63 - f.BINS_LOG2, x)
    return minima


def brute_values(text):
    minima, values = brute_minima(text), []
    for j in range(f.BINS):
        probes = [j]
        for t in range(f.PROBES):
            h = xxhash.xxh64_intdigest(struct.pack("<i", t), seed=xxhash.xxh64_intdigest(struct.pack("<i", j), seed=42))
            probes.append(signed(h) % f.BINS)
        hit = next((p for p in probes if p in minima), None)
        if hit is None:
            turn = lambda p: signed(
                xxhash.xxh64_intdigest(struct.pack("<i", j), seed=xxhash.xxh64_intdigest(struct.pack("<i", p), seed=42))
            )
            hit = min(minima, key=turn)
        values.append(minima[hit] & f.LOW_BITS)
    return values


def brute_fingerprint(text):
    return "".join(f"{v:x}" for v in brute_values(text)) if brute_minima(text) else ""


def brute_likeness(a, b):
    if not a or not b:
        return float(a == b)
    same = sum(x == y for x, y in zip(a, b)) / f.BINS
    return max(0.0, (same - 1 / 16) / (1 - 1 / 16))


def sample():
    rnd = random.Random(11)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randrange(400))
    texts = [" ".join(word() for _ in range(n)) for n in (1, 4, 5, 6, 12, 40, 300, 2500)]
    return [None, "", " \n", "é\tü", *texts, texts[-1], texts[-1].replace("a", "z", 40), texts[-2] + " end"]


@pytest.fixture(scope="module")
def result(spark, documents, as_tables):
    docs = documents(*sample(), extra="fingerprint string, bucket string, edited string, next_text string")
    return {r.doc_id: r for r in QUERIES["op3_document_fingerprints"](spark, as_tables(documents=docs)).collect()}


def test_against_brute_force(result):
    texts = [x or "" for x in sample()]
    assert len(result) == len(texts)
    for i, text in enumerate(texts):
        after = texts[i - 1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = result[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == brute_fingerprint(text)
        assert row.edited_fingerprint == brute_fingerprint(edited)
        assert row.near_edited == pytest.approx(brute_likeness(row.fingerprint, row.edited_fingerprint), abs=1e-12)
        assert row.near_next == pytest.approx(brute_likeness(row.fingerprint, brute_fingerprint(after)), abs=1e-12)


def test_likeness_estimates_jaccard(spark):
    rnd = random.Random(4)
    rows = []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95, 1.0):
        for _ in range(8):
            words = [f"w{rnd.randrange(10**9)}" for _ in range(1000)]
            kept = int(1000 * share)
            rows.append((share, " ".join(words), " ".join(words[:kept] + [f"x{rnd.randrange(10**9)}" for _ in range(1000 - kept)])))
    df = spark.createDataFrame(rows, "share double, a string, b string")
    df = df.select("share", f.likeness(f.packed(F.col("a")), f.packed(F.col("b"))).alias("near"))
    for r in df.groupBy("share").agg(F.avg("near").alias("near")).collect():
        assert r.near == pytest.approx(r.share / (2 - r.share), abs=0.04)


def test_next_row_over_many_ranges_with_ties_and_nulls(spark, documents):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, *range(60), 10**12]), f"t{rnd.randrange(30)}", "s") for _ in range(300)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted((str(a[0]), a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    for buckets in (1, 2, 7, 50):
        out = f.with_following(documents(*rows), "doc_id", "text", {"text": "next_text"}, buckets)
        assert sorted((str(r.doc_id), r.text, r.next_text) for r in out.collect()) == want
    one = f.with_following(documents((None, "only", "s")), "doc_id", "text", {"text": "next_text"}, 4).collect()
    assert [(r.text, r.next_text) for r in one] == [("only", "only")]


def test_no_rows(spark, documents, as_tables):
    empty = as_tables(documents=documents("a").where("false"))
    assert QUERIES["op3_document_fingerprints"](spark, empty).count() == 0


def test_plan_is_native_and_moves_texts_once(spark, documents, as_tables):
    plan = QUERIES["op3_document_fingerprints"](spark, as_tables(documents=documents("a b", "c d")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
