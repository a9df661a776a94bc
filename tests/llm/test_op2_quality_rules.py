import random
import re
from collections import Counter

import pyarrow as pa
from compare import connect, differences
from pyspark.sql import functions as F

from tallyloom.llm import quality_rules as q
from tallyloom.llm.oracle import ORACLES
from tallyloom.llm.queries import QUERIES

PLAIN = " ".join(f"word{i}" for i in range(60))


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    eights = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(eights), set()
    for i, eight in enumerate(eights):
        if times[eight] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_against_brute_force():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["a ", "b ", "é\n", "\x85", " ", "|", "a b a b a b a b a\n"]) for _ in range(rnd.randint(0, 90))) for _ in range(300)]
    texts += [None, "", " \n\t", "one", "x" * 3_000_000, "a b\n" * 50_000]
    got = [tuple(r[c] for c in q.COUNTS) for r in q.text_counts(pa.array(texts)).to_pylist()]
    assert got == [brute(x) for x in texts]


def test_bad_host_is_rejected_and_small_ones_are_shrunk(spark, documents):
    rows = [(PLAIN, f"host{h}") for h in range(8) for _ in range(40)]
    rows += [("junk", "bad")] * 36 + [(PLAIN, "bad")] * 4
    rows += [("junk", "tiny")] + [(PLAIN, None)] * 3
    counted = q.with_counts(documents(*rows), "text", "counts")
    rates = {r.host: r for r in q.host_rates(counted, "source", "counts").collect()}
    assert rates["bad"].rejected and rates["bad"].short_rate < 36 / 40
    assert 0 < rates["tiny"].short_rate < 1 and not rates["host0"].rejected
    judged = q.quality_verdicts(counted, "source", "counts", "kept")
    kept = {r.source: r.n for r in judged.where("kept").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert kept == {**{f"host{h}": 40 for h in range(8)}, None: 3}


def test_host_that_only_repeats_lines_is_rejected(spark, documents, as_tables):
    """Short lines, each repeated in other surroundings, so that no eight words repeat."""
    order = [0, 1, 2, 3, 0, 2, 1, 3, 2, 0, 3, 1]
    lines = lambda d: "\n".join(f"line{d} number{i} of four" for i in order)
    rows = [(PLAIN, f"host{h}") for h in range(8) for _ in range(40)] + [(lines(d), "lines") for d in range(40)]
    counted = q.with_counts(documents(*rows), "text", "counts")
    assert counted.where("source = 'lines'").select("counts.n_dup_lines", "counts.n_lines").distinct().collect() == [(8, 12)]
    assert counted.where(q.base_failed(F.col("counts"))).count() == 0
    rates = {r.host: r for r in q.host_rates(counted, "source", "counts").collect()}
    assert rates["lines"].rejected and rates["lines"].lines_rate > 0.9 and not rates["host0"].rejected
    folder = as_tables(documents=documents(*rows))
    query = QUERIES["op2_quality_rules"](spark, folder)
    assert query.where("kept").count() == 320
    with connect(folder, ["documents"]) as con:
        assert differences(query, con, ORACLES["op2_quality_rules"]) == ""


def test_equal_hosts_share_the_overall_rate(spark, documents):
    counted = q.with_counts(documents(*[(x, h) for h in "abc" for x in ["junk", PLAIN, PLAIN]]), "text", "counts")
    assert {round(r.short_rate, 12) for r in q.host_rates(counted, "source", "counts").collect()} == {round(1 / 3, 12)}


def test_query_edges(spark, documents, as_tables):
    docs = documents(None, "", PLAIN, PLAIN, (None, PLAIN, None), extra="kept string, counts string, host string, n_words string")
    rows = QUERIES["op2_quality_rules"](spark, as_tables(documents=docs)).collect()
    assert sorted((r.n_words, r.base_failed, r.kept) for r in rows) == [(0, True, False)] * 2 + [(60, False, True)] * 3
    assert QUERIES["op2_quality_rules"](spark, as_tables(documents=docs.where("false"))).count() == 0
    kept = q.quality_verdicts(q.with_counts(docs, "text", "counts_"), "source", "counts_", "kept_")
    assert kept.columns[: len(docs.columns)] == docs.columns and kept.count() == 5
