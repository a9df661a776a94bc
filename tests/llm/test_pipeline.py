import hashlib
import random
from collections import Counter

import pytest
from test_op8_jaccard_join import brute, corpus, ordered
from test_op10_byte_bpe import LIBRARY

import corpus_pipeline as pipeline
from tallyloom.llm import jaccard_join as j
from tallyloom.llm import secret_scan as s
from tallyloom.llm.tables import written


def prose(seed, n=40):
    rnd = random.Random(seed)
    return " ".join(f"word{rnd.randrange(10_000)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(documents):
    near = prose(1).split()
    rows = [
        (0, prose(1), "a"),
        (1, " ".join(near[:-1] + ["changed"]), "a"),
        (2, prose(1), "b"),
        (3, prose(2) + " password=hunter2hunter2", "b"),
        (3, prose(2) + " password=hunter2hunter2", "b"),
        (4, "too short", "b"),
        (5, "again and again " * 30, "a"),
        (6, None, None),
        (None, prose(3), None),
        *[(10 + i, prose(100 + i), "abc"[i % 3]) for i in range(40)],
    ]
    return documents(*rows, extra="taken string, size string, row string, kept string, counts string, piece string")


def test_stages_in_order():
    assert len(pipeline.STAGES) == 5 and [f for _, f in pipeline.STAGES] == [
        pipeline.quality, pipeline.near_duplicates, pipeline.secrets, pipeline.mixture, pipeline.tokens,
    ]


def test_each_stage_takes_effect_and_keeps_the_columns(spark, docs):
    kept = written(pipeline.quality(spark, docs, ""), "q")
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in (4, 5, 6))
    single = written(pipeline.near_duplicates(spark, kept, ""), "d")
    assert single.columns == docs.columns
    assert sorted(str(r.doc_id) for r in single.collect()) == sorted(["0", "3", "None", *[str(10 + i) for i in range(40)]])
    clean = written(pipeline.secrets(spark, single, ""), "s")
    texts = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == docs.columns and texts[3].text == prose(2) + " [secret]" and texts[3].n_chars == len(texts[3].text)
    mixed = written(pipeline.mixture(spark, clean, ""), "m")
    counts = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and max(counts.values()) <= 3 and set(counts) <= set(texts)
    assert counts[10] >= counts[12]
    out = pipeline.tokens(spark, mixed, "").collect()
    assert Counter(r.doc_id for r in out) == counts
    for r in out:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id].text)
        assert r.token_ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].text.encode()).hexdigest()


def test_run_against_its_stages_done_plainly(spark, as_tables, documents):
    """Without mixing's choice: every document that the first three stages leave may be taken, no other."""
    rows = [(i, t, "s") for i, t in corpus(7)]
    long = [(i, f"{t} {prose(i or 999, 25)}" if t else t, s) for i, t, s in rows]
    out = pipeline.run(spark, as_tables(documents=documents(*long))).collect()
    passing = [(i, t) for i, t, _ in long if t and len(t.split()) >= 20]
    want = {(i, hashlib.sha256(s.redacted(t, s.base_spans(t), "[secret]").encode()).hexdigest()) for i, t in passing}
    got = {(r.doc_id, r.decoded_sha256) for r in out}
    groups = {c for _, _, c in brute(passing)}
    assert got <= want and len(got) == len(out)  # one source: each document once
    assert len(got) >= len(groups) - 1


@pytest.mark.parametrize("texts", [[], [None, ""], ["short"]])
def test_run_on_tables_that_leave_nothing(spark, documents, as_tables, texts):
    folder = as_tables(documents=documents(*texts) if texts else documents("x").where("false"))
    assert pipeline.run(spark, folder).count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_one_row_stays_of_each_group(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row_key string")
    got = [tuple(r) for r in j.one_of_each_group(df).collect()]
    # Rows under one id are told apart by a number of their own.
    numbered = brute([(k, t) for k, (_, t) in enumerate(rows)])
    members = {}
    for k, n, c in numbered:
        members.setdefault(c if n else ("alone", k), []).append(k)
    assert len(got) == len(members)
    by_text = Counter(t for _, t, _ in got)
    for group in members.values():
        names = [rows[k][0] for k in group]
        least = min((x for x in names if x is not None), default=None)
        assert any(i == least and t in {rows[k][1] for k in group} for i, t, _ in got)
    assert sum(by_text.values()) == len(got) and ordered([(i,) for i, _, _ in got])
