import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from tallyloom.llm import hash_tree as h
from tallyloom.llm import tables
from tallyloom.llm.queries import QUERIES


def brute(key, tree):
    def draw(name, weight):
        u = (int(hashlib.md5(f"{key}/{name}".encode()).hexdigest()[: h.DRAW_DIGITS], 16) + 0.5) / 16**h.DRAW_DIGITS
        return -math.log(u) / weight

    weight = lambda node: node[1] if isinstance(node[0], int) else sum(map(weight, node))
    r = min((draw(f"{i}", weight(x)), i) for i, x in enumerate(tree) if weight(x))[1]
    k = min((draw(f"{r}.{i}", weight(x)), i) for i, x in enumerate(tree[r]) if weight(x))[1]
    return min((draw(f"{r}.{k}.{s}", w), s) for s, w in tree[r][k] if w)[1]


def placed(spark, n, tree):
    return {r.id: r.shard for r in h.with_shard(spark.range(n), "id", tree, "shard").collect()}


def test_against_brute_force(spark):
    tree = ((((0, 1), (1, 3)), ((2, 0), (3, 2))), (((4, 5),),), (((5, 0),),))
    assert placed(spark, 400, tree) == {i: brute(i, tree) for i in range(400)}


def test_shares_follow_weights(spark):
    tree = ((((0, 1), (1, 3)), ((2, 4),)), (((3, 8),),))
    counts = Counter(placed(spark, 16_000, tree).values())
    assert all(abs(counts[s] / 1000 - w) < 0.25 for s, w in ((0, 1), (1, 3), (2, 4), (3, 8)))


def test_growing_moves_rows_to_the_new_shard_alone(spark):
    tree = h.even_tree(40)
    before, after = placed(spark, 4000, tree), placed(spark, 4000, h.grown(tree))
    moved = {i for i in before if before[i] != after[i]}
    assert {after[i] for i in moved} == {40} and 60 < len(moved) < 140


def test_a_changed_weight_moves_rows_only_into_or_out_of_its_subtrees(spark):
    tree = h.even_tree(16)
    heavier = (tree[0], (tree[1][0], ((12, 1), (13, 1), (14, 5), (15, 1))))
    before, after = placed(spark, 3000, tree), placed(spark, 3000, heavier)
    region, rack = (lambda s: s // 8), (lambda s: s // 4)
    for i in before:
        if region(before[i]) != region(after[i]):
            assert region(after[i]) == 1
        elif region(before[i]) == 0:
            assert before[i] == after[i]
        elif rack(before[i]) != rack(after[i]):
            assert rack(after[i]) == 3
        elif rack(before[i]) == 2:
            assert before[i] == after[i]


def test_query_edges(spark, documents, as_tables):
    docs = documents(None, "", "é", "same", (3, "same", "s"), (3, "same", "s"), (None, "x", None), *["a"] * 200, extra="shard string, slot string, size string, region string, piece string")
    df = QUERIES["op4_sharding"](spark, as_tables(documents=docs))
    rows = df.collect()
    sizes = {r.doc_id: r["size"] for r in rows}
    assert len(rows) == 207 and sizes[0] == sizes[1] == 16 and sizes[2] == 18
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if r.doc_id == 3}) == 1
    assert all(r.grown_shard in (r.shard, 40) for r in rows)
    assert QUERIES["op4_sharding"](spark, as_tables(documents=docs.where("false"))).count() == 0


def test_numbers_of_equal_rows_have_no_gaps(spark):
    df = spark.range(500).select(F.lit(1).alias("shard"), F.lit(None).cast("long").alias("key"), F.lit("x").alias("n"))
    assert sorted(r.slot for r in h.with_slot(df, "shard", ["key"], "slot").collect()) == list(range(500))


def test_more_pieces_for_larger_shards(spark, monkeypatch):
    monkeypatch.setattr(tables, "PIECE_ROWS", 1)
    df = spark.range(600).select((F.col("id") % 2).alias("shard"), "id")
    got = h.with_slot(df, "shard", ["id"], "slot").collect()
    for shard in (0, 1):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(300))
        own = sorted((hashlib.md5(str(r.id).encode()).hexdigest()[:3], r.id, r.slot) for r in got if r.shard == shard)
        assert [x[2] for x in own] == list(range(300))
