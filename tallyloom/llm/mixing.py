"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in shuffled order, up to ``repeats`` times over. A copy's virtual finish
time is the source's words up to its end divided by the source's target. All copies of all sources are
ordered by finish time and taken until the budget, the words of the whole corpus, is spent; the copy at
the end is taken in part. So every source is served in proportion to its target, to within a document.

A source's target is its weight's share of the budget, at most ``repeats`` times its own words; what a
source can't use is shared again by weight among the others.

The order of a source is cut into pieces by the shuffling hash, as many as its rows ask for; running sums go
over pieces first and then within each piece, so a source of any size spreads over many tasks. The global
order is cut into ranges of finish time, and the range in which the budget ends is cut again until it holds
at most ``RANGE_ROWS`` copies (or copies of one finish time, at most one per source); only these are ordered
row by row. The bounds of a range and the end itself pass through the driver. A single task sees one row per
source, or per (source, piece) of a source.

- Null source: a source of its own, ordered last. Documents of size 0 (null or empty texts) take no words.
- Equal rows are interchangeable and are served one after the other; reruns agree.
- No documents: no rows. All columns of the input are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import SPACES, piece_digits, written

WEIGHTS, REPEATS = (5, 2, 1), 3
#: Ranges into which finish times are cut at once; copies that one task puts in order.
RANGES, RANGE_ROWS = 4096, 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """From (named, name, source_size), a row per source: also ``turn`` (its place) and ``target``.

    In the order of limit / weight, sources are held to their limit as long as an equal share by weight of
    what the ones before left would exceed it; the others share the rest.
    """
    order = Window.orderBy(F.col("named").desc(), "name")
    exact = "decimal(38,0)"
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = sizes.withColumn("turn", F.row_number().over(order)).withColumn("weight", weight.cast("long"))
    sources = sources.withColumn("limit", repeats * F.col("source_size"))
    everything = Window.partitionBy()
    rising = Window.orderBy((F.col("limit") / F.col("weight")), "turn").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(rising), F.lit(0))
    rest_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0))
    sources = sources.withColumn("rest", rest).withColumn("rest_weight", rest_weight)
    held = F.col("limit").cast(exact) * F.col("rest_weight").cast(exact) < F.col("rest").cast(exact) * F.col("weight").cast(exact)
    sources = sources.withColumn("held", held)
    final = F.min(F.when(~F.col("held"), F.struct(F.col("limit") / F.col("weight"), "turn", "rest", "rest_weight"))).over(everything)
    sources = sources.withColumn("final", final)
    shared = F.col("weight").cast("double") * F.col("final.rest").cast("double") / F.col("final.rest_weight").cast("double")
    target = F.when(F.col("held"), F.col("limit").cast("double")).otherwise(shared)
    return sources.select("named", "name", "source_size", "turn", target.alias("target"))


def cut_range(copies: DataFrame, budget: int) -> tuple[DataFrame, int] | None:
    """The few copies among which the budget ends, and the words that it leaves for them."""
    finish = F.col("copy.finish")
    within, left = copies, budget
    place = F.floor(RANGES * finish / (1 + finish))
    while True:
        ranges = within.groupBy(place.alias("range")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.min(finish).alias("low"), F.max(finish).alias("high")
        )
        ranges = ranges.withColumn("until", F.sum("words").over(Window.orderBy("range")))
        last = ranges.where(F.col("until") >= left).orderBy("range").first()
        if last is None:
            return None
        left -= last["until"] - last["words"]
        low, high = last["low"], last["high"]
        within = copies.where((finish >= low) & (finish <= high))
        if last["n"] <= RANGE_ROWS or low == high:
            return within, left
        place = F.floor(RANGES * ((finish - low) / (high - low)))


def mix(
    df: DataFrame,
    source_column: str,
    size: Column,
    shuffle_by: list[Column],
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
) -> DataFrame:
    """All rows and columns as the struct ``row``, and ``size``, ``source_size``, ``target``, ``taken``."""
    parts = [F.coalesce(x.cast("string"), F.lit("null")) for x in shuffle_by]
    rows = df.select(
        F.struct(*[F.col(c) for c in df.columns]).alias("row"),
        F.col(source_column).isNotNull().alias("named"),
        F.coalesce(F.col(source_column), F.lit("")).alias("name"),
        size.alias("size"),
        F.md5(F.concat_ws("/", *parts)).alias("place"),
    )
    narrow = written(rows.drop("row"), "mix-sizes")
    largest = narrow.groupBy("named", "name").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    piece = F.substring("place", 1, piece_digits(largest))
    rows, narrow = rows.withColumn("piece", piece), narrow.withColumn("piece", piece)

    pieces = narrow.groupBy("named", "name", "piece").agg(F.sum("size").alias("piece_size"))
    earlier = Window.partitionBy("named", "name").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(pieces.groupBy("named", "name").agg(F.sum("piece_size").alias("source_size")), weights, repeats)
    starts = pieces.withColumn("before", F.coalesce(F.sum("piece_size").over(earlier), F.lit(0))).drop("piece_size")
    starts = written(starts.join(targets, ["named", "name"]), "mix-targets")

    def placed(rows: DataFrame) -> DataFrame:
        """Rows with the ``until`` (words of the source up to and with this one) of each copy."""
        so_far = Window.partitionBy("named", "name", "piece").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, 0)
        out = rows.join(starts, ["named", "name", "piece"]).withColumn("until", F.col("before") + F.sum("size").over(so_far))
        turns = F.array(*[F.col("until") + F.lit(e) * F.col("source_size") for e in range(repeats)])
        copies = F.transform(
            turns,
            lambda u: F.struct(
                (u.cast("double") / F.col("target")).alias("finish"), F.col("turn").alias("turn"), u.alias("until")
            ),
        )
        none = F.array().cast("array<struct<finish:double,turn:int,until:long>>")
        return out.withColumn("copies", F.when((F.col("size") > 0) & (F.col("target") > 0), copies).otherwise(none))

    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    copies = written(placed(narrow).select("size", F.explode("copies").alias("copy")), "mix-copies")
    taken = F.lit(0).cast("long")
    if budget and (last := cut_range(copies, budget)):
        within, left = last
        running = F.sum("size").over(Window.orderBy("copy").rowsBetween(Window.unboundedPreceding, 0))
        end = within.withColumn("running", running).where(F.col("running") >= left).orderBy("running").first()
        finish, turn, until = end["copy"]
        cut = F.struct(F.lit(finish).alias("finish"), F.lit(turn).alias("turn"), F.lit(until).cast("long").alias("until"))
        partly = F.lit(left - (end["running"] - end["size"])).cast("long")
        taken = F.aggregate(
            "copies",
            F.lit(0).cast("long"),
            lambda acc, c: acc + F.when(c < cut, F.col("size")).when(c == cut, partly).otherwise(F.lit(0)),
        )
    return placed(rows).select("row", "size", "source_size", "target", taken.alias("taken"))
