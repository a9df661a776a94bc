"""Links between documents whose sets of word windows overlap, by adaptive multi-match prefixes.

A document's set holds its distinct five-word windows, as 64-bit hashes. Two documents link when their
sets' Jaccard similarity reaches the threshold; the result gives each document its component of links.

1. Equal sets become one class (128-bit hash), so exact copies are handled once. Rows carry a class's name, a
   64-bit hash of that one, under a seed for which no two classes share a name.
2. Windows have one order: the most frequent ones last. Frequencies are counted over all documents; the
   table of the ``ORDERED`` most frequent ones has a fixed size and is broadcast. Any order gives right
   results, this one gives few candidates.
3. Two linked classes have a common o = ceil(t / (1 + t) * (n + m)) of their n and m windows, t being the
   threshold. So of a class of n at least ceil(t * n) are common with any partner, and at least
   ceil(2t / (1 + t) * n) with one that is no smaller. Its long prefix at level l is its first
   n - ceil(t * n) + l windows, its short one the first n - ceil(2t / (1 + t) * n) + l; the short prefix of
   the smaller class and the long one of the larger share at least l windows, for any l. Each class picks
   the level with the lowest estimated cost: frequent windows in the short prefix mean many candidates, a
   longer prefix demands more matches. A pair must match min(l, l') times. Texts that share a template but
   not enough for a link keep it out of their short prefixes, so the template brings no pairs.
4. Windows in one class's prefix only lead nowhere, as do a window's rows without a partner of like size.
5. Links are first looked for between neighbours: each class stands in the groups of a few of its matched
   prefix windows, picked by hash, in a random order, and meets the next ones there. Links that hold give
   first components. Pairs inside one component need no look any more, so a group of
   thousands of near copies costs a few chains, not all its pairs.
6. Pairs from different components with enough matches for their sizes, and sketches that leave room for
   the overlap, are verified on the whole sets, unless step 5 did so; their links join the components.

Sketches have two sizes: a fixed one, which rows carry into joins, and for larger sets one that grows with
the set, to which the pairs go before the sets themselves are sent.

No step keeps fewer rows than the definition asks; steps 2 and 5 only save work.

- Null text or one without words: empty set, linked with nothing, a component of its own.
- Fewer words than the width: the whole sequence is the one window.
- Null id: linked like others; a component without any id has a null ``component_id``.
- Repeated rows, and rows that share an id, each count as a document. No rows: no rows.
- Only the named columns are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.tables import arrow_rows, free_shuffles, map_arrow, text_buffers, unused, written
from tallyloom.llm.words import shingle_set, text_words

WIDTH, PERCENT = 5, 80
#: Entries of the frequency table; windows counted together in a task; levels; bits and slots of the class filter.
ORDERED, COUNTED, LEVELS, MOST_BITS, MOST_SLOTS = 1 << 20, 1 << 22, 6, 1 << 27, 4
#: How many window matches a verification costs.
VERIFY_COST = 8
#: Prefix windows in whose groups a class looks for neighbours, neighbours looked at; bits of a class's sketch.
PICKS, NEIGHBOURS, SKETCH = 6, 3, 512
#: What orders windows for each pick, fixed.
ORDERS = [int(x) for x in np.random.default_rng(41).integers(-(1 << 63), 1 << 63, PICKS)]
#: A class with so many smaller neighbours is verified first with one of ``SHARE`` of them, else with one alone.
MANY, SHARE = 8, 3
#: Classes of a group that stand in one order.
PIECE = 256
#: Stands for all levels that no class picks. Bits of a level where several numbers are packed into one.
MOST_LEVEL, LEVEL_BITS = LEVELS + 1, 6
#: Bits of a wide sketch at most.
WIDEST = 1 << 20
#: Classes that a task remembers having emitted.
REMEMBERED = 1 << 18


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Windows that a linked class has in common at least."""
    return (percent * n + 99) // 100


def needed_of_larger(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Windows that a class has in common at least with a linked one that is no smaller."""
    return (2 * percent * n + 99 + percent) // (100 + percent)


def sets_of(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    data, at = text_buffers(texts)
    for words in text_words(data, at, fold_case=True):
        yield shingle_set(words, width)


def class_of(windows: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(windows.tobytes())


def name_of(digest: bytes, seed: int) -> int:
    """A class's name of 64 bits; ``named_by`` gives the same in Spark."""
    name = xxhash.xxh64_intdigest(digest, seed=xxhash.xxh64_intdigest(struct.pack("<q", seed), seed=42))
    return name - (1 << 64) if name >> 63 else name


def named_by(seed: int) -> Column:
    return F.when(F.col("class").isNotNull(), F.xxhash64(F.lit(seed).cast("long"), "class"))


def seed_of_names(classes: DataFrame) -> int:
    """The first seed under which all classes of a written table, by their 128-bit hashes, have names of their own."""
    seed = 0
    while classes.groupBy(named_by(seed).alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count():
        seed += 1
    return seed


def sketch_of(windows: np.ndarray) -> np.ndarray:
    """For each of ``SKETCH`` parts of all windows whether an odd number of the set's is in it.

    A window that only one of two sets has changes one bit, so the sketches of two sets differ in no more
    bits than the sets differ in windows.
    """
    parts = (windows >> np.uint64(40)).astype(np.int64) % SKETCH
    return np.packbits(np.bincount(parts, minlength=SKETCH) & 1, bitorder="little").view(np.int64)


def wide_sketch_of(windows: np.ndarray) -> bytes | None:
    """The like of a set of more than ``SKETCH`` windows, in a power of two of parts, as many as the set has windows."""
    if len(windows) <= SKETCH:
        return None
    bits = min(WIDEST, 1 << (len(windows) - 1).bit_length())
    parts = (windows >> np.uint64(20)).astype(np.int64) % bits
    return np.packbits(np.bincount(parts, minlength=bits) & 1, bitorder="little").tobytes()


def wide_difference(x: np.ndarray, y: np.ndarray) -> int:
    """In how many bits two wide sketches, as bytes, differ: no more than the sets in windows.

    The parts of the one with fewer are unions of those of the other.
    """
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def described(docs: DataFrame, width: int) -> DataFrame:
    """Per row: its columns except ``text``, and n, class, sketch, wide."""
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, classes, sketches, wide = [], [], [], []
        for windows in sets_of(batch.column(at), width):
            some = len(windows) > 0
            n.append(len(windows))
            classes.append(class_of(windows) if some else None)
            sketches.append(sketch_of(windows) if some else [])
            wide.append(wide_sketch_of(windows))
        longs = pa.list_(pa.int64())
        found = [pa.array(n, pa.int64()), pa.array(classes, pa.binary()), pa.array(sketches, longs), pa.array(wide, pa.binary())]
        keys = [(name, column) for name, column in zip(batch.schema.names, batch.columns) if name != "text"]
        names = [x for x, _ in keys] + ["n", "class", "sketch", "wide"]
        return pa.RecordBatch.from_arrays([c for _, c in keys] + found, names)

    keys = [f"{name} {kind}" for name, kind in docs.dtypes if name != "text"]
    return map_arrow(docs, work, ", ".join([*keys, "n long, class binary, sketch array<long>, wide binary"]))


def frequent_windows(docs: DataFrame, width: int, entries: int = ORDERED) -> tuple[np.ndarray, np.ndarray]:
    """The windows of most documents, sorted, and their counts.

    A task sums up ``COUNTED`` windows at a time and passes on those that it saw twice, so what is shuffled
    are repetitions only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def summed() -> pa.RecordBatch:
            windows, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(windows[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], ["window", "n"]
            )

        for batch in batches:
            for windows in sets_of(batch.column(0), width):
                held.append(windows)
                size += len(windows)
                if size >= COUNTED:
                    yield summed()
                    held, size = [], 0
        if held:
            yield summed()

    counts = arrow_rows(docs.select("text"), run, "window long, n long").groupBy("window").agg(F.sum("n").alias("n"))
    counts = written(counts, "window-counts")
    sizes = counts.groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count(F.lit(1)).alias("windows"))
    least, total = 10_001, 0
    for row in sorted(sizes.collect(), reverse=True):
        if total + row["windows"] > entries:
            break
        least, total = row["n"], total + row["windows"]
    chosen = counts.where(F.col("n") >= least).toArrow()
    windows = chosen["window"].to_numpy().view(np.uint64)
    order = np.argsort(windows)
    return windows[order], chosen["n"].to_numpy()[order]


def frequencies(windows: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each window occurs, by the table; 0 if it isn't there."""
    if not len(known):
        return np.zeros(len(windows), np.int64)
    at = np.minimum(np.searchsorted(known, windows), len(known) - 1)
    return np.where(known[at] == windows, counts[at], 0)


def prefix_of(windows: np.ndarray, often: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The set's long prefix in the common order (rare windows first, then by hash) at its best level, and the level.

    A level's cost is that of its short prefix's matches and of the verifications that they may lead to.
    """
    n = len(windows)
    least, of_larger = int(needed(n, percent)), int(needed_of_larger(n, percent))
    if not often.any():
        return windows[: n - least + 1], 1
    order = np.argsort(often, kind="stable")
    matches = np.cumsum(often[order])[n - of_larger : n - of_larger + min(LEVELS, least)]
    level = int(np.argmin(matches * (1 + VERIFY_COST / np.arange(1, len(matches) + 1)))) + 1
    return windows[order[: n - least + level]], level


class Seen:
    """Remembers the last few classes of a task, so that copies aren't emitted time and again."""

    def __init__(self) -> None:
        self.new: set[bytes] = set()
        self.old: set[bytes] = set()

    def add(self, name: bytes) -> bool:
        """Whether the class is new."""
        if name in self.new or name in self.old:
            return False
        if len(self.new) >= REMEMBERED:
            self.old, self.new = self.new, set()
        self.new.add(name)
        return True


def prefixes(docs: DataFrame, width: int, percent: int, table: tuple[np.ndarray, np.ndarray], seed: int) -> DataFrame:
    """Rows (window, class, n, level, short, own): the windows of each class's long prefix at its level ``own``.

    ``level`` is the first level whose long prefix has the window, ``short`` the first one of its short prefix.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sets, names, size = Seen(), [], [], 0
        for batch in batches:
            for windows in sets_of(batch.column(0), width):
                if not len(windows) or not seen.add(digest := class_of(windows)):
                    continue
                sets.append(windows)
                names.append(name_of(digest, seed))
                size += len(windows)
                if size >= COUNTED // 4:
                    yield rows(sets, names)
                    sets, names, size = [], [], 0
        if sets:
            yield rows(sets, names)

    def rows(sets: list[np.ndarray], names: list[int]) -> pa.RecordBatch:
        ends = np.cumsum([len(x) for x in sets])
        often = np.split(frequencies(np.concatenate(sets), *shared.value), ends[:-1])
        found, levels = zip(*[prefix_of(x, o, percent) for x, o in zip(sets, often)])
        sizes, own = np.array([len(x) for x in found]), np.array(levels)
        n = np.array([len(x) for x in sets], np.int64)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        level = np.maximum(1, place - np.repeat(sizes - own + 1, sizes) + 2)
        short = np.maximum(1, place - np.repeat(n - needed_of_larger(n, percent) + 1, sizes) + 2)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(found).view(np.int64)),
                pa.array(np.repeat(np.array(names, np.int64), sizes)),
                pa.array(np.repeat(n, sizes)),
                pa.array(level.astype(np.int16)),
                pa.array(np.minimum(short, MOST_LEVEL).astype(np.int16)),
                pa.array(np.repeat(own.astype(np.int16), sizes)),
            ],
            ["window", "class", "n", "level", "short", "own"],
        )

    return arrow_rows(docs.select("text"), run, "window long, class long, n long, level short, short short, own short")


def meeting(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (window, class, n, level, short, own), each once, that can be part of a pair.

    A pair is a row of a short prefix and a later one by (n, class) in the same window's group, of like size. If
    a row has any such partner, then also the next one after it, or the last short one before it.

    All prefix rows are shuffled here, with n and levels in one number that a class's rows mostly share.
    """
    group = Window.partitionBy("window")
    levels = ("level", "short", "own")
    packed = F.col("n")
    for name in levels:
        packed = F.shiftleft(packed, LEVEL_BITS).bitwiseOR(F.col(name).cast("long"))
    rows = rows.select("window", "class", packed.alias("packed"))
    rows = rows.withColumn("low", F.min("class").over(group)).withColumn("high", F.max("class").over(group))
    rows = rows.where("low < high").drop("low", "high").dropDuplicates(["window", "class"])
    parts = [F.shiftright("packed", LEVEL_BITS * k).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).cast("short").alias(name) for k, name in zip((2, 1, 0), levels)]
    rows = rows.select("window", "class", F.shiftright("packed", LEVEL_BITS * 3).alias("n"), *parts)
    order = group.orderBy("n", "class")
    before = F.max(F.expr("IF(short <= own, n, NULL)")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", before).withColumn("after", F.lead("n").over(order))
    return rows.where(f"100 * before >= {percent} * n OR short <= own AND 100 * n >= {percent} * after").drop("before", "after")


def hash_filter(hashes: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """A Bloom filter of the column ``hash``, of a size that the driver can hold whatever the number of rows, and its slots per hash."""
    bits = 1 << 16
    while bits < min(MOST_BITS, 16 * count):
        bits *= 2
    slots = max(1, min(MOST_SLOTS, bits // (4 * max(1, count))))
    low, high = F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("hash", 32)
    slot = F.explode(F.array(*[F.pmod(low + F.lit(k) * high, F.lit(bits)) for k in range(slots)])).alias("slot")
    place = F.pmod("slot", F.lit(64)).cast("int")
    words = hashes.select(slot).select(F.shiftright("slot", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), place).alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64), slots


def may_hold(bitmap: np.ndarray, slots: int, value: int) -> bool:
    low, high = value & 0xFFFFFFFF, value >> 32
    places = ((low + k * high) % (64 * len(bitmap)) for k in range(slots))
    return all(int(bitmap[x >> 6]) >> (x & 63) & 1 for x in places)


def sets_in(docs: DataFrame, width: int, first: DataFrame, seed: int) -> DataFrame:
    """(class, windows) of the given classes; windows as sorted little-endian 64-bit numbers.

    ``first`` has (class, mark): a class's set is taken from the document with that mark, a hash of its id.
    A Bloom filter of bounded size tells which documents to pass on, so no text is shuffled to find them. It may
    let a few more sets through, and copies under one id come more than once; neither changes a link.
    """
    found = hash_filter(first.select(F.xxhash64("class", "mark").alias("hash")), first.count())
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bitmap, slots), seen = shared.value, Seen()
        for batch in batches:
            out = []
            for mark, windows in zip(batch.column(0).to_pylist(), sets_of(batch.column(1), width)):
                if not len(windows):
                    continue
                digest = class_of(windows)
                name = name_of(digest, seed)
                value = xxhash.xxh64_intdigest(struct.pack("<q", mark), seed=xxhash.xxh64_intdigest(struct.pack("<q", name), seed=42))
                if may_hold(bitmap, slots, value) and seen.add(digest):
                    out.append((name, windows.tobytes()))
            if out:
                names, sets = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], ["class", "windows"])

    return arrow_rows(docs.select(F.xxhash64("id").alias("mark"), "text"), run, "class long, windows binary")


def verified(docs: DataFrame, width: int, classes: DataFrame, pairs: DataFrame, percent: int, seed: int) -> DataFrame:
    """The pairs (a, b) of a written table whose sets are similar enough.

    The sets go from the texts straight to their pairs; they are about as large as the texts, so no copy of them
    is written.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = sets_in(docs, width, written(classes.select("class", "mark").join(wanted, "class"), "wanted"), seed)

    def similar(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            common = int((y[at] == x).sum())
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("class").alias("a"), F.col("windows").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("windows").alias("y"))
    # Merge joins: both read one shuffle of the sets, which are made once.
    whole = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").select("a", "b", "x", "y")
    return map_arrow(whole, similar, "a long, b long")


def sketch_columns() -> Column:
    """The sketch as a struct, whose parts code can be generated for."""
    return F.struct(*[F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH // 64)]).alias("sketch")


def similar_sizes(percent: int) -> Column:
    return F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")


def sketches_allow(percent: int) -> Column:
    """Whether the sketches of a pair leave room for the overlap that its sizes demand."""
    differ = F.lit(0).cast("long")
    for i in range(SKETCH // 64):
        differ = differ + F.bit_count(F.col("sketch_a")[f"s{i}"].bitwiseXOR(F.col("sketch_b")[f"s{i}"]))
    sizes = F.col("n_a") + F.col("n_b")
    return differ <= sizes - 2 * F.ceil(F.lit(percent) * sizes / F.lit(100 + percent))


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose wide sketches leave room for the overlap that their sizes demand, and those without.

    The sketches in the joins say little about sets of more windows than twice their bits; these sets are the
    largest to send, and a wide sketch has 1/32 of a set's size at most.
    """
    wide = classes.where("wide IS NOT NULL").select("class", "n", "wide")
    for side in ("a", "b"):
        of = wide.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("wide").alias(f"wide_{side}"))
        pairs = pairs.join(of, side, "left")

    def room(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for n_a, n_b, x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
            if not (x.is_valid and y.is_valid):
                keep.append(True)
                continue
            n = n_a + n_b
            most = n - 2 * -(-percent * n // (100 + percent))
            keep.append(wide_difference(*(np.frombuffer(s.as_buffer(), np.uint8) for s in (x, y))) <= most)
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(pairs.select("a", "b", "n_a", "n_b", "wide_a", "wide_b"), room, "a long, b long")


def chained_pairs(grouped: DataFrame, percent: int) -> DataFrame:
    """From rows (window, classes, class, n, sketch): near neighbours in each group's random order.

    Only pairs whose sketches allow a link. A group of any size gives at most ``NEIGHBOURS`` pairs per
    class; a group of many classes is cut into random pieces, one task each, that differ from group to group.
    """
    place = F.xxhash64("class", "window")
    grouped = grouped.withColumn("piece", F.pmod(place, F.ceil(F.col("classes") / PIECE)))
    order = Window.partitionBy("window", "piece").orderBy(place, "class")
    names = ("class", "n", "sketch")
    near = [F.struct(*[F.lag(c, k).over(order).alias(c) for c in names]) for k in range(1, NEIGHBOURS + 1)]
    pairs = grouped.select(*names, F.array(*near).alias("near"))
    pairs = pairs.select(*[F.col(c).alias(f"{c}_a") for c in names], F.explode("near").alias("near"))
    pairs = pairs.select("*", *[F.col(f"near.{c}").alias(f"{c}_b") for c in names]).where("class_b IS NOT NULL")
    pairs = pairs.where(similar_sizes(percent) & sketches_allow(percent))
    return pairs.select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")).distinct()


def named(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Rows with a ``component``: that of their class, or the class itself."""
    rows = rows.join(components, rows["class"] == components["node"], "left").drop("node")
    return rows.withColumn("component", F.coalesce("component", "class"))


def fewer_pairs(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b), a < b, those to verify first: a class keeps its smallest partner, and a share of many.

    Names are random, so copies with the same partners meet at one of them, and a link to it makes the others
    needless. In a large group, where links may fail, the share still holds it together. What this leaves apart is
    looked at with the later pairs.
    """
    of = pairs.groupBy("b").agg(F.min("a").alias("least"), F.count(F.lit(1)).alias("partners"))
    return pairs.join(of, "b").where(f"a = least OR partners >= {MANY} AND pmod(xxhash64(a, b), {SHARE}) = 0").select("a", "b")


def first_components(docs: DataFrame, matches: DataFrame, classes: DataFrame, width: int, percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(node, component) by links between neighbours in the groups of prefix windows, and the pairs looked at.

    Only pairs of neighbours are verified, so what a group of near copies costs grows with its members, not
    their pairs, and all but a few members come together.
    """
    # Windows are hashes, so the least by XOR with a number is a random one, and the same one for equal sets.
    picks = [F.min(F.col("window").bitwiseXOR(F.lit(x))).alias(f"pick_{k}") for k, x in enumerate(ORDERS)]
    picked = matches.groupBy("class").agg(*picks)
    least = F.array(*[F.col(f"pick_{k}").bitwiseXOR(F.lit(x)) for k, x in enumerate(ORDERS)])
    picked = picked.select("class", F.explode(F.array_distinct(least)).alias("window"))
    picked = written(picked, "picked")
    several = picked.groupBy("window").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    grouped = picked.join(several, "window").join(classes.select("class", "n", sketch_columns()), "class")
    grouped = written(grouped, "groups-of-windows")
    pairs = written(chained_pairs(grouped, percent), "chained-pairs")
    pairs = written(fewer_pairs(written(likely(pairs, classes, percent), "likely-pairs")), "first-pairs")
    links = written(verified(docs, width, classes, pairs, percent, seed), "first-links")
    free_shuffles(links.sparkSession)
    return written(components(links), "first-components"), pairs


def matched_pairs(matches: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """From rows (window, class, n, level, short, own, component): pairs of different components with enough matches.

    A pair meets in the windows of the smaller class's short prefix and the larger one's long prefix. With
    l the smaller of the two levels, the prefixes at level l must match l times. And of the one whose
    prefix ends first in the common order every window is decided: only the o - l windows after the prefix
    that it has in common at least may still be common, so the whole prefixes must match at least as often
    as these leave to the overlap that the pair's sizes demand. Pairs too different in size, or whose
    sketches differ too much for the overlap, are left out of the join itself.
    """
    group = Window.partitionBy("window")
    apart = matches.withColumn("low", F.min("component").over(group)).withColumn("high", F.max("component").over(group))
    apart = apart.withColumn("any_short", F.max(F.expr("short <= own")).over(group))
    apart = apart.where("low < high AND any_short").drop("low", "high", "any_short").join(classes.select("class", sketch_columns()), "class")
    apart = written(apart, "apart")
    free_shuffles(apart.sparkSession)
    names = ("class", "n", "level", "short", "own", "component", "sketch")
    small = apart.where("short <= own").select("window", *[F.col(c).alias(f"{c}_a") for c in names])
    large = apart.select("window", *[F.col(c).alias(f"{c}_b") for c in names])
    pairs = small.join(large, "window").where(
        F.expr("(n_a < n_b OR n_a = n_b AND class_a < class_b) AND component_a <> component_b")
        & similar_sizes(percent)
        & sketches_allow(percent)
    )
    low = F.least("own_a", "own_b")
    in_both = F.greatest("short_a", "level_b") <= low
    overlap = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    after = [F.ceil(F.lit(2 * percent) * F.col("n_a") / F.lit(100 + percent)) - F.col("own_a"), F.ceil(F.lit(percent) * F.col("n_b") / F.lit(100)) - F.col("own_b")]
    counted = pairs.groupBy(F.col("class_a").alias("a"), F.col("class_b").alias("b")).agg(
        F.count_if(in_both).alias("low_matches"),
        F.min(low).alias("low"),
        F.count(F.lit(1)).alias("matches"),
        F.min(overlap - F.greatest(*after)).alias("least"),
    )
    return counted.where("low_matches >= low AND matches >= least").select("a", "b")


def groups(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """For (id, text, ...): written rows of all columns but ``text`` with n and class, and (class, group).

    A group is the smallest class of a component. Rows without windows have a null class and no group.
    """
    rows = written(described(docs, width), "sets")
    own = [F.first(c).alias(c) for c in ("n", "sketch", "wide")] + [F.min(F.xxhash64("id")).alias("mark")]
    classes = written(rows.where("n > 0").groupBy("class").agg(*own), "classes")
    seed = seed_of_names(classes)
    rows, classes = (x.withColumn("class", named_by(seed)) for x in (rows, classes))

    windows = prefixes(docs, width, percent, frequent_windows(docs, width), seed)
    matches = written(meeting(windows, percent), "matches")
    free_shuffles(matches.sparkSession)

    # Only classes with a match can have links.
    first, done = first_components(docs, matches, classes, width, percent, seed)
    free_shuffles(matches.sparkSession)
    matched = matched_pairs(named(matches, first), classes, percent).join(done, ["a", "b"], "left_anti")
    matched = written(likely(written(matched, "matched-pairs"), classes, percent), "likely-pairs")
    free_shuffles(matches.sparkSession)
    links = written(verified(docs, width, classes, matched, percent, seed), "late-links")

    # Late links between components: the components are the nodes of a smaller graph.
    for side in ("a", "b"):
        of = first.select(F.col("node").alias(side), F.col("component").alias(f"component_{side}"))
        links = links.join(of, side, "left")
    over = [F.coalesce(F.col(f"component_{side}"), F.col(side)).alias(side) for side in ("a", "b")]
    second = components(links.select(over)).withColumnRenamed("component", "group")
    of_class = named(classes.select("class"), first)
    of_class = of_class.join(second.withColumnRenamed("node", "component"), "component", "left")
    of_class = of_class.select("class", F.coalesce("group", "component").alias("group"))
    return rows.drop("sketch", "wide"), written(of_class, "groups")


def linked_documents(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (the smallest id reachable by links, its own included)."""
    docs = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows, of_class = groups(docs, width, percent)
    least = rows.where("n > 0").groupBy("class").agg(F.min("id").alias("least")).join(of_class, "class")
    ids = least.groupBy("group").agg(F.min("least").alias("component_id"))
    out = rows.join(of_class.join(ids, "group").drop("group"), "class", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each_group(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """All columns of the rows that stay: of each component the one with the smallest id (then by a hash).

    Rows without words are linked with nothing and all stay.
    """
    key = unused(df, "row_key")
    parts = [F.coalesce(F.col(id_column).cast("string"), F.lit("null")), F.coalesce(F.col(text_column), F.lit(""))]
    keyed = df.withColumn(key, F.md5(F.concat_ws("/", *parts)))
    docs = keyed.select(F.col(id_column).alias("id"), F.col(key).alias("key"), F.col(text_column).alias("text"))
    rows, of_class = groups(docs, width, percent)
    copies = rows.groupBy("key", "id", "class").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "key", "copies")
    chosen = copies.join(of_class, "class").groupBy("group").agg(F.min(order).alias("first"))
    chosen = chosen.select(F.col("first.key").alias(key), F.col("first.copies").alias("copies"))
    alone = copies.where(F.col("class").isNull()).select(F.col("key").alias(key), F.lit(1).cast("long").alias("copies"))
    stay = written(chosen.union(alone), "staying").withColumnRenamed("copies", f"{key}_copies")
    kept = keyed.join(stay, key)
    once = kept.where(F.col(f"{key}_copies") == 1)
    return once.unionByName(kept.where(F.col(f"{key}_copies") > 1).dropDuplicates([key])).select(*df.columns)
