"""One-permutation MinHash fingerprints, from Spark expressions alone.

The distinct five-word windows of a text are hashed once. The top bits of a hash name its bin; each
bin keeps its smallest hash. An empty bin takes over the value of the first filled bin in a random
probe order of its own (optimal densification), the same order for every text. The low ``BITS`` bits
of each bin are packed into longs. Two bins that differ still agree in their low bits with chance
2 ** -BITS, which the likeness is corrected for.

A text of fewer than five words counts as one window; a text without words (or null) has no windows
and the empty fingerprint. Two empty fingerprints have likeness 1, an empty and another one 0. Equal
texts have equal fingerprints, whatever other columns hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import SPACES, unused

BINS_LOG2, BITS, WIDTH, PROBES = 8, 4, 5, 6
BINS = 1 << BINS_LOG2
PER_LONG = 64 // BITS
LOW_BITS = (1 << BITS) - 1
#: A one in the lowest place of every packed value.
ONES = sum(1 << BITS * i for i in range(PER_LONG))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _bin(x: Column) -> Column:
    return F.shiftright(x, 63 - BINS_LOG2).cast("int")


def window_hashes(text: Column) -> Column:
    """Non-negative hashes of the word windows, in order, repeated ones included."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), lambda w: w != "")

    def of(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - WIDTH)
        full = F.transform(places, lambda i: F.xxhash64(*[h[i + k] for k in range(WIDTH)]))
        short = F.transform(F.filter(F.array(h), lambda x: F.size(x) > 0), lambda x: F.xxhash64(x))
        return F.when(F.size(h) >= WIDTH, full).otherwise(short)

    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), of)
    return F.transform(hashed, lambda x: F.shiftrightunsigned(x, 1))


def bin_minima(hashes: Column) -> Column:
    """The smallest hash of each filled bin, by bin."""
    return let(
        F.sort_array(hashes),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(s[F.greatest(i - 1, F.lit(0))]))),
    )


def densified(minima: Column) -> Column:
    """A value for each bin: its own, or that of the first filled bin it probes."""

    def spread(m: Column) -> Column:
        # Every place up to the next filled bin holds the value before it; it is that bin's own only
        # where the value's bin is the place itself.
        until = lambda i: F.when(i + 1 < F.size(m), _bin(m[F.least(i + 1, F.size(m) - 1)])).otherwise(BINS)
        since = lambda x, i: F.when(i == 0, 0).otherwise(_bin(x))
        return F.flatten(F.transform(m, lambda x, i: F.array_repeat(x, until(i) - since(x, i))))

    def fill(m: Column, places: Column) -> Column:
        def own(p: Column) -> Column:
            return let(places[p], lambda x: F.when(_bin(x) == p, x))

        def value(j: Column) -> Column:
            probes = [F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int") for t in range(PROBES)]
            rest = F.array_min(F.transform(m, lambda x: F.struct(F.xxhash64(_bin(x), j).alias("turn"), x.alias("x"))))["x"]
            return F.coalesce(own(j), *[let(p, own) for p in probes], rest)

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)

    return let(minima, lambda m: let(spread(m), lambda places: fill(m, places)))


def packed(text: Column) -> Column:
    """The fingerprint as an array of longs; null for a text without words."""
    values = lambda m: F.transform(densified(m), lambda x: x.bitwiseAND(F.lit(LOW_BITS)))

    def pack(v: Column) -> Column:
        groups = F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1))
        return F.transform(
            groups,
            lambda g: F.aggregate(
                F.slice(v, g * PER_LONG + 1, F.lit(PER_LONG)),
                F.lit(0).cast("long"),
                lambda acc, x: F.shiftleft(acc, BITS).bitwiseOR(x),
            ),
        )

    return let(bin_minima(window_hashes(text)), lambda m: F.when(F.size(m) > 0, let(values(m), pack)))


def as_hex(fingerprint: Column) -> Column:
    digits = F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 16, "0")))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of common windows, between 0 and 1."""

    def unequal(x: Column) -> Column:
        folded = x
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, k))
        return F.bit_count(folded.bitwiseAND(F.lit(ONES)))

    differ = F.aggregate(
        F.zip_with(a, b, lambda x, y: let(x.bitwiseXOR(y), unequal)),
        F.lit(0),
        lambda acc, n: acc + n,
    )
    chance = 2.0**-BITS
    corrected = ((BINS - differ) / F.lit(float(BINS)) - chance) / (1 - chance)
    both = F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0))
    return both.otherwise(F.greatest(corrected, F.lit(0.0)))


def fingerprinted(df: DataFrame, text_column: str = "text", into: str = "fingerprint") -> DataFrame:
    """All rows and columns, and the packed fingerprint of the text."""
    return df.withColumn(into, packed(F.col(text_column)))


def with_following(df: DataFrame, id_column: str, text_column: str, carried: dict[str, str], buckets: int) -> DataFrame:
    """All rows, and columns of the next row by descending id; the last row is followed by the first.

    Rows of one id stand by ascending text; a null id comes last. Ids are cut into about ``buckets``
    ranges, one window each. A range's first rows also go, as ghosts, to the range before it, so that
    no row looks beyond its own range and texts are shuffled once. Only the limits of the ranges, at
    most ``buckets`` numbers, pass through the driver.
    """
    key = F.col(id_column)
    shares = [i / buckets for i in range(1, buckets)]
    limits = df.agg(F.percentile_approx(key, shares, 10 * buckets)).first()[0] if shares else None
    limits = sorted(set(limits or []))
    place = F.coalesce(F.size(F.filter(F.lit(limits), lambda x: x <= key)), F.lit(0)) if limits else F.lit(0)
    place = F.when(key.isNull(), 0).otherwise(place)
    firsts = {r["place"]: r["first"] for r in df.groupBy(place.alias("place")).agg(F.max(key).alias("first")).collect()}
    filled = sorted(firsts) or [0]
    above = {low: high for low, high in zip(filled, filled[1:])} | {filled[-1]: filled[0]}
    bucket, ghost = unused(df, "bucket"), unused(df, "ghost")
    kind = dict(df.dtypes)[id_column]
    first = F.array(*[F.lit(firsts.get(i)).cast(kind) for i in range(len(limits) + 1)])
    target = F.array(*[F.lit(above.get(i)).cast("int") for i in range(len(limits) + 1)])
    copies = let(
        place,
        lambda p: F.concat(
            F.array(F.struct(p.alias("to"), F.lit(False).alias("ghost"))),
            F.when(key.eqNullSafe(first[p]), F.array(F.struct(target[p].alias("to"), F.lit(True).alias("ghost")))).otherwise(
                F.array().cast("array<struct<to:int,ghost:boolean>>")
            ),
        ),
    )
    copy = unused(df, "copy")
    spread = df.withColumn(copy, F.explode(copies)).select(
        *df.columns, F.col(copy)["to"].alias(bucket), F.col(copy)["ghost"].alias(ghost)
    )
    order = Window.partitionBy(bucket).orderBy(ghost, key.desc_nulls_last(), F.col(text_column).asc_nulls_first())
    following = [F.lead(column).over(order).alias(name) for column, name in carried.items()]
    return spread.select("*", *following).where(~F.col(ghost)).drop(bucket, ghost)
