"""Allow and block rules on URLs, found by an equi-join on short hashes.

A rule is a host and the beginning of a path. It fits its host and all subdomains. Each URL is expanded
into host suffix + path prefix, for the label counts and prefix lengths that occur among the rules;
each expression is hashed, joined to the rules by the first ``PREFIX_DIGITS`` digits of the hash, and
confirmed by the whole digest. The longest rule wins, then the one with the longer host, then block.

- Null URL, or one without ``://``: empty host and path, which no rule fits.
- A URL without a path doesn't begin with ``/``, so no rule fits it.
- Repeated rows are judged once and returned as often as they came. No rows, or no rules: no matches.
- Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8
#: Up to so many rules the join broadcasts them (about 100 bytes each); more are joined by shuffle,
#: with expressions that many URLs share dealt to so many tasks.
BROADCAST_RULES, SALTS = 200_000, 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = "action string, host string, path string"


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def judge_urls(
    df: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """Per row: id, url, host, path, the winning ``rule`` or null, ``verdict``.

    The driver holds the distinct (label count, path length) pairs of the rules.
    """
    rules = rules.select(
        F.sha2(F.concat("host", "path"), 256).alias("digest"),
        F.concat("host", "path").alias("rule"),
        F.struct(
            F.char_length(F.concat("host", "path")).alias("length"),
            F.char_length("host").alias("host_length"),
            (F.col("action") == "block").alias("block"),
            F.concat("host", "path").alias("rule"),
        ).alias("rank"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.char_length("path").alias("prefix"),
    )
    shapes = [(r["labels"], r["prefix"]) for r in rules.select("labels", "prefix").distinct().collect()]
    few = rules.count() <= broadcast_rules
    known = rules.groupBy("digest").agg(F.max("rank").alias("rank")).withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    known = F.broadcast(known) if few else known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    urls = df.groupBy(F.col(id_column).alias("id"), F.col(url_column).alias("url")).agg(F.count(F.lit(1)).alias("copies"))
    urls = urls.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    expressions = F.array(
        *[
            F.when(
                F.char_length("path") >= prefix,
                F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, prefix)),
            )
            for labels, prefix in shapes
        ]
    ).cast("array<string>")
    digests = F.transform(F.array_distinct(F.array_compact(expressions)), lambda x: F.sha2(x, 256))
    expanded = urls.withColumn("url_digest", F.explode_outer(digests))
    expanded = expanded.withColumn("short", F.substring("url_digest", 1, PREFIX_DIGITS))
    keys = ["short"]
    if not few:
        expanded = expanded.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
        keys.append("salt")
    confirmed = F.when(F.col("digest") == F.col("url_digest"), F.col("rank"))
    judged = (
        expanded.join(known, keys, "left")
        .groupBy("id", "url")
        .agg(
            F.first("host").alias("host"),
            F.first("path").alias("path"),
            F.first("copies").alias("copies"),
            F.max(confirmed).alias("rank"),
        )
    )
    verdict = F.when(F.col("rank.block"), "block").when(F.col("rank").isNotNull(), "allow").otherwise(default)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return judged.withColumn("copy", each).select(
        F.col("id").alias(id_column),
        F.col("url").alias(url_column),
        "host",
        "path",
        F.col("rank.rule").alias("rule"),
        verdict.alias("verdict"),
    )
