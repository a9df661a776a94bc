"""Rules on documents, and rules on their hosts.

Each document gets counts and fails some rules. Per host and rule the share of failing documents is
shrunk towards the share over all hosts: the prior is the beta distribution whose mean and spread are
those of the hosts' rates, less the spread that chance alone explains. A host whose shrunk rate of any
rule is over the limit is rejected, and with it all its documents.

- Null or empty text: no words, so it fails the length rule.
- Null host: a host of its own.
- No documents: no hosts, no rows.
- Repeated rows count and are judged one by one.
- All columns of the input are kept; the counts travel in one struct with a name of the caller's choice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.tables import arrow_rows, text_buffers, unused, written
from tallyloom.llm.words import text_words, windows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the rules compare with besides.
ALL_COUNTS = (*COUNTS, "n_lines")
REPEAT_WIDTH = 8
#: Characters that count as symbols, and those that separate words.
SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\v\f\r"


@dataclass(frozen=True)
class Limits:
    """Document rules, and the share of failing documents beyond which a host is rejected."""

    least_words: int = 20
    most_repeated_percent: int = 30
    most_symbol_percent: int = 50
    most_duplicate_lines_percent: int = 50
    host_rate: float = 0.5


def repeated_words(words: np.ndarray, width: int = REPEAT_WIDTH) -> int:
    """How many words stand in windows that occur at least twice."""
    found = windows(words, width)
    if len(found) < 2:
        return 0
    order = np.argsort(found, kind="stable")
    same = found[order[1:]] == found[order[:-1]]
    if not same.any():
        return 0
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, order[twice], 1)
    np.add.at(change, order[twice] + width, -1)
    return int((np.cumsum(change) > 0).sum())


def line_counts(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    lines = [x for x in text.split("\n") if x.strip(SPACE_CHARS)]
    return len(lines) - len(set(lines)), len(lines)


def text_counts(texts: pa.Array) -> pa.StructArray:
    """ALL_COUNTS of each text."""
    data, at = text_buffers(texts)
    counts = []
    for text, words in zip(texts, text_words(data, at, fold_case=False)):
        text = text.as_py() or ""
        n_dup_lines, n_lines = line_counts(text)
        counts.append(
            (
                len(words),
                len(text) - sum(map(text.count, SPACE_CHARS)),
                sum(map(text.count, SYMBOLS)),
                n_dup_lines,
                repeated_words(words),
                n_lines,
            )
        )
    columns = zip(*counts) if counts else [()] * len(ALL_COUNTS)
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], names=ALL_COUNTS)


def with_counts(df: DataFrame, text_column: str, into: str) -> DataFrame:
    """All rows and columns, and the counts as a struct column ``into``."""
    at = df.columns.index(text_column)
    kind = T.StructType([T.StructField(name, T.LongType()) for name in ALL_COUNTS])
    schema = T.StructType([*df.schema.fields, T.StructField(into, kind)])

    def run(batches):
        for batch in batches:
            columns = [*batch.columns, text_counts(batch.column(at))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, into])

    return arrow_rows(df, run, schema)


def base_failed(counts: Column, limits: Limits = Limits()) -> Column:
    return (counts.n_words < limits.least_words) | (
        100 * counts.n_repeat_words > limits.most_repeated_percent * counts.n_words
    )


def rule_failures(counts: Column, limits: Limits) -> dict[str, Column]:
    """The rules whose failures are counted by host."""
    return {
        "short": counts.n_words < limits.least_words,
        "repeats": 100 * counts.n_repeat_words > limits.most_repeated_percent * counts.n_words,
        "symbols": 100 * counts.n_symbols > limits.most_symbol_percent * counts.word_chars,
        "lines": 100 * counts.n_dup_lines > limits.most_duplicate_lines_percent * counts.n_lines,
    }


def host_rates(counted: DataFrame, host_column: str, counts: str, limits: Limits = Limits()) -> DataFrame:
    """Per host: ``host``, ``documents``, and for each rule its shrunk failure rate; ``rejected``.

    Method of moments: with mean ``m`` and variance ``v`` of the hosts' rates, and ``e`` the mean of
    m (1 - m) / n over hosts, the rates spread by v - e, so the prior weighs m (1 - m) / (v - e) - 1
    documents. Hosts that differ no more than chance explains share the overall rate: the prior then
    weighs as much as all documents. The driver holds the prior, a few numbers.
    """
    rules = rule_failures(F.col(counts), limits)
    hosts = counted.groupBy(F.col(host_column).alias("host")).agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.sum(F.when(failed, 1).otherwise(0)).alias(name) for name, failed in rules.items()],
    )
    hosts = written(hosts, "host-failures")
    n = F.col("documents")
    prior = hosts.agg(
        F.sum(n).alias("documents"),
        F.avg(1 / n).alias("inverse"),
        *[F.avg(F.col(r) / n).alias(f"mean_{r}") for r in rules],
        *[F.var_pop(F.col(r) / n).alias(f"variance_{r}") for r in rules],
    ).first()
    shrunk = []
    for r in rules:
        m, v = prior[f"mean_{r}"] or 0.0, prior[f"variance_{r}"] or 0.0
        chance = m * (1 - m) * (prior["inverse"] or 0.0)
        weight = max(m * (1 - m) / (v - chance) - 1, 0.0) if v > chance else float(prior["documents"] or 0)
        shrunk.append(((F.col(r) + weight * m) / (n + weight)).alias(f"{r}_rate"))
    rates = hosts.select("host", "documents", *shrunk)
    worst = F.greatest(*[F.col(f"{r}_rate") for r in rules])
    return rates.withColumn("rejected", worst > limits.host_rate)


def quality_verdicts(
    counted: DataFrame, host_column: str, counts: str, into: str, limits: Limits = Limits()
) -> DataFrame:
    """All rows and columns, and ``into``: whether the document passes its own and its host's rules."""
    bad, hit = unused(counted, "bad_host"), unused(counted, "hit")
    rates = host_rates(counted, host_column, counts, limits)
    rejected = rates.where("rejected").select(F.col("host").alias(bad), F.lit(True).alias(hit))
    joined = counted.join(rejected, F.col(host_column).eqNullSafe(F.col(bad)), "left")
    judged = ~base_failed(F.col(counts), limits) & F.col(hit).isNull()
    return joined.select(*[F.col(c) for c in counted.columns], judged.alias(into))
