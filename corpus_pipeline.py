"""From raw documents to token ids: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.byte_bpe import encode_texts
from tallyloom.llm.jaccard_join import one_of_each_group
from tallyloom.llm.mixing import mix, word_count
from tallyloom.llm.quality_rules import quality_verdicts, with_counts
from tallyloom.llm.secret_scan import redact_secrets
from tallyloom.llm.tables import table, unused, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own and their source's rules."""
    counts, kept = unused(docs, "counts"), unused(docs, "kept")
    judged = quality_verdicts(with_counts(docs, "text", counts), "source", counts, kept)
    return judged.where(kept).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark."""
    return redact_secrets(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it; what it doesn't take goes.

    The copy at which the mix's budget ends stays whole.
    """
    size = word_count(F.col("text"))
    mixed = mix(docs, "source", size, [F.col("doc_id"), size]).where("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size"))
    return mixed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode_texts(docs, path, public_tokenizers.PATTERN, decode=True)
    digits = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "token_ids",
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("source mixing", mixture),
    ("byte-level BPE", tokens),
]

#: The stages decode, match and merge bytes in ways that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
