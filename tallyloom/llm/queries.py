"""The registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.byte_bpe import encode_texts
from tallyloom.llm.fingerprints import as_hex, fingerprinted, likeness, packed, with_following
from tallyloom.llm.hash_tree import even_tree, grown, with_shard, with_slot
from tallyloom.llm.impact_search import ranked_search
from tallyloom.llm.importance import resample
from tallyloom.llm.jaccard_join import linked_documents
from tallyloom.llm.line_dedup import dedup_lines
from tallyloom.llm.mixing import mix, word_count
from tallyloom.llm.page_text import extract_text
from tallyloom.llm.quality_rules import COUNTS, base_failed, quality_verdicts, with_counts
from tallyloom.llm.secret_scan import scan_secrets
from tallyloom.llm.tables import table, text_or_empty, written
from tallyloom.llm.token_files import WordIds, encode_files, read_files
from tallyloom.llm.url_filter import RULES, judge_urls


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    counted = written(with_counts(documents, "text", "counts").drop("text"), "rule-counts")
    judged = quality_verdicts(counted, "source", "counts", "kept")
    counts = [F.col("counts")[name].alias(name) for name in COUNTS]
    return judged.select("doc_id", *counts, base_failed(F.col("counts")).alias("base_failed"), "kept")


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", text_or_empty("text").alias("text"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    carried = {"text": "next_text", "fingerprint": "next_fingerprint"}
    paired = with_following(fingerprinted(documents), "doc_id", "text", carried, buckets)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    paired = paired.withColumn("edited", edited).withColumn("edited_fingerprint", packed(F.col("edited")))
    own = F.col("fingerprint")
    return paired.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_hex(own).alias("fingerprint"),
        as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"),
    )


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = even_tree(40)
    text = text_or_empty("text")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = with_shard(with_shard(documents, "doc_id", tree, "shard"), "doc_id", grown(tree), "grown_shard")
    order = ["doc_id", "size", "text_crc32"]
    return with_slot(written(placed, "shards"), "shard", order, "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


#: The rules to apply.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    documents = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mix(documents, "source", F.col("size"), [F.col("doc_id"), F.col("size")])
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents"))


#: Fixed value: the id that ends each document.
END_ID = 2


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = encode_files(table(spark, sf_dir, "documents"), lambda: WordIds.load(path).encode, END_ID, parts)
    read = read_files(written(files, "token-files"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, sf_dir, "documents")
    encoded = encode_texts(documents, path, public_tokenizers.PATTERN, decode=True)
    digits = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": secret_scans,
    "op2_quality_rules": quality_rules,
    "op3_document_fingerprints": document_fingerprints,
    "op4_sharding": sharding,
    "op5_url_filters": url_filters,
    "op6_source_mixing": source_mixing,
    "op7_html_extraction": html_extraction,
    "op8_ngram_jaccard_join": ngram_jaccard_join,
    "op9_token_files": token_files,
    "op10_byte_bpe": byte_bpe,
    "op11_line_dedup": line_dedup,
    "op12_ranked_search": ranked_lexical_search,
    "op13_importance_resampling": importance_resampling,
}
