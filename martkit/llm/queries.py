"""The registered queries of this package: each applies one operator to a whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martkit.llm import (
    conversation_repair, decontaminate, exact_dedup, fill_middle, language_id, license_scan, line_dedup, ngram_join, quality, secret_scan,
    sentencepiece_bpe, toxicity, url_filter,
)
from martkit.llm.common import in_fold


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; a folder in ``MARTKIT_TOKENIZERS`` goes first."""
    folder = os.environ.get("MARTKIT_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = sentencepiece_bpe.read_model(tokenizer_path("piece_bpe_32k.model"))
    return sentencepiece_bpe.encoding_digests(table(spark, folder, "documents"), model)


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_classes(table(spark, folder, "documents"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.find_copies(spark, f"{folder.rstrip('/')}/documents.parquet")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_report(table(spark, folder, "documents"), in_fold("doc_id", 4, 2))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(
        table(spark, folder, "documents"), table(spark, folder, "labels"), in_fold("doc_id", 5, 0)
    )


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(
        table(spark, folder, "documents"), table(spark, folder, "labels"), in_fold("doc_id", 3, 1)
    )


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_report(table(spark, folder, "documents"))


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, folder, "documents"))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.fill_digests(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair_report(conversation_repair.damaged(table(spark, folder, "conversations")))


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_report(table(spark, folder, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_decontaminate": op2_decontaminate,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_language_id": op5_language_id,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_secret_scan": op10_secret_scan,
    "op11_fill_middle": op11_fill_middle,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_url_filter": op13_url_filter,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
    "op9_license_scan": license_scan.license_sql(),
    "op11_fill_middle": fill_middle.fill_sql(),
    "op13_url_filter": url_filter.url_sql(),
}
