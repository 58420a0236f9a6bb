"""Clean a corpus in stages and tokenize what is left.

Each stage works on all rows the one before kept; a stage's result is written and read again before the next begins when
the stages are run one by one, and ``run`` stores it in the shared folder in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martkit.llm import decontaminate, line_dedup, ngram_join, sentencepiece_bpe, toxicity
from martkit.llm.common import cut
from martkit.llm.queries import table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# SQL cannot express a trained classifier or a tokenizer; tests hold each stage against plain Python.
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, trained on all labels, rejects are gone."""
    model = toxicity.learn_toxicity(docs, table(spark, folder, "labels"), F.lit(False))
    return toxicity.drop_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines that nearly repeat an earlier line are gone from the texts; every document stays."""
    return line_dedup.drop_repeated_lines(docs, chars="n_chars")


def drop_similar(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents that similar shingle sets link, the one with the smallest id stays."""
    return ngram_join.drop_similar(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of which a twentieth or more are passages of the benchmark are gone."""
    return decontaminate.drop_contaminated(docs, table(spark, folder, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token count and digests of every document that is left."""
    model = sentencepiece_bpe.read_model(tokenizer_path("piece_bpe_32k.model"))
    return sentencepiece_bpe.encoding_digests(docs, model)


STAGES: list[tuple[str, Stage]] = [
    ("drop_toxic", drop_toxic),
    ("drop_repeated_lines", drop_repeated_lines),
    ("drop_similar", drop_similar),
    ("drop_contaminated", drop_contaminated),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
