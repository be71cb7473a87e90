"""The corpus pipeline: five stages over ``documents``.

toxicity (documents that it rejects go), n-gram Jaccard join (one document of
each group of near duplicates stays), benchmark decontamination (documents
into which an item leaks go), secret scan (live credentials are masked, no
document goes), byte-level BPE (the ids of what is left, decoded again).

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
in the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, jaccard, secret_scan, toxicity
from tidemark.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``, which no two rows share: file and position of a Parquet input (any other is written first).

    Stages judge rows, not ids: a null or repeated ``doc_id`` ties no rows together.
    """
    at = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("row")
    try:
        return docs.select(*COLUMNS, at)
    except AnalysisException:  # no file below
        return written(docs.select(*COLUMNS), "pipeline-rows").select(*COLUMNS, at)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows whose score is 0.5 or more; the classifier learns from the labelled rows of ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), where=toxicity.held_in())
    rows = _rows(docs)
    bad = toxicity.score(rows, model, key="row").where("predicted = 1").select("row")
    return rows.join(bad, "row", "left_anti").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked rows the one with the smallest id (null last), of equal ids the first row; rows without words all stay."""
    rows = _rows(docs)
    classes = jaccard.similarity_classes(rows, key="row").join(rows.select("row", "doc_id"), "row")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    stay = classes.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"))
    return rows.join(stay, "row", "left_semi").select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows into which a benchmark item leaks."""
    rows = _rows(docs)
    bad = decontam.leaks(rows, table(spark, sf_dir, "benchmark"), key="row").select("row").distinct()
    return rows.join(bad, "row", "left_anti").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials become ``[kind]``; ``n_chars`` follows the text."""
    masked = secret_scan.redact(_rows(docs), key="row", repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded bytes (a small cache: the workers have other stages' memory too)."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True, cache_entries=500_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("bpe", encode),
]

#: The classifier, the ownership verdicts and the merges have no SQL form; the operators are tested against brute force, the stages for their effect.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over all that its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
