"""From ``documents`` to packed training sequences: five stages, each rereading what the one before wrote.

Language identification, n-gram Jaccard join, benchmark decontamination, redaction
of personal data, best-fit packing. Every stage works on all rows it is
given; all but the last return the columns of ``documents``. Rows with nulls in any column,
empty and repeated rows and empty tables pass as the operators define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam_simhash, jaccard_rtree, langid_gru, pack_vector, pii_weak
from tidemark.llm.frames import written
from tidemark.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Least mean probability of the predicted language for a document to stay.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without letters or with no clear language go."""
    return langid_gru.keep_known(docs, langid_gru.fit(docs), LEAST_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest doc_id stays."""
    return jaccard_rtree.keep_first(docs, percent=80, width=5)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam_simhash.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=80)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind."""
    return pii_weak.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of a document with its sequence and place there."""
    return pack_vector.pack(docs, tokenizer_file(), capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("personal data", redact_personal_data),
    ("packing", pack_sequences),
]

#: The language model and the packing have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
