"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import conversation_trie, decontam_simhash, dedup_chunks, html_segment, jaccard_rtree, langid_gru, lines_crf, merkle_manifest, pack_vector, pii_weak, quality_pu, secrets_guess, toxic_chain

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_weak.detect(_table(spark, sf_dir, "documents"))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_crf.rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_segment.articles(_table(spark, sf_dir, "pages"))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_vector.pack(_table(spark, sf_dir, "documents"), tokenizer_file(), capacity=2048)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_rtree.join(_table(spark, sf_dir, "documents"), percent=80, width=5)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_chain.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_guess.detect(_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_gru.identify(_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam_simhash.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=80)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_chunks.deduplicate(_table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(conversation_trie.forked(_table(spark, sf_dir, "conversations")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.audit(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_quality, op2_pii, op3_line_rules, op4_main_text, op5_packing, op6_ngram_jaccard, op7_toxicity,
            op8_secrets, op9_language, op10_decontaminate, op11_exact_dedup, op12_conversation_trie, op13_merkle_manifest,
        )
    }
