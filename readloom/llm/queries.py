"""Queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracles import ORACLE_SQL as ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import ngram_join

    return ngram_join.join(_table(spark, sf_dir, "documents")).drop("hash", "other", "first")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import shared, token_store

    path = shared.folder(spark, "tokens")
    token_store.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read(spark, path, ids=False)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import shared, warc

    path = shared.folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    return quality.rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids again; ``round_trip`` says whether the text came back."""
    import public_tokenizers

    from . import pieces

    return pieces.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_text=False).drop("ids")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import substring

    return substring.dedup(_table(spark, sf_dir, "documents")).drop("text")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    return decontaminate.mark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("items", "spans")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html_extract

    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffix_dedup

    return suffix_dedup.dedup(_table(spark, sf_dir, "documents")).drop("text")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import licenses

    return licenses.scan(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import turns

    return turns.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import vector_codes

    return vector_codes.with_label_error(*vector_codes.compress(_table(spark, sf_dir, "embeddings")))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secret_scan

    return secret_scan.scan(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_jaccard_join, op2_token_store, op3_warc, op4_quality_rules, op5_sentencepiece, op6_substring_dedup, op7_benchmark_decontamination, op8_html_extraction, op9_suffix_array_dedup, op10_license_scan, op11_conversation_repair, op12_vector_codes, op13_secret_scan)
}
