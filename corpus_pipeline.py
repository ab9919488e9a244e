"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, token pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``, others that
``docs`` may have come along. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import decontaminate, ngram_join, pieces, quality, shared, suffix_dedup


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the classifier rejects go.

    Null and empty texts are rejected; rows that repeat are judged alike; an id plays a part only where the
    classifier learns from a labelled row; without usable labels the base rule decides alone.
    """
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id stays, once; all others without copies stay.

    Rows without doc_id stay only where no near copy has one; texts without words are copies of none but
    rows that repeat both id and text.
    """
    return ngram_join.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that occur more than once are cut out of the texts.

    Every row stays, one whose text is all repeats with an empty one; a null text becomes empty; repeated rows
    are occurrences of each other. ``n_chars`` is counted anew.
    """
    cut = suffix_dedup.cut_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; null and wordless texts and items hold none."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left, and whether they decode to the text: a row per document, none of an empty text's ids."""
    import public_tokenizers

    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"), with_text=False).select("doc_id", "n_pieces", "ids_crc32", "n_chars", "text_sha256", "round_trip", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("SentencePiece encoding and decoding", token_pieces),
]

#: SQL cannot express the trained classifier of the first stage; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = shared.table(docs, "stage")
    return docs
