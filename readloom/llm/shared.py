"""Tables in the folder that driver and executors share, and columns of any name."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_fallback: list[str] = []


def folder(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``; where that is unset, a temporary folder on a single machine, an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _fallback:
            _fallback.append("file://" + tempfile.mkdtemp(prefix="readloom-"))
        base = _fallback[0]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def table(df: DataFrame, label: str) -> DataFrame:
    """Write a frame and read it again: its lineage ends here, and a lost executor costs a reread."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def any_names(f):
    """For functions of rows of documents that give all their columns in order: these, but for doc_id and text, may have any name."""

    @functools.wraps(f)
    def named(docs: DataFrame, *args, **options) -> DataFrame:
        plain = [c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)]
        return f(docs.toDF(*plain), *args, **options).toDF(*docs.columns)

    return named
