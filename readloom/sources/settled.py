"""Tables in the folder that driver and executors share, for what must be evaluated once."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which shuffle files go at the end of the execution that made them.
CLEARED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession, label: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names; in a temporary one only on a single machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.gettempdir()
    return f"{base.rstrip('/')}/readloom-{label}-{uuid.uuid4().hex}"


@contextmanager
def cleared(spark: SparkSession):
    """What is shuffled for a table that is written in this block goes as soon as the table is there, not with the driver's next collection of garbage."""
    before = spark.conf.get(CLEARED, None)
    spark.conf.set(CLEARED, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEARED) if before is None else spark.conf.set(CLEARED, before)


def settled(rows: DataFrame, label: str = "table") -> DataFrame:
    """The rows as written once and read again: plans that use them several times see the same ones."""
    path = folder(rows.sparkSession, label)
    with cleared(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def kept(spark: SparkSession, path: str, make, again: bool = False) -> DataFrame:
    """The table at ``path``; where it is missing or unfinished, or ``again``, that which ``make`` gives is written there first."""
    if again or not _exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def by_parts(spark: SparkSession, path: str, parts: DataFrame, make, columns: str) -> DataFrame:
    """The table at ``path``, of which each part (equal values of the columns of ``parts``) is made once.

    Finished parts stand in a manifest beside the table. ``make`` gets the parts that are missing and gives their rows,
    the ``columns`` and those of the part; these take the place of what a broken run left of the same parts, and then the parts enter the manifest. So a run that
    ends early costs the parts that it had not finished, and a later one with more parts makes only these. A part without
    rows counts as finished.
    """
    keys, rows, manifest = list(parts.columns), f"{path}/rows", f"{path}/finished"
    missing = parts.distinct()
    schema = missing.schema
    whole = ", ".join([columns, *(f"{f.name} {f.dataType.simpleString()}" for f in schema)])
    if _exists(spark, manifest):
        missing = missing.join(spark.read.schema(schema).parquet(manifest), keys, "left_anti")
    missing = settled(missing, "missing")
    if not missing.isEmpty():
        with cleared(spark):
            make(missing).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(rows)
        missing.coalesce(1).write.mode("append").parquet(manifest)
    if not _exists(spark, rows):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(rows)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
