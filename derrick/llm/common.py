"""Table access and label samples shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LABEL_SAMPLE = 20_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows kept away from learning: crc32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(labels: DataFrame, limit: int = LABEL_SAMPLE) -> DataFrame:
    """doc_id and quality of at most ``limit`` labelled rows outside the held-out fold.

    The bound is a parameter of the classifiers; the rows are the first by the
    hash of their id, so the sample doesn't depend on order or partitions. An id
    with several labels counts once, by the smallest.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    one = known.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
