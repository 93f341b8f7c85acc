"""Tables and SQL text as sources."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_path(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scan_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """An external database table; give ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def run_sql(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with parameter markers over named frames; a failure is logged and raised."""
    try:
        return spark.sql(text, args=args, **frames)
    except Exception:
        logger.exception("SQL query failed")
        raise


def point_lookup(df: DataFrame, **key: object) -> DataFrame:
    """The row of a key. The filter reaches the scan."""
    for column, value in key.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df.limit(1)


def require_row(df: DataFrame, **key: object):
    """The row of a key on the driver; an unknown key is an error."""
    row = point_lookup(df, **key).first()
    if row is None:
        raise LookupError(f"no row for {key}")
    return row
