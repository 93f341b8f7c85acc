"""Session helpers shared by the library, the driver entry and the tests."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from derrick.sources import storage


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates and epochs are read in UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, as the session names it in
    ``spark.checkpoint.dir``. Only a local session, which has no other machine,
    may leave it unnamed; its folder goes when the process ends."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="derrick-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as soon as each write has ended. Otherwise they stay on the executors'
    disks until the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def passing(spark: SparkSession) -> Iterator[str]:
    """A folder for frames cut ``within`` it that nobody reads after the block: their tables go with it."""
    folder = f"{shared_folder(spark)}/derrick-{uuid.uuid4()}"
    try:
        yield folder
    finally:
        storage.remove_own(spark, folder)


def cut_lineage(df: DataFrame, within: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    A parquet table rather than a row checkpoint, so that later steps read only
    the columns they need. It lives in the shared folder and survives the loss
    of executors.
    """
    path = f"{within or shared_folder(df.sparkSession)}/derrick-{uuid.uuid4()}"
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
