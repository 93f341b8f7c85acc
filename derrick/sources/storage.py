"""Small file-system questions, answered through the session's Hadoop client."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _path(spark, path)
    return system.exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark's file sources write it, with its scheme."""
    system, target = _path(spark, path)
    return system.makeQualified(target).toString().rstrip("/")


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the zero-byte files at a path or pattern. Spark's file sources
    pass over such files in silence, so they are looked for here."""
    system, target = _path(spark, path)
    found = []
    for top in system.globStatus(target) or []:
        inner = system.listStatus(top.getPath()) if top.isDirectory() else [top]
        for status in inner:
            name = status.getPath().getName()
            if status.isFile() and status.getLen() == 0 and not name.startswith(("_", ".")):
                found.append(status.getPath().toString())
    return found


def remove_own(spark: SparkSession, path: str) -> None:
    """Drop a file or folder that the library has written itself."""
    system, target = _path(spark, path)
    system.delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders at a path; none if it doesn't exist."""
    system, target = _path(spark, path)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory())


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    system, target = _path(spark, path)
    return system.getContentSummary(target).getLength()


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files at a path; none if it doesn't exist."""
    system, target = _path(spark, path)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isFile())


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _path(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, text: str, path: str) -> bool:
    """Write a small file and give it its name by one rename; False if the name is taken already."""
    system, target = _path(spark, path)
    draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4()}"
    _, hidden = _path(spark, draft)
    stream = system.create(hidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context, gateway = spark.sparkContext, spark.sparkContext._gateway
    rename = gateway.jvm.org.apache.hadoop.fs.Options.Rename
    where = gateway.jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), context._jsc.hadoopConfiguration())
    try:
        where.rename(system.makeQualified(hidden), system.makeQualified(target), gateway.new_array(rename, 0))
    except Py4JJavaError as error:
        system.delete(hidden, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True
