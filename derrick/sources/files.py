"""Dropped files: delimited text, JSON documents and workbooks.

Every reader returns text columns; the clean step gives them their types.
"""

from __future__ import annotations

import logging

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.functions.scalars import SUPPORTED_SUFFIXES, has_suffix
from derrick.sources import storage
from derrick.sources.workbook import sheet_rows

logger = logging.getLogger(__name__)

# Texts that mean "missing" in delimited files.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
SHEET_BATCH = 5000
PACKED = (".csv.gz", ".txt.gz")  # delimited files that Spark unpacks
NO_LINE_END = "\0"  # stands in no JSON document


def null_tokens(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in texts})


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated text with a header. The header of every file is checked
    against the first one, so columns of another order cannot slip in."""
    header = spark.read.option("header", True).csv(path).schema
    if not header.fields:
        raise ValueError(f"no columns in '{path}'")
    frame = spark.read.schema(header).option("header", True).option("enforceSchema", False).csv(path)
    return null_tokens(frame)


def _json_shape(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """``records``, ``arrays`` or ``maps``, and the column names of the latter two.
    Only the first characters and the key names leave the tasks."""
    whole = spark.read.text(path, wholetext=True)
    first = F.substring(F.trim("value"), 1, 1)
    keys = F.when(first == "{", F.json_object_keys("value"))
    member = F.expr("""get_json_object(value, concat("$['", get(keys, 0), "']"))""")
    rows = (
        whole.select("value", first.alias("first"), keys.alias("keys"))
        .select("first", "keys", F.substring(member, 1, 1).alias("inner"))
        .distinct()
        .collect()
    )
    shapes = {
        "records" if r["first"] == "[" else {"[": "arrays", "{": "maps"}.get(r["inner"], "other") for r in rows
    }
    if len(shapes) != 1 or shapes == {"other"}:
        raise ValueError(f"unsupported JSON structure in '{path}'")
    names = list(dict.fromkeys(k for r in rows for k in r["keys"] or []))
    return shapes.pop(), names


def _record_names(spark: SparkSession, path: str) -> list[str]:
    """The names in lists of flat records, sorted; none if a document is malformed or holds something else."""
    maps = F.from_json("value", "array<map<string,string>>")
    records = spark.read.text(path, wholetext=True).select(F.explode(F.coalesce(maps, F.array(F.lit(None)))).alias("record"))
    names = F.map_keys("record")
    whole = F.col("record").isNotNull() & (F.size(F.array_distinct(names)) == F.size(names))
    cells = records.select(whole.alias("whole"), F.explode_outer("record").alias("name", "text"))
    flat = F.col("whole") & ~F.coalesce(F.col("text").rlike(r"^[\[{]"), F.lit(False))
    found = cells.groupBy("name").agg(F.min(flat).alias("flat")).collect()
    known = sorted(r["name"] for r in found if r["name"] is not None)
    return known if all(r["flat"] for r in found) and len({n.lower() for n in known}) == len(known) else []


def read_json(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A list of records, a dictionary of arrays, or a dictionary of index maps.

    A known column list spares the pass that finds the keys of records. A document is read as one line that
    ends with the file: from such a buffer numbers are cut out as they are written, while the
    ``multiLine`` reader seeks in the file for each of them and finds keys in a few large tasks.
    """
    shape, names = _json_shape(spark, path)
    reader = spark.read.option("lineSep", NO_LINE_END)
    if shape == "records":
        columns = columns or _record_names(spark, path)
        if columns:
            return reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).json(path)
        return reader.option("primitivesAsString", True).json(path)
    inner = "array<string>" if shape == "arrays" else "map<string,string>"
    wide = reader.schema(", ".join(f"`{n}` {inner}" for n in names)).json(path)
    if shape == "arrays":
        sizes = F.array_distinct(F.array(*[F.size(n) for n in names]))
        zipped = F.when(F.size(sizes) == 1, F.arrays_zip(*names)).otherwise(
            F.raise_error("columns of different length")
        )
        return wide.select(F.inline(zipped))
    index = F.array_distinct(F.flatten(F.array(*[F.map_keys(n) for n in names])))
    return wide.withColumn("_index", F.explode(index)).select(
        *[F.try_element_at(F.col(n), F.col("_index")).alias(n) for n in names]
    )


def read_workbook(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """First sheet of every workbook at ``path``; a task reads one workbook at a
    time and its columns are matched by header name."""
    return workbook_rows(spark.read.format("binaryFile").load(path), columns, path)


def workbook_rows(files: DataFrame, columns: list[str] | None = None, path: str = "workbooks") -> DataFrame:
    """Rows of the first sheet of every workbook of a table with ``path`` and ``content``."""
    if columns is None:

        def header(batches):
            for batch in batches:
                for path, content in zip(batch["path"], batch["content"], strict=True):
                    first = next(sheet_rows(content), {})
                    titles = [first[i] for i in sorted(first)]
                    yield pd.DataFrame({"path": path, "place": range(len(titles)), "name": titles})

        # The columns of all workbooks, in the order in which the first of them has each.
        found = files.select("path", "content").mapInPandas(header, "path string, place int, name string")
        first = found.groupBy("name").agg(F.min(F.struct("path", "place")).alias("first"))
        columns = [r["name"] for r in first.orderBy("first").collect()]
    names = list(columns)
    if not names:
        raise ValueError(f"no columns in '{path}'")

    def parse(batches):
        for batch in batches:
            for content in batch["content"]:
                rows = sheet_rows(content)
                place = {title: i for i, title in next(rows, {}).items()}
                held = []
                for row in rows:
                    held.append([row.get(place[n]) if n in place else None for n in names])
                    if len(held) == SHEET_BATCH:
                        yield pd.DataFrame(held, columns=names, dtype=object)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=names, dtype=object)

    return files.select("content").mapInPandas(parse, ", ".join(f"`{n}` string" for n in names))


def _no_xls(spark: SparkSession, path: str) -> DataFrame:
    raise ValueError(f"'{path}': save legacy .xls workbooks as .xlsx first")


READERS = {
    ".csv": read_delimited,
    ".txt": read_delimited,
    ".json": read_json,
    ".xlsx": read_workbook,
    ".xls": _no_xls,
} | dict.fromkeys(PACKED, read_delimited)


def suffix_of(path: str) -> str:
    for suffix in (*SUPPORTED_SUFFIXES, *PACKED):
        if path.endswith(suffix):
            return suffix
    raise ValueError(f"unknown file type '{path}'; supported: {', '.join((*SUPPORTED_SUFFIXES, *PACKED))}")


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """Read by suffix. A missing or zero-byte file is an error."""
    reader = READERS[suffix_of(path)]
    if "*" not in path and not storage.exists(spark, path):
        raise FileNotFoundError(path)
    empty = storage.empty_files(spark, path)
    if empty:
        raise ValueError(f"empty file: {', '.join(empty)}")
    return reader(spark, path)


def extract(spark: SparkSession, path: str) -> DataFrame | None:
    """``read_file``, but an unreadable file is logged and gives nothing."""
    try:
        return read_file(spark, path)
    except Exception:
        logger.exception("cannot read %s", path)
        return None


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(folder)
    return files.filter(has_suffix(F.col("path"), (*SUPPORTED_SUFFIXES, *PACKED))).select("path", "modificationTime")


def newest_file(spark: SparkSession, folder: str) -> str | None:
    """The supported file that changed last; of several at one time, the last by name. Contents are not read."""
    return _listing(spark, folder).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()["path"]


def newest_drop(spark: SparkSession, folder: str) -> str | None:
    """The newest drop of a folder: a supported file, or all part files of a sub-folder as a pattern.

    Part files of one writer are one drop, however many tasks wrote them.
    """
    root = storage.qualified(spark, folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    inner = F.expr(f"substring(path, {len(root) + 2})")
    parts = files.filter(has_suffix(F.col("path"), (*SUPPORTED_SUFFIXES, *PACKED))).select("path", "modificationTime", inner.alias("inner"))
    entry = F.when(F.instr("inner", "/") > 0, F.substring_index("inner", "/", 1))
    suffix = F.regexp_extract("path", r"(\.[^./]*(\.gz)?)$", 1)
    drops = parts.select("path", "modificationTime", entry.alias("entry"), suffix.alias("suffix"))
    pattern = F.when(F.col("entry").isNull(), F.col("path")).otherwise(F.concat(F.lit(f"{root}/"), "entry", F.lit("/*"), "suffix"))
    newest = drops.select(pattern.alias("drop"), "modificationTime").groupBy("drop").agg(F.max("modificationTime").alias("at"))
    return newest.agg(F.max_by("drop", F.struct("at", "drop")).alias("drop")).first()["drop"]


def newest_files(spark: SparkSession, folder: str, n: int) -> DataFrame:
    return _listing(spark, folder).orderBy(F.desc("modificationTime"), "path").limit(n)
