"""Queries that land rows of the given tables as files or tables and read them back."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.functions.scalars import as_json, new_id, stamp_text
from derrick.operators import clean
from derrick.plans.oracle import over
from derrick.plans.queries_tables import as_doubles, predictions
from derrick.plans.registry import query
from derrick.plans.wells import clean_wells, production, raw_view, read_table
from derrick.schema import KEY, PWELL_DATA, READING_TYPE, READINGS, VOLUME_TYPE, VOLUMES, create_tables
from derrick.session import shared_folder
from derrick.sinks.export import export_predictions, land_csv
from derrick.sinks.runs import append, create_run, metric_rows, prediction_rows
from derrick.sinks.upsert import read_table as stored_table
from derrick.sinks.upsert import upsert
from derrick.sources import storage
from derrick.sources.files import extract, newest_drop, newest_files, read_file, read_json, workbook_rows
from derrick.sources.tables import scan_path
from derrick.sources.workbook import workbook_bytes

SHAPE = ["DATEPRD", "WELL_BORE_CODE", "WELL_TYPE", "BORE_OIL_VOL"]
DOCUMENT_ROWS = 10_000
LANDED = over("well_raw", body="SELECT DATEPRD, WELL_BORE_CODE, WELL_TYPE, BORE_OIL_VOL FROM well_raw")


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/derrick-{new_id()}"


def _rows(spark, folder) -> DataFrame:
    return raw_view(spark, folder).select(*SHAPE)


def _typed(read: DataFrame) -> DataFrame:
    return read.select(*SHAPE).withColumn("BORE_OIL_VOL", F.col("BORE_OIL_VOL").cast("double"))


@query("s1_k1_csv_scan", LANDED)
def s1(spark, folder):
    path = _scratch(spark)
    land_csv(_rows(spark, folder).repartition(3), path)
    return _typed(read_file(spark, f"{path}/*.csv"))


@query("s2_s6_txt_scan", LANDED)
def s2(spark, folder):
    path = _scratch(spark)
    _rows(spark, folder).write.option("header", True).option("extension", "txt").csv(path)
    return _typed(read_file(spark, f"{path}/*.txt"))


def _one_document_per_file(documents: DataFrame, path: str) -> None:
    """A text file per row; a row holds about ``DOCUMENT_ROWS`` rows of a well."""
    documents.write.option("maxRecordsPerFile", 1).text(path)


def _documents(raw: DataFrame, size: int = DOCUMENT_ROWS) -> DataFrame:
    """The rows of each well in arrays of about ``size``, so that a well with many rows is many documents."""
    parts = raw.groupBy("WELL_BORE_CODE").agg(F.ceil(F.count("*") / size).alias("parts")).withColumnRenamed("WELL_BORE_CODE", "well")
    dealt = raw.join(parts, F.col("WELL_BORE_CODE").eqNullSafe(F.col("well")))
    part = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.col("parts")).alias("part")
    return dealt.groupBy("WELL_BORE_CODE", part).agg(F.collect_list(F.struct(*SHAPE)).alias("rows"))


@query("s3_json_records", LANDED)
def s3(spark, folder):
    path = _scratch(spark)
    wells = _documents(raw_view(spark, folder))
    _one_document_per_file(wells.select(as_json(F.col("rows"))), path)
    return _typed(read_json(spark, path))


@query("s4_json_columns", LANDED)
def s4(spark, folder):
    path = _scratch(spark)
    wells = _documents(raw_view(spark, folder))
    columns = F.struct(*[F.col("rows").getField(c).alias(c) for c in SHAPE])
    _one_document_per_file(wells.select(as_json(columns)), path)
    return _typed(read_json(spark, path))


def _workbooks(documents: DataFrame) -> DataFrame:
    """A workbook per document as ``path`` and ``content``; dates become date cells, the columns' order changes from one to the next."""

    def build(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one document at a time as Python objects
                well, part, rows = (batch.column(c)[i].as_py() for c in ("WELL_BORE_CODE", "part", "rows"))
                titles = SHAPE if part % 2 else SHAPE[::-1]
                cells = []
                for row in rows:
                    try:
                        day = dt.date.fromisoformat(row["DATEPRD"])
                    except ValueError:
                        day = row["DATEPRD"]
                    values = {**row, "DATEPRD": day}
                    cells.append([values[c] for c in titles])
                book = [f"{well}-{part}.xlsx"], [workbook_bytes([titles, *cells])]
                yield pa.RecordBatch.from_arrays([pa.array(book[0], pa.string()), pa.array(book[1], pa.binary())], names=["path", "content"])

    return documents.mapInArrow(build, "path string, content binary")


@query("s5_workbook_scan", LANDED)
def s5(spark, folder):
    """The rows of each well as workbooks of bounded size, kept in a table and read by header names."""
    path = _scratch(spark)
    _workbooks(_documents(raw_view(spark, folder))).write.parquet(path)
    return _typed(workbook_rows(spark.read.parquet(path)))


_observed = ["ON_STREAM_HRS", "AVG_ANNULUS_PRESS", "BORE_OIL_VOL", "BORE_WI_VOL"]


@query(
    "a13_p14_observed_load",
    over(
        "clean",
        body="SELECT 'row_count' AS name, COUNT(*) AS found FROM clean UNION ALL "
        + " UNION ALL ".join(f"SELECT '{c}', COUNT(*) - COUNT({c}) FROM clean" for c in _observed),
    ),
)
def a13_observed(spark, folder):
    """Rows and nulls of the cleaned rows, counted by the write that stores them."""
    rows, found = clean.observed(clean_wells(raw_view(spark, folder)), _observed)
    rows.write.parquet(_scratch(spark))
    return spark.createDataFrame([(n, found.get[n]) for n in ("row_count", *_observed)], "name string, found long")


@query("s8_newest_drop", over("well_raw", body="SELECT DATEPRD, WELL_BORE_CODE, WELL_TYPE, BORE_OIL_VOL FROM well_raw WHERE l_orderkey % 2 = 1"))
def s8(spark, folder):
    """Two drops of several part files each; all parts of the later one are read."""
    path = _scratch(spark)
    raw = raw_view(spark, folder)
    for parity in (0, 1):
        land_csv(raw.filter(F.col("l_orderkey") % 2 == parity).select(*SHAPE).repartition(4), f"{path}/drop{parity}")
    return _typed(read_file(spark, newest_drop(spark, path)))


@query("o6_newest_files", "SELECT CAST(count(DISTINCT l_linenumber) AS BIGINT) AS files FROM lineitem")
def o6(spark, folder):
    """A file per line number; the newest are listed without reading them."""
    path = _scratch(spark)
    read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").repartitionByRange(16, "l_linenumber").write.partitionBy("l_linenumber").option("header", True).csv(path)
    return newest_files(spark, f"{path}/*", 100).agg(F.countDistinct(F.regexp_extract("path", "l_linenumber=([0-9]+)", 1)).alias("files"))


@query("s9_table_scan", over("pwell", body=f"SELECT {', '.join([*KEY, *VOLUMES, 'FLOW_KIND'])} FROM pwell"))
def s9(spark, folder):
    path = _scratch(spark)
    stored = production(spark, folder).select(*KEY, *VOLUMES, "FLOW_KIND")
    stored.write.parquet(path)
    return as_doubles(scan_path(spark, path, stored.schema), VOLUMES)


@query(
    "s7_empty_file",
    "SELECT 'filled' AS drop_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM customer UNION ALL SELECT 'with an empty part', NULL",
)
def s7(spark, folder):
    """A drop that reads, and one with a file of no bytes beside the rows, which is refused."""
    home = _scratch(spark)
    rows = read_table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name")
    counts = []
    for name in ("filled", "with an empty part"):
        path = land_csv(rows, f"{home}/{name.replace(' ', '_')}")
        if name != "filled":
            storage.publish_text(spark, "", f"{path}/part-99999-empty.csv")
        found = extract(spark, f"{path}/*.csv")
        counts.append((name, None if found is None else found.count()))
    return spark.createDataFrame(counts, "drop_name string, row_count long")


@query("k11_created_tables", over("pwell", body=f"SELECT {', '.join([*KEY, *VOLUMES])} FROM pwell"))
def k11(spark, folder):
    """All tables created in a database of their own, creating them again changes nothing; rows inserted into one are read back."""
    database = f"derrick_{new_id().replace('-', '')}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_scratch(spark)}'")
    names = create_tables(spark, database)
    stored = production(spark, folder)
    columns = [f.name for f in PWELL_DATA.fields]
    stored.select(*columns).write.insertInto(f"{database}.pwell_data")
    if create_tables(spark, database) != names or any(spark.table(n).count() for n in names if not n.endswith(".pwell_data")):
        raise RuntimeError("tables were changed")
    return as_doubles(spark.table(f"{database}.pwell_data").select(*KEY, *VOLUMES), VOLUMES)


@query(
    "k6_stored_params",
    "SELECT 'W-' || CAST(l_suppkey AS VARCHAR) AS id_model, CAST(max(l_partkey) AS VARCHAR) AS top, "
    "CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY l_suppkey",
)
def k6(spark, folder):
    """Parameters of a model per well, stored twice under the same ids; the second set counts."""
    home = _scratch(spark)
    lines = read_table(spark, folder, "lineitem")
    for keep in (F.col("l_orderkey") % 2 == 0, F.lit(True)):
        per_well = lines.filter(keep).groupBy("l_suppkey").agg(F.max("l_partkey").alias("top"), F.count("*").alias("n"))
        rows = per_well.select(
            F.concat(F.lit("W-"), F.col("l_suppkey").cast("string")).alias("id_model"),
            F.lit("LinearRegression").alias("algo"),
            F.current_timestamp().alias("created_at"),
            F.create_map(F.lit("top"), F.col("top").cast("string")).alias("params"),
            F.create_map(F.lit("n"), F.col("n").cast("double")).alias("metrics"),
            F.lit(None).cast("string").alias("model_path"),
        )
        upsert(spark, home, "model_params", rows)
    return stored_table(spark, home, "model_params").select("id_model", F.col("params")["top"].alias("top"), F.col("metrics")["n"].alias("n"))


@query(
    "k7_k8_k10_run_log",
    over("model_ai", body="SELECT 'run' AS comment, 3 * COUNT(*) AS predictions, CAST(3 AS BIGINT) AS metrics, CAST(1 AS BIGINT) AS runs FROM model_ai"),
)
def k7(spark, folder):
    """A run with its metrics and predictions, appended and joined again by its id."""
    home = _scratch(spark)
    rows = predictions(spark, folder)
    run_id = create_run(spark, f"{home}/runs", "run")
    create_run(spark, f"{home}/runs", "another run")
    append(prediction_rows(run_id, rows), f"{home}/predictions")
    append(metric_rows(run_id, rows), f"{home}/metrics")
    count = lambda name, alias: spark.read.parquet(f"{home}/{name}").groupBy("run_id").agg(F.count("*").alias(alias))
    runs = spark.read.parquet(f"{home}/runs").filter("comment = 'run'").select("run_id", "comment")
    joined = runs.join(count("predictions", "predictions"), "run_id").join(count("metrics", "metrics"), "run_id")
    return joined.groupBy("comment", "predictions", "metrics").agg(F.count("*").alias("runs"))


@query("k12_csv_export", over("model_ai", body="SELECT model_type, DAYTIME, OIL_VOL_test, OIL_VOL_pred FROM model_ai"))
def k12(spark, folder):
    home = _scratch(spark)
    upsert(spark, home, "model_ai", predictions(spark, folder))
    path = export_predictions(spark, home, f"{home}/out")
    schema = "model_type string, DAYTIME date, OIL_VOL_test double, OIL_VOL_pred double"
    read = spark.read.option("header", True).csv(path)
    return read.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema).fields])


# ---------------------------------------------------------------- cleaning steps of a load


@query(
    "p4_p10_strict_numbers",
    over("clean", body="SELECT l_orderkey, l_linenumber, AVG_WHP_P, DP_CHOKE_SIZE, BORE_GAS_VOL FROM clean"),
)
def p4(spark, folder):
    """Numbers arrive as text, are cast strictly and rounded to their stored types."""
    names = ["AVG_WHP_P", "DP_CHOKE_SIZE", "BORE_GAS_VOL"]
    raw = clean.drop_null(clean.parse_date(raw_view(spark, folder), "DATEPRD"), ["DAYTIME"])
    texts = raw.withColumns({c: F.format_string("%.9f", c) for c in names})
    types = {c: READING_TYPE for c in READINGS} | {c: VOLUME_TYPE for c in VOLUMES}
    typed = clean.quantise(clean.strict_numeric(texts, clean.present(texts, names)), {c: types[c] for c in names})
    return as_doubles(typed.select("l_orderkey", "l_linenumber", *names), names)


@query(
    "p9_f14_conform",
    over("clean", body="SELECT DAYTIME, WELL_BORE_CODE, CAST(NULL AS DOUBLE) AS AVG_WHP_P, BORE_OIL_VOL, FLOW_KIND FROM clean"),
)
def p9(spark, folder):
    """A missing optional column is stored as null, a missing required one would be an error."""
    raw = clean.drop_null(clean.parse_date(raw_view(spark, folder), "DATEPRD"), ["DAYTIME"])
    stored = clean.conform(clean.require_rows(raw).drop("AVG_WHP_P"), PWELL_DATA, KEY)
    return as_doubles(stored.select(*KEY, "AVG_WHP_P", "BORE_OIL_VOL", "FLOW_KIND"), ["AVG_WHP_P", "BORE_OIL_VOL"])


@query("p12_p13_upper_features", 'SELECT c_custkey AS "C_CUSTKEY", c_acctbal AS "C_ACCTBAL" FROM customer')
def p12(spark, folder):
    named = clean.upper_names(read_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal"))
    return named.select("C_CUSTKEY", *clean.feature_columns(named, ["C_NATIONKEY"], ("C_CUSTKEY",)))


@query("p16_alias", over("model_ai", body="SELECT DAYTIME, OIL_VOL_pred AS predicted FROM model_ai"))
def p16(spark, folder):
    rows = predictions(spark, folder)
    return rows.select("DAYTIME", F.col(clean.resolve_alias(rows, ["OIL_pred", "OIL_VOL_pred", "OIL_VOL_test"])).alias("predicted"))


@query("f5_stamp_text", "SELECT event_id, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS stamp FROM events")
def f5(spark, folder):
    return read_table(spark, folder, "events").select("event_id", stamp_text(F.col("ts")).alias("stamp"))


@query(
    "f11_as_json",
    """SELECT o_orderkey, '{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_orderstatus":"' || o_orderstatus || '"}' AS document FROM orders""",
)
def f11(spark, folder):
    return read_table(spark, folder, "orders").select("o_orderkey", as_json(F.struct("o_orderkey", "o_orderstatus")).alias("document"))


@query("f12_row_ids", "SELECT COUNT(*) AS row_count, COUNT(*) AS ids, CAST(1 AS BIGINT) AS run_ids FROM orders")
def f12(spark, folder):
    rows = read_table(spark, folder, "orders").select(F.expr("uuid()").alias("id"), F.lit(new_id()).alias("run_id"))
    return rows.agg(F.count("*").alias("row_count"), F.countDistinct("id").alias("ids"), F.countDistinct("run_id").alias("run_ids"))
