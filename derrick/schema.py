"""Column lists, table schemas and keys of the production tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The column names and decimal types of the production tables.
READINGS = [
    "ON_STREAM_HRS",
    "AVG_DOWNHOLE_PRESSURE",
    "AVG_DOWNHOLE_TEMPERATURE",
    "AVG_DP_TUBING",
    "AVG_ANNULUS_PRESS",
    "AVG_CHOKE_SIZE_P",
    "AVG_WHP_P",
    "AVG_WHT_P",
    "DP_CHOKE_SIZE",
]
VOLUMES = ["BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL", "BORE_WI_VOL"]
TEXTS = [
    "AVG_CHOKE_UOM",
    "FLOW_KIND",
    "NPD_WELL_BORE_CODE",
    "NPD_WELL_BORE_NAME",
    "NPD_FIELD_CODE",
    "NPD_FIELD_NAME",
    "WELL_TYPE",
    "WELL_BORE_CODE",
]
DESCRIPTORS = [
    "NPD_WELL_BORE_CODE",
    "NPD_WELL_BORE_NAME",
    "NPD_FIELD_CODE",
    "NPD_FIELD_NAME",
    "WELL_TYPE",
]
FLUIDS = {"OIL": "BORE_OIL_VOL", "GAS": "BORE_GAS_VOL", "WAT": "BORE_WAT_VOL"}
TARGETS = ["OIL_VOL", "GAS_VOL", "WAT_VOL"]
NUMERICS = READINGS + VOLUMES

READING_SCALE = 2
VOLUME_SCALE = 3
READING_TYPE = T.DecimalType(10, READING_SCALE)
VOLUME_TYPE = T.DecimalType(14, VOLUME_SCALE)

KEY = ["DAYTIME", "WELL_BORE_CODE"]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_text, _day, _real = T.StringType(), T.DateType(), T.DoubleType()

# A raw daily file: everything arrives as text and is cast by the clean step.
RAW_WELL = _struct(("DATEPRD", _text), *[(c, _text) for c in TEXTS], *[(c, _text) for c in NUMERICS])

OBJECTS = _struct(("DAYTIME", _day), ("WELL_BORE_CODE", _text), *[(c, _text) for c in DESCRIPTORS])

PWELL_DATA = _struct(
    ("DAYTIME", _day),
    ("WELL_BORE_CODE", _text),
    *[(c, READING_TYPE) for c in READINGS],
    ("AVG_CHOKE_UOM", _text),
    *[(c, VOLUME_TYPE) for c in VOLUMES],
    ("FLOW_KIND", _text),
)

# Sums and counts per day, kept beside ``pwell_data``.
DAILY_TOTALS = _struct(
    ("DAYTIME", _day),
    ("n_rows", T.LongType()),
    *[(c, T.DecimalType(38, READING_SCALE)) for c in READINGS],
    *[(c, T.DecimalType(38, VOLUME_SCALE)) for c in VOLUMES],
    *[(f"{c}_n", T.LongType()) for c in NUMERICS],
)

# Where a row comes from: its drop, the file, the part of the file and the line. Fields are compared in this order.
VERSION = "_version"
VERSION_TYPE = T.StructType(
    [
        T.StructField("drop_time", T.TimestampType()),
        T.StructField("file_time", T.TimestampType()),
        T.StructField("file", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("line", T.LongType()),
    ]
)
# The file of a row. Where Spark cuts a file into parts, and so the numbers of lines, may differ from one reading to the next.
VERSION_SOURCE = ["drop_time", "file_time", "file"]

MODEL_AI = _struct(
    ("id_model", _text),
    ("model_type", _text),
    ("DAYTIME", _day),
    *[(f"{t}_test", _real) for t in TARGETS],
    *[(f"{t}_pred", _real) for t in TARGETS],
)

MODEL_PF = _struct(
    ("id_model", _text), ("model_type", _text), ("DAYTIME", _day), *[(t, _real) for t in TARGETS]
)

# One shape for every model family: the parameters differ, so they are a map.
MODEL_PARAMS = _struct(
    ("id_model", _text),
    ("algo", _text),
    ("created_at", T.TimestampType()),
    ("params", T.MapType(_text, _text)),
    ("metrics", T.MapType(_text, _real)),
    ("model_path", _text),
)

ML_RUNS = _struct(("run_id", _text), ("run_datetime", T.TimestampType()), ("comment", _text))
ML_RESULTS = _struct(("run_id", _text), ("target", _text), ("rmse", _real), ("mae", _real), ("r2", _real))
ML_PARAMS = _struct(("run_id", _text), ("target", _text), ("param", _text), ("value", _text))
ML_PREDICTIONS = _struct(
    ("run_id", _text),
    ("target", _text),
    ("y_true", _real),
    ("y_pred", _real),
    ("sample_type", _text),
    ("created_at", T.TimestampType()),
)

TABLES = {
    "objects": OBJECTS,
    "pwell_data": PWELL_DATA,
    "model_ai": MODEL_AI,
    "model_pf": MODEL_PF,
    "model_params": MODEL_PARAMS,
    "ml_runs": ML_RUNS,
    "ml_results": ML_RESULTS,
    "ml_params": ML_PARAMS,
    "ml_predictions": ML_PREDICTIONS,
}


def create_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create every table that is absent; existing ones are left alone."""
    prefix = f"{database}." if database else ""
    for name, schema in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({columns}) USING parquet")
    return [prefix + name for name in TABLES]
