import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick import schema
from derrick.operators import clean
from derrick.plans.jobs import load_frames


def test_dates_bad_text_is_null(spark):
    df = spark.createDataFrame([("2020-01-02",), ("2020-01-02 10:00:00",), ("junk",), (None,)], "DATEPRD string")
    got = [r[0] for r in clean.parse_date(df, "DATEPRD").select("DAYTIME").collect()]
    assert got == [dt.date(2020, 1, 2), dt.date(2020, 1, 2), None, None]
    assert clean.drop_null(clean.parse_date(df, "DATEPRD"), ["DAYTIME"]).count() == 2


def test_strict_cast_raises_and_lenient_gives_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.strict_numeric(df, ["a"]).collect()
    assert [r[0] for r in clean.lenient_numeric(df, ["a"]).collect()] == [1.5, None]


def test_present_columns_only(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    assert clean.present(df, ["b", "z", "a"]) == ["b", "a"]
    assert clean.strict_numeric(df, ["a", "zz"]).dtypes == [("a", "double"), ("b", "string")]


def test_nulls_nans_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None, "t"), (float("nan"), None, None)], "a double, b double, c string")
    plain = clean.nan_to_null(df)
    assert [r["a"] for r in plain.collect()] == [1.0, None]
    assert clean.all_null_columns(plain) == ["b"]
    assert clean.drop_all_null(plain).columns == ["a", "c"]
    assert {r["column"]: r["nulls"] for r in clean.null_audit(plain, ["a", "b"]).collect()} == {"a": 1, "b": 2}
    assert [r["c"] for r in clean.text_cast(plain, ["c"]).collect()] == ["t", None]


def test_required_and_optional_columns(spark):
    shape = T.StructType([T.StructField("k", T.LongType()), T.StructField("o", T.DoubleType())])
    with pytest.raises(ValueError, match="missing: k"):
        clean.conform(spark.createDataFrame([(1.0,)], "o double"), shape, ["k"])
    row = clean.conform(spark.createDataFrame([(1, 2)], "k int, x int"), shape, ["k"]).first()
    assert (row["k"], row["o"]) == (1, None)


def test_decimals_round_half_away_and_overflow_raises(spark):
    df = spark.createDataFrame([(1.005, 2.0005), (-1.005, None)], "a double, b double")
    got = clean.quantise(df, {"a": schema.READING_TYPE, "b": schema.VOLUME_TYPE}).collect()
    assert [tuple(r) for r in got] == [(Decimal("1.01"), Decimal("2.001")), (Decimal("-1.01"), None)]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        clean.quantise(df.select(F.lit(1e9).alias("a")), {"a": schema.READING_TYPE}).collect()


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError, match="no rows"):
        clean.require_rows(spark.createDataFrame([], "a int"))


def test_names_features_tags_and_aliases(spark):
    df = clean.upper_names(spark.createDataFrame([(1, 2.0, 3.0)], "daytime int, oil_vol double, x double"))
    assert df.columns == ["DAYTIME", "OIL_VOL", "X"]
    assert clean.feature_columns(df, ["OIL_VOL"]) == ["DAYTIME", "X"]
    assert clean.tag_rows(df, id_model="m").first()["id_model"] == "m"
    assert clean.resolve_alias(df, ["nope", "X"]) == "X"
    assert clean.resolve_alias(df, ["nope"]) is None


def test_stage_counts_share_a_scan(spark):
    df = spark.range(10)
    rows = clean.stage_counts({"all": (df, None), "even": (df, F.col("id") % 2 == 0)}).collect()
    assert {r["stage"]: r["row_count"] for r in rows} == {"all": 10, "even": 5}


def test_load_frames_need_every_descriptor(spark):
    row = {"DAYTIME": dt.date(2020, 1, 1), "WELL_BORE_CODE": "w", "BORE_OIL_VOL": 1.0}
    with pytest.raises(ValueError, match="NPD_WELL_BORE_CODE"):
        load_frames(spark.createDataFrame([row]))
    full = spark.createDataFrame([row | {c: "t" for c in schema.DESCRIPTORS}])
    frames = load_frames(full)
    assert frames["objects"].columns == schema.OBJECTS.fieldNames()
    assert frames["pwell_data"].schema == schema.PWELL_DATA


def test_tables_are_created_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS derrick_test")
    names = schema.create_tables(spark, "derrick_test")
    schema.create_tables(spark, "derrick_test")
    assert spark.table("derrick_test.pwell_data").schema == schema.PWELL_DATA
    assert len(names) == len(schema.TABLES)
    spark.sql("DROP DATABASE derrick_test CASCADE")
