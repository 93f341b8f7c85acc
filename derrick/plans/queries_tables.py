"""Queries over the production tables: scans, cleaning, aggregates, upserts, reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.functions import scalars
from derrick.functions.exact import significant, total
from derrick.operators import clean, metrics, relate, report
from derrick.operators.aggregate import daily_avg, daily_sum, last_date
from derrick.operators.forecast import persistence
from derrick.operators.window import latest_per_key, tail, with_index
from derrick.plans import oracle
from derrick.plans.oracle import over
from derrick.plans.registry import query
from derrick.plans.wells import SEQUENCE, clean_wells, production, raw_view, read_table
from derrick.schema import DESCRIPTORS, KEY, NUMERICS, READINGS, TARGETS, TEXTS, VOLUMES
from derrick.session import cut_lineage
from derrick.sources.tables import point_lookup, run_sql


def as_doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def daily_sums(spark: SparkSession, folder: str) -> DataFrame:
    return daily_sum(production(spark, folder))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return persistence(daily_sums(spark, folder))


# ---------------------------------------------------------------- sources

STORED = [*KEY, *NUMERICS, "AVG_CHOKE_UOM", "FLOW_KIND"]


@query("s9_full_scan", over("pwell", body=f"SELECT {', '.join(STORED)} FROM pwell"))
def full_scan(spark, folder):
    return as_doubles(production(spark, folder).select(*STORED), NUMERICS)


@query(
    "s10_sql_text",
    over(
        "pwell",
        body="SELECT WELL_BORE_CODE, COUNT(*) AS days, MIN(DAYTIME) AS first_day, MAX(DAYTIME) AS last_day, "
        f"{oracle.fixed_sum('BORE_OIL_VOL', 3, 'oil')} FROM pwell WHERE FLOW_KIND = 'production' "
        "AND DAYTIME >= DATE '1997-01-01' GROUP BY WELL_BORE_CODE",
    ),
)
def sql_text(spark, folder):
    return run_sql(
        spark,
        """SELECT WELL_BORE_CODE, COUNT(*) AS days, MIN(DAYTIME) AS first_day, MAX(DAYTIME) AS last_day,
                  CAST(SUM(BORE_OIL_VOL) AS DOUBLE) AS oil
           FROM {pwell_data} WHERE FLOW_KIND = :kind AND DAYTIME >= :since GROUP BY WELL_BORE_CODE""",
        args={"kind": "production", "since": dt.date(1997, 1, 1)},
        pwell_data=production(spark, folder),
    )


@query(
    "s11_point_lookup",
    over(
        "model_ai",
        body="SELECT id_model, model_type, COUNT(*) AS days, MAX(DAYTIME) AS last_day FROM model_ai "
        "WHERE id_model = 'persistence' GROUP BY id_model, model_type",
    ),
)
def lookup(spark, folder):
    models = predictions(spark, folder).groupBy("id_model", "model_type").agg(
        F.count(F.lit(1)).alias("days"), F.max("DAYTIME").alias("last_day")
    )
    return point_lookup(models, id_model="persistence")


# ---------------------------------------------------------------- cleaning


@query(
    "p1_parse_date",
    over(
        "well_raw",
        body="SELECT DATEPRD, TRY_CAST(DATEPRD AS DATE) AS DAYTIME, COUNT(*) AS row_count FROM well_raw GROUP BY 1, 2",
    ),
)
def parse_date(spark, folder):
    dated = clean.parse_date(raw_view(spark, folder), "DATEPRD")
    return dated.groupBy("DATEPRD", "DAYTIME").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "p2_drop_null_date",
    over("well_raw", body="SELECT WELL_BORE_CODE, COUNT(*) AS row_count FROM well_raw WHERE TRY_CAST(DATEPRD AS DATE) IS NOT NULL GROUP BY 1"),
)
def drop_null_date(spark, folder):
    dated = clean.drop_null(clean.parse_date(raw_view(spark, folder), "DATEPRD"), ["DAYTIME"])
    return dated.groupBy("WELL_BORE_CODE").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "p5_lenient_numeric",
    over(
        "well_raw",
        body="SELECT DATEPRD, TRY_CAST(REPLACE(DATEPRD, '-', '') AS DOUBLE) AS number, COUNT(*) AS row_count "
        "FROM well_raw GROUP BY 1, 2",
    ),
)
def lenient_numeric(spark, folder):
    texts = raw_view(spark, folder).withColumn("number", F.regexp_replace("DATEPRD", "-", ""))
    numbers = clean.lenient_numeric(texts, ["number"])
    return numbers.groupBy("DATEPRD", "number").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "p6_text_cast",
    over(
        "well_raw",
        body="SELECT WELL_TYPE, NPD_FIELD_CODE, FLOW_KIND, COUNT(*) AS row_count FROM well_raw GROUP BY 1, 2, 3",
    ),
)
def text_cast(spark, folder):
    texts = clean.text_cast(raw_view(spark, folder), TEXTS)
    return texts.groupBy("WELL_TYPE", "NPD_FIELD_CODE", "FLOW_KIND").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "p7_nan_to_null",
    "SELECT event_type, COUNT(*) AS row_count, COUNT(CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END) AS filled, "
    f"ROUND(SUM(CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END), 6) AS total FROM events GROUP BY 1",
)
def nan_to_null(spark, folder):
    events = read_table(spark, folder, "events")
    gaps = events.withColumn("value", F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    filled = clean.nan_to_null(gaps, ["value"])
    return filled.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("value").alias("filled"), F.round(total("value"), 6).alias("total")
    )


@query(
    "p8_drop_all_null",
    over(
        "clean",
        body="SELECT column_name, COUNT(*) AS row_count FROM (UNPIVOT (SELECT "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in [*READINGS, *VOLUMES])
        + " FROM clean) ON COLUMNS(*) INTO NAME column_name VALUE v) u WHERE v IS NOT NULL GROUP BY 1",
    ),
)
def drop_all_null(spark, folder):
    kept = clean.drop_all_null(clean_wells(raw_view(spark, folder)).select(*READINGS, *VOLUMES))
    return clean.filled_counts(kept).unpivot([], kept.columns, "column_name", "row_count")


@query(
    "a3_all_null_columns",
    over(
        "clean",
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT({c}) = 0 AS all_null FROM clean" for c in NUMERICS
        ),
    ),
)
def all_null_test(spark, folder):
    empty = clean.all_null_columns(clean_wells(raw_view(spark, folder)), NUMERICS)
    return spark.createDataFrame([(c, c in empty) for c in NUMERICS], "column_name string, all_null boolean")


@query(
    "p14_null_audit",
    over(
        "pwell",
        body=" UNION ALL ".join(
            f'SELECT \'{c}\' AS "column", COUNT(*) - COUNT({c}) AS nulls FROM pwell' for c in NUMERICS
        ),
    ),
)
def null_audit(spark, folder):
    return clean.null_audit(production(spark, folder), NUMERICS)


@query(
    "p15_tag_rows",
    over(
        "daily_sum",
        body="SELECT DAYTIME, OIL_VOL, GAS_VOL, WAT_VOL, 'fixed-id' AS id_model, 'LR' AS model_type FROM daily_sum",
    ),
)
def tag_rows(spark, folder):
    return clean.tag_rows(daily_sums(spark, folder), id_model="fixed-id", model_type="LR")


@query(
    "a13_stage_counts",
    over(
        "pwell",
        body="SELECT 'raw' AS stage, COUNT(*) AS row_count FROM well_raw "
        "UNION ALL SELECT 'dated', COUNT(*) FROM clean UNION ALL SELECT 'stored', COUNT(*) FROM pwell",
    ),
)
def stage_counts(spark, folder):
    dated = clean.parse_date(raw_view(spark, folder), "DATEPRD")
    return clean.stage_counts(
        {
            "raw": (dated, None),
            "dated": (dated, F.col("DAYTIME").isNotNull()),
            "stored": (production(spark, folder), None),
        }
    )


# ---------------------------------------------------------------- aggregates


@query("a1_daily_avg", over("daily_avg", body="SELECT * FROM daily_avg"))
def a1(spark, folder):
    return daily_avg(production(spark, folder))


@query("a2_daily_sum", over("daily_sum", body="SELECT * FROM daily_sum"))
def a2(spark, folder):
    return daily_sums(spark, folder)


@query("a2_daily_sum_by_well", over("well_days", body="SELECT * FROM well_days"))
def a2_by_well(spark, folder):
    return daily_sum(production(spark, folder), ["WELL_BORE_CODE"])


def at_7(df, columns=None):
    """Derived doubles to 7 significant digits: the last bits follow the order of the rows."""
    return df.withColumns({c: significant(c) for c in columns or df.columns})


def _sse(t):
    return f"SUM(({t}_VOL_test - {t}_VOL_pred) * ({t}_VOL_test - {t}_VOL_pred))"


def _mse_sql(t):
    return f"{_sse(t)} / COUNT(*)"


def _r2_sql(t):
    return f"(1e0 - {_mse_sql(t)} / VAR_POP({t}_VOL_test))"


FLUIDS = ("OIL", "GAS", "WAT")


@query("a6_mse", over("model_ai", body="SELECT " + ", ".join(f"{oracle.significant(_mse_sql(t))} AS mse_{t}" for t in FLUIDS) + " FROM model_ai"))
def a6(spark, folder):
    return at_7(metrics.mse(predictions(spark, folder)))


@query(
    "a7_mse_global",
    over("model_ai", body=f"SELECT {oracle.significant('(' + ' + '.join(map(_mse_sql, FLUIDS)) + ') / 3e0')} AS mse_global FROM model_ai"),
)
def a7(spark, folder):
    return at_7(metrics.mse_global(predictions(spark, folder)))


@query("a8_r2", over("model_ai", body="SELECT " + ", ".join(f"{oracle.significant(_r2_sql(t))} AS r2_{t}" for t in FLUIDS) + " FROM model_ai"))
def a8(spark, folder):
    return at_7(metrics.r2(predictions(spark, folder)))


@query(
    "a9_r2_global",
    over("model_ai", body=f"SELECT {oracle.significant('(' + ' + '.join(map(_r2_sql, FLUIDS)) + ') / 3e0')} AS r2_global FROM model_ai"),
)
def a9(spark, folder):
    return at_7(metrics.r2_global(predictions(spark, folder)))


def _mae_sql(t):
    return f"AVG(ABS({t}_VOL_test - {t}_VOL_pred))"


@query(
    "a10_rmse_mae",
    over(
        "model_ai",
        body="SELECT "
        + ", ".join([f"{oracle.significant(f'SQRT({_mse_sql(t)})')} AS rmse_{t}" for t in FLUIDS] + [f"{oracle.significant(_mae_sql(t))} AS mae_{t}" for t in FLUIDS])
        + " FROM model_ai",
    ),
)
def a10(spark, folder):
    return at_7(metrics.rmse_mae(predictions(spark, folder)))


@query(
    "k8_metrics_long",
    over(
        "model_ai",
        body=" UNION ALL ".join(
            f"SELECT 'run-1' AS run_id, '{t}' AS target, {oracle.significant(f'SQRT({_mse_sql(t)})')} AS rmse, {oracle.significant(_mae_sql(t))} AS mae, {oracle.significant(_r2_sql(t))} AS r2 FROM model_ai"
            for t in FLUIDS
        ),
    ),
)
def k8(spark, folder):
    from derrick.sinks.runs import metric_rows

    return at_7(metric_rows("run-1", predictions(spark, folder)), ["rmse", "mae", "r2"])


@query(
    "k10_predictions_long",
    over(
        "model_ai",
        body=" UNION ALL ".join(
            f"SELECT 'run-1' AS run_id, '{t}' AS target, {t}_VOL_test AS y_true, {t}_VOL_pred AS y_pred, 'test' AS sample_type FROM model_ai"
            for t in FLUIDS
        ),
    ),
)
def k10(spark, folder):
    from derrick.sinks.runs import prediction_rows

    return prediction_rows("run-1", predictions(spark, folder)).drop("created_at")


# ---------------------------------------------------------------- upserts

MERGE_ORDER = oracle.ORDER


def _split_updates(spark, folder):
    """Rows of even orders form the table, those of odd orders and of orders divisible by 3 the update."""
    cleaned = clean_wells(raw_view(spark, folder))
    base = latest_per_key(cleaned.filter(F.col("l_orderkey") % 2 == 0), KEY, SEQUENCE)
    return base, cleaned.filter((F.col("l_orderkey") % 2 == 1) | (F.col("l_orderkey") % 3 == 0))


def _merge_sql(columns: list[str]) -> str:
    return over(
        "clean",
        body=f"SELECT {', '.join(columns)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY DAYTIME, WELL_BORE_CODE "
        f"ORDER BY side DESC, {MERGE_ORDER}) AS rn FROM (SELECT *, 0 AS side FROM clean WHERE l_orderkey % 2 = 0 "
        "UNION ALL SELECT *, 1 AS side FROM clean WHERE l_orderkey % 2 = 1 OR l_orderkey % 3 = 0) u) z WHERE rn = 1",
    )


@query("k2_upsert_objects", _merge_sql([*KEY, *DESCRIPTORS]))
def k2(spark, folder):
    base, updates = _split_updates(spark, folder)
    names = [*KEY, *DESCRIPTORS]
    return relate.merge_latest(base.select(*names), updates.select(*names, *SEQUENCE), KEY, SEQUENCE)


@query("k3_upsert_pwell", _merge_sql(STORED))
def k3(spark, folder):
    base, updates = _split_updates(spark, folder)
    merged = relate.merge_latest(base.select(*STORED), updates.select(*STORED, *SEQUENCE), KEY, SEQUENCE)
    return as_doubles(merged, NUMERICS)


@query(
    "k4_upsert_predictions",
    over(
        "model_ai",
        body="SELECT id_model, model_type, DAYTIME, OIL_VOL_test, GAS_VOL_test, WAT_VOL_test, "
        "CASE WHEN DAYTIME >= DATE '2000-01-01' THEN OIL_VOL_pred * 2 ELSE OIL_VOL_pred END AS OIL_VOL_pred, "
        "CASE WHEN DAYTIME >= DATE '2000-01-01' THEN NULL ELSE GAS_VOL_pred END AS GAS_VOL_pred, WAT_VOL_pred FROM model_ai",
    ),
)
def k4(spark, folder):
    base = predictions(spark, folder)
    recent = base.filter(F.col("DAYTIME") >= F.lit(dt.date(2000, 1, 1)))
    # Two updates of every key; the second one counts.
    first = recent.withColumn("OIL_VOL_pred", F.col("OIL_VOL_pred") * 3)
    second = recent.withColumns({"OIL_VOL_pred": F.col("OIL_VOL_pred") * 2, "GAS_VOL_pred": F.lit(None).cast("double")})
    updates = second.withColumn("seq", F.lit(2)).unionByName(first.withColumn("seq", F.lit(1)))
    return relate.merge_latest(base, updates, ["id_model", "DAYTIME"], ["seq"])


@query(
    "k5_upsert_forecasts",
    over(
        "daily_sum",
        body="SELECT 'f1' AS id_model, 'FORECAST' AS model_type, CAST(d AS DATE) AS DAYTIME, "
        "arg_max(OIL_VOL, s) AS OIL_VOL, arg_max(GAS_VOL, s) AS GAS_VOL, arg_max(WAT_VOL, s) AS WAT_VOL FROM ("
        "SELECT DAYTIME AS d, 0 AS s, OIL_VOL, GAS_VOL, WAT_VOL FROM daily_sum UNION ALL "
        "SELECT DAYTIME + 30, 1, OIL_VOL, GAS_VOL, WAT_VOL FROM daily_sum) u GROUP BY d",
    ),
)
def k5(spark, folder):
    # A row per day, read for the base and for every update: derived once.
    base = clean.tag_rows(cut_lineage(daily_sums(spark, folder)), id_model="f1", model_type="FORECAST")
    names = ["id_model", "model_type", "DAYTIME", *TARGETS]
    later = base.withColumn("DAYTIME", F.date_add("DAYTIME", 30)).select(*names)
    # Two updates of every key; the second one counts.
    updates = later.withColumn("seq", F.lit(2)).unionByName(later.withColumns({t: F.lit(0.0) for t in TARGETS} | {"seq": F.lit(1)}))
    return relate.merge_latest(base.select(*names), updates, ["id_model", "DAYTIME"], ["seq"])


# ---------------------------------------------------------------- joins and set operations


@query(
    "j2_key_join",
    over(
        "daily_sum",
        body="SELECT s.DAYTIME, s.OIL_VOL AS oil_total, a.oil_mean FROM daily_sum s JOIN (SELECT DAYTIME, "
        f"{oracle.fixed_mean('BORE_OIL_VOL', 3, 'oil_mean')} FROM pwell GROUP BY DAYTIME) a ON a.DAYTIME = s.DAYTIME",
    ),
)
def j2(spark, folder):
    table = production(spark, folder)
    sums = daily_sum(table).select("DAYTIME", F.col("OIL_VOL").alias("oil_total"))
    means = daily_avg(table).select(
        scalars.date_part(scalars.from_epoch("DAYTIME")).alias("DAYTIME"), F.col("OIL_VOL").alias("oil_mean")
    )
    return relate.join_on(sums, means, ["DAYTIME"])


@query(
    "j3_insert_if_absent",
    over(
        "clean",
        body="SELECT WELL_BORE_CODE, DAYTIME, CAST(MIN(l_orderkey) AS BIGINT) AS first_order, 0 AS origin FROM clean "
        "WHERE l_orderkey % 2 = 0 GROUP BY 1, 2 UNION ALL "
        "SELECT WELL_BORE_CODE, DAYTIME, CAST(MIN(l_orderkey) AS BIGINT), 1 FROM clean c WHERE l_orderkey % 2 = 1 AND NOT EXISTS "
        "(SELECT 1 FROM clean b WHERE b.l_orderkey % 2 = 0 AND b.DAYTIME = c.DAYTIME AND b.WELL_BORE_CODE = c.WELL_BORE_CODE) GROUP BY 1, 2",
    ),
)
def j3(spark, folder):
    cleaned = clean_wells(raw_view(spark, folder)).select("WELL_BORE_CODE", "DAYTIME", F.col("l_orderkey").alias("first_order"))
    parts = [cleaned.filter(F.col("first_order") % 2 == i).withColumn("origin", F.lit(i)) for i in (0, 1)]
    base = parts[0].groupBy("WELL_BORE_CODE", "DAYTIME", "origin").agg(F.min("first_order").alias("first_order"))
    base = base.select("WELL_BORE_CODE", "DAYTIME", "first_order", "origin")
    return relate.insert_if_absent(base, parts[1], ["WELL_BORE_CODE", "DAYTIME"], ["first_order"])


@query(
    "j4_semi_match",
    "SELECT user_id, COUNT(*) AS row_count FROM events WHERE event_type = 'click' AND user_id IN "
    "(SELECT user_id FROM events WHERE event_type = 'error') GROUP BY user_id",
)
def j4(spark, folder):
    events = read_table(spark, folder, "events").select("user_id", "event_type")
    registry = events.filter("event_type = 'error'").select("user_id", scalars.pseudonym("user_id").alias("hash"))
    clicks = events.filter("event_type = 'click'").withColumn("secret", F.col("user_id"))
    return relate.semi_match(clicks, registry, "user_id", "secret", "hash").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "u1_stack_predictions",
    over(
        "model_ai",
        body="SELECT * FROM model_ai UNION ALL SELECT 'weekly', 'WEEKLY', DAYTIME, OIL_VOL, GAS_VOL, WAT_VOL, o, g, w FROM ("
        "SELECT *, LAG(OIL_VOL, 7) OVER (ORDER BY DAYTIME) AS o, LAG(GAS_VOL, 7) OVER (ORDER BY DAYTIME) AS g, "
        "LAG(WAT_VOL, 7) OVER (ORDER BY DAYTIME) AS w, ROW_NUMBER() OVER (ORDER BY DAYTIME) AS rn FROM daily_sum) z WHERE rn > 7",
    ),
)
def u1(spark, folder):
    from derrick.operators.window import lagged

    daily = daily_sums(spark, folder)
    weekly = lagged(daily, TARGETS, 7).select(
        F.lit("weekly").alias("id_model"),
        F.lit("WEEKLY").alias("model_type"),
        "DAYTIME",
        *[F.col(t).alias(f"{t}_test") for t in TARGETS],
        *[F.col(f"{t}_lag7").alias(f"{t}_pred") for t in TARGETS],
    )
    return relate.stack_predictions([persistence(daily), weekly])


@query(
    "u2_base_and_updates",
    over(
        "clean",
        body="SELECT DAYTIME, SUM(CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE 0 END) + SUM(CASE WHEN l_orderkey % 2 = 1 OR l_orderkey % 3 = 0 THEN 1 ELSE 0 END) AS row_count, "
        "SUM(CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE 0 END) AS flow_kinds FROM clean GROUP BY DAYTIME",
    ),
)
def u2(spark, folder):
    cleaned = clean_wells(raw_view(spark, folder))
    base = cleaned.filter(F.col("l_orderkey") % 2 == 0).select(*KEY, "FLOW_KIND")
    updates = cleaned.filter((F.col("l_orderkey") % 2 == 1) | (F.col("l_orderkey") % 3 == 0)).select(*KEY)
    both = base.unionByName(updates, allowMissingColumns=True)
    return both.groupBy("DAYTIME").agg(F.count(F.lit(1)).alias("row_count"), F.count("FLOW_KIND").alias("flow_kinds"))


# ---------------------------------------------------------------- order and limits


@query("o1_order_by_epoch", over("daily_avg", body="SELECT DAYTIME, OIL_VOL FROM daily_avg ORDER BY DAYTIME"))
def o1(spark, folder):
    return daily_avg(production(spark, folder)).select("DAYTIME", "OIL_VOL").orderBy("DAYTIME")


@query("o2_sort_by_day", over("daily_sum", body="SELECT * FROM daily_sum ORDER BY DAYTIME"))
def o2(spark, folder):
    return daily_sums(spark, folder).orderBy("DAYTIME")


@query("o3_tail", over("daily_sum", body="SELECT * FROM daily_sum ORDER BY DAYTIME DESC LIMIT 30"))
def o3(spark, folder):
    return tail(daily_sums(spark, folder), 30)


@query("o4_last_date", over("clean", body="SELECT MAX(DAYTIME) AS last_date FROM clean"))
def o4(spark, folder):
    return last_date(clean_wells(raw_view(spark, folder)))


@query(
    "o5_first_row",
    over("daily_sum", body="SELECT * FROM daily_sum WHERE DAYTIME = DATE '1999-06-15' LIMIT 1"),
)
def o5(spark, folder):
    return point_lookup(daily_sums(spark, folder), DAYTIME=dt.date(1999, 6, 15))


@query(
    "w4_index",
    over(
        "daily_sum",
        body="SELECT DAYTIME, ROW_NUMBER() OVER (ORDER BY DAYTIME) AS rn, COUNT(*) OVER () AS n FROM daily_sum",
    ),
)
def w4(spark, folder):
    return with_index(daily_sums(spark, folder)).select("DAYTIME", "rn", "n")


@query(
    "w4_index_by_well",
    over(
        "well_days",
        body="SELECT WELL_BORE_CODE, DAYTIME, ROW_NUMBER() OVER (PARTITION BY WELL_BORE_CODE ORDER BY DAYTIME) AS rn, "
        "COUNT(*) OVER (PARTITION BY WELL_BORE_CODE) AS n FROM well_days",
    ),
)
def w4_by_well(spark, folder):
    daily = daily_sum(production(spark, folder), ["WELL_BORE_CODE"])
    return with_index(daily, series_cols=["WELL_BORE_CODE"]).select("WELL_BORE_CODE", "DAYTIME", "rn", "n")


@query(
    "w6_latest_per_key",
    over("pwell", body="SELECT DAYTIME, WELL_BORE_CODE, l_orderkey, l_linenumber, l_partkey FROM pwell"),
)
def w6(spark, folder):
    return production(spark, folder).select(*KEY, "l_orderkey", "l_linenumber", "l_partkey")


@query(
    "w8_tail_by_well",
    over(
        "well_days",
        body="SELECT WELL_BORE_CODE, DAYTIME, OIL_VOL, GAS_VOL, WAT_VOL FROM (SELECT *, ROW_NUMBER() OVER "
        "(PARTITION BY WELL_BORE_CODE ORDER BY DAYTIME DESC) AS rn FROM well_days) z WHERE rn <= 20",
    ),
)
def w8(spark, folder):
    daily = daily_sum(production(spark, folder), ["WELL_BORE_CODE"])
    return tail(daily, 20, series_cols=["WELL_BORE_CODE"])


# ---------------------------------------------------------------- report


@query("p20_deviation_status", over("report", body="SELECT target, status, COUNT(*) AS row_count FROM report GROUP BY 1, 2"))
def p20(spark, folder):
    table = report.report_table(predictions(spark, folder))
    return table.groupBy("target", "status").agg(F.count(F.lit(1)).alias("row_count"))


@query("p21_unit_label", over("report", body="SELECT target, unit, COUNT(*) AS row_count FROM report GROUP BY 1, 2"))
def p21(spark, folder):
    table = report.report_table(predictions(spark, folder))
    return table.groupBy("target", "unit").agg(F.count(F.lit(1)).alias("row_count"))


RANGE = "DAYTIME BETWEEN DATE '1997-01-01' AND DATE '2000-12-31' AND actual >= 100 AND predicted <= 5000"


@query("p17_range_filter", over("report", body=f"SELECT * FROM report WHERE {RANGE}"))
def p17(spark, folder):
    table = report.report_table(predictions(spark, folder))
    return report.range_filter(
        table,
        DAYTIME=(dt.date(1997, 1, 1), dt.date(2000, 12, 31)),
        actual=(100.0, None),
        predicted=(None, 5000.0),
    )


@query("p18_status_filter", over("report", body="SELECT * FROM report WHERE status = 'Check'"))
def p18(spark, folder):
    return report.status_filter(report.report_table(predictions(spark, folder)), "Check")


@query("p19_equality_selection", over("report", body="SELECT * FROM report WHERE target = 'GAS' AND model_type = 'PERSISTENCE'"))
def p19(spark, folder):
    table = report.report_table(predictions(spark, folder))
    return report.select_equal(table, target="GAS", model_type="PERSISTENCE")


@query("m18_evaluation_frame", over("model_ai", body="SELECT * FROM model_ai"))
def m18(spark, folder):
    return predictions(spark, folder)


@query(
    "m19_performance_series",
    over(
        "report",
        body="SELECT 'Persistence' AS model, DAYTIME, target AS fluid, 'actual' AS kind, actual AS value FROM report "
        "UNION ALL SELECT 'Persistence', DAYTIME, target, 'predicted', predicted FROM report",
    ),
)
def m19(spark, folder):
    return report.performance_series(predictions(spark, folder), "Persistence")


@query("m20_report_table", over("report", body=f"SELECT * FROM report WHERE {RANGE} AND status = 'Check'"))
def m20(spark, folder):
    return report.filtered_report(
        predictions(spark, folder),
        dates=(dt.date(1997, 1, 1), dt.date(2000, 12, 31)),
        actual=(100.0, None),
        predicted=(None, 5000.0),
        status="Check",
    )


# ---------------------------------------------------------------- scalar functions


@query(
    "f1_epoch_of_day",
    over("clean", body="SELECT DISTINCT DAYTIME, CAST(epoch(DAYTIME) AS BIGINT) AS seconds FROM clean"),
)
def f1(spark, folder):
    days = clean_wells(raw_view(spark, folder)).select("DAYTIME").distinct()
    return days.select("DAYTIME", scalars.epoch_of_day("DAYTIME").alias("seconds"))


@query(
    "f2_f3_epoch_to_date",
    over("daily_avg", body="SELECT DAYTIME AS seconds, CAST(make_timestamp(DAYTIME * 1000000) AS DATE) AS day FROM daily_avg"),
)
def f2(spark, folder):
    daily = daily_avg(production(spark, folder))
    return daily.select(
        F.col("DAYTIME").alias("seconds"), scalars.date_part(scalars.from_epoch("DAYTIME")).alias("day")
    )


@query(
    "f4_following_days",
    over(
        "clean",
        body="SELECT WELL_BORE_CODE, CAST(last_day + CAST(i AS INTEGER) AS DATE) AS day FROM "
        "(SELECT WELL_BORE_CODE, MAX(DAYTIME) AS last_day FROM clean GROUP BY 1) z, range(1, 31) t(i)",
    ),
)
def f4(spark, folder):
    last = clean_wells(raw_view(spark, folder)).groupBy("WELL_BORE_CODE").agg(F.max("DAYTIME").alias("last_day"))
    return last.select("WELL_BORE_CODE", F.explode(scalars.following_days(F.col("last_day"), 30)).alias("day"))


@query(
    "f6_text_functions",
    over(
        "clean",
        body="SELECT UPPER(FLOW_KIND) AS flow_kind, CAST(DAYTIME AS VARCHAR) AS day, COUNT(*) AS row_count FROM clean GROUP BY 1, 2",
    ),
)
def f6(spark, folder):
    cleaned = clean_wells(raw_view(spark, folder))
    return cleaned.groupBy(
        F.upper("FLOW_KIND").alias("flow_kind"), F.col("DAYTIME").cast("string").alias("day")
    ).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "f7_strip_extension",
    "SELECT url, regexp_replace(url, '\\.[^.]*$', '') AS stem FROM pages",
)
def f7(spark, folder):
    return read_table(spark, folder, "pages").select("url", scalars.strip_extension("url").alias("stem"))


@query(
    "f8_suffix_test",
    "SELECT page_id, (url LIKE '%.json' OR url LIKE '%.csv' OR url LIKE '%.txt' OR url LIKE '%.xls' OR url LIKE '%.xlsx') AS supported FROM pages",
)
def f8(spark, folder):
    return read_table(spark, folder, "pages").select("page_id", scalars.has_suffix(F.col("url")).alias("supported"))


@query(
    "f9_pseudonym",
    "SELECT c_custkey, sha256(c_name) AS hashed FROM customer",
)
def f9(spark, folder):
    return read_table(spark, folder, "customer").select("c_custkey", scalars.pseudonym("c_name").alias("hashed"))


@query(
    "f10_abs_floor",
    over(
        "model_ai",
        body="SELECT DAYTIME, ABS(OIL_VOL_test - OIL_VOL_pred) AS gap, CAST(FLOOR(GAS_VOL_pred) AS BIGINT) AS whole FROM model_ai",
    ),
)
def f10(spark, folder):
    return predictions(spark, folder).select(
        "DAYTIME",
        F.abs(F.col("OIL_VOL_test") - F.col("OIL_VOL_pred")).alias("gap"),
        F.floor("GAS_VOL_pred").alias("whole"),
    )
