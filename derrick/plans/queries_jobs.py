"""Queries over whole jobs: training, forecasts, loads and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.functions.exact import significant
from derrick.functions.scalars import date_part, from_epoch, new_id
from derrick.operators import gram, models
from derrick.operators.aggregate import daily_sum
from derrick.operators.forecast import forecast_saved
from derrick.operators.scale import standard_stats, with_stats
from derrick.operators.split import split_by_head, split_by_share, with_folds
from derrick.operators.window import lagged, latest_per_key
from derrick.plans import jobs, oracle
from derrick.plans.oracle import over
from derrick.plans.queries_tables import STORED, as_doubles
from derrick.plans.registry import query
from derrick.plans.wells import SEQUENCE, SOURCE, clean_wells, production, raw_view, raw_wells, read_table
from derrick.schema import KEY, NUMERICS, OBJECTS, RAW_WELL, TARGETS, VERSION
from derrick.session import cut_lineage, shared_folder
from derrick.sinks.export import land_csv
from derrick.sinks.model_store import load_model, save_model
from derrick.sinks.runs import append, param_rows
from derrick.sinks.upsert import read_table as stored_table
from derrick.sinks.totals import daily_avg_of, daily_sum_of
from derrick.sinks.upsert import upsert, upsert_together
from derrick.streaming.files import file_stream, read_daily, stream_daily, stream_upsert, write_daily


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder of the session."""
    return f"{shared_folder(spark)}/derrick-{new_id()}"


FILE_ROWS = 100_000  # of a packed file
PART_ROWS = 1_000_000  # where the names of a part's files must follow each other: Spark numbers them in three places


def land_raw(spark: SparkSession, folder: str, target: str, packed: int = 0) -> str:
    """The raw daily rows as dropped CSV files."""
    raw = raw_view(spark, folder).select(*RAW_WELL.fieldNames())
    return land_csv(raw, target, packed)


def land_parts(spark: SparkSession, folder: str, target: str) -> str:
    """The raw daily rows as six part files (a large part as several), whose order says which line is the last.
    Order lines are sorted, which are narrower than the rows derived from them."""
    lines = read_table(spark, folder, "lineitem").select(*SOURCE).repartitionByRange(6, *SEQUENCE).sortWithinPartitions(*SEQUENCE)
    return land_csv(raw_wells(lines).select(*RAW_WELL.fieldNames()), target, PART_ROWS)


# ---------------------------------------------------------------- training
#
# The tree families are searched over the library's grids.

SMALL_FOREST = {"numTrees": [20], "maxDepth": [10], "minInstancesPerNode": [5], "featureSubsetStrategy": ["sqrt"]}


@query("m10_m11_linear_model")
def m11(spark, folder):
    return models.train(production(spark, folder), models.MODELS["linear"]).predictions.drop("id_model")


@query("m12_forest_model")
def m12(spark, folder):
    """Five draws of the grid on three folds for three targets, then the best one on all training days."""
    return models.train(production(spark, folder), models.MODELS["forest"]).predictions.drop("id_model")


@query("m13_boosted_model")
def m13(spark, folder):
    """Five draws of the grid on three folds for three targets, then the best one on all training days."""
    return models.train(production(spark, folder), models.MODELS["boosted"]).predictions.drop("id_model")


@query("m9_a12_search_scores")
def m9(spark, folder):
    fitted = models.train(production(spark, folder), models.MODELS["linear"])
    return spark.createDataFrame(fitted.trials, "candidate int, fold int, mse double")


@query("m15_lookback_forecaster")
def m15(spark, folder):
    return models.train(production(spark, folder), models.MODELS["lookback20"]).predictions.drop("id_model")


@query("m15_lookback_forecaster30")
def m15_30(spark, folder):
    return models.train(production(spark, folder), models.MODELS["lookback30"]).predictions.drop("id_model")


@query("m17_forecast_saved_model")
def m17(spark, folder):
    warehouse = scratch(spark)
    table = production(spark, folder)
    fitted = models.train(table, models.MODELS["lookback20"])
    save_model(spark, warehouse, fitted)
    pipeline, params = load_model(spark, warehouse, fitted.id_model)
    return forecast_saved(pipeline, fitted.id_model, params, daily_sum(table), 90).drop("id_model")


@query("k6_k9_model_params")
def k9(spark, folder):
    fitted = models.train(production(spark, folder), models.MODELS["linear"])
    return param_rows(spark, "run-1", {t: fitted.params for t in TARGETS})


@query(
    "k9_stored_params",
    over(
        "daily_sum",
        body=" UNION ALL ".join(
            f"SELECT '{t}' AS target, 'days' AS param, CAST(COUNT({t}) AS VARCHAR) AS value FROM daily_sum UNION ALL SELECT '{t}', 'last_day', CAST(MAX(DAYTIME) AS VARCHAR) FROM daily_sum WHERE {t} > 0"
            for t in TARGETS
        ),
    ),
)
def k9_stored(spark, folder):
    """Parameters of two runs appended to a table, those of one run read back."""
    path = f"{scratch(spark)}/params"
    facts = [f for t in TARGETS for f in (F.count(t).alias(f"{t}_days"), F.max(F.when(F.col(t) > 0, F.col("DAYTIME"))).alias(f"{t}_last_day"))]
    row = daily_sum(production(spark, folder)).agg(*facts).first()
    given = {t: {"days": row[f"{t}_days"], "last_day": row[f"{t}_last_day"]} for t in TARGETS}
    for run in ("run-1", "run-2"):
        append(param_rows(spark, run, given), path)
    return spark.read.parquet(path).filter("run_id = 'run-2'").drop("run_id")


# ---------------------------------------------------------------- loads


@query("k3_k15_stored_upsert", over("pwell", body=f"SELECT {', '.join(STORED)} FROM pwell"))
def k3_stored(spark, folder):
    """Two loads into the partitioned table: first half of the orders, then all."""
    warehouse = scratch(spark)
    rows = clean_wells(raw_view(spark, folder))
    for part in (rows.filter(F.col("l_orderkey") % 2 == 0), rows):
        upsert(spark, warehouse, "pwell_data", part.select(*STORED, *SEQUENCE), SEQUENCE)
    return as_doubles(stored_table(spark, warehouse, "pwell_data").select(*STORED), NUMERICS)


def _by_month(table: str, where: str = "TRUE") -> str:
    return f"SELECT strftime(DAYTIME, '%Y-%m') AS MONTH, COUNT(*) AS n_rows, SUM(ROUND(BORE_GAS_VOL * 1e3)) / 1e3 AS gas FROM {table} WHERE {where} GROUP BY 1"


@query(
    "k15_two_states",
    over(
        "clean",
        extra=f"half AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY DAYTIME, WELL_BORE_CODE ORDER BY {oracle.ORDER}) AS rn FROM clean WHERE l_orderkey % 2 = 0) z WHERE rn = 1), "
        f"whole AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY DAYTIME, WELL_BORE_CODE ORDER BY {oracle.ORDER}) AS rn FROM clean) z WHERE rn = 1)",
        body=f"SELECT 1 AS state, 'pwell_data' AS stored, * FROM ({_by_month('half')}) UNION ALL SELECT 2, 'pwell_data', * FROM ({_by_month('whole')}) "
        f"UNION ALL SELECT 1, 'objects', MONTH, n_rows, NULL FROM ({_by_month('half')}) UNION ALL SELECT 2, 'objects', MONTH, n_rows, NULL FROM ({_by_month('whole')})",
    ),
)
def k15(spark, folder):
    """Two loads of two tables, half the orders and then all; both states of the warehouse are read after the second."""
    warehouse = scratch(spark)
    rows = clean_wells(raw_view(spark, folder))
    for part in (rows.filter(F.col("l_orderkey") % 2 == 0), rows):
        frames = {"objects": part.select(*OBJECTS.fieldNames(), *SEQUENCE), "pwell_data": part.select(*STORED, *SEQUENCE)}
        upsert_together(spark, warehouse, frames, SEQUENCE)
    parts = []
    for state in (1, 2):
        for name in ("pwell_data", "objects"):
            gas = F.sum("BORE_GAS_VOL" if name == "pwell_data" else F.lit(None)).cast("double")
            months = stored_table(spark, warehouse, name, state).groupBy("MONTH").agg(F.count("*").alias("n_rows"), gas.alias("gas"))
            parts.append(months.select(F.lit(state).alias("state"), F.lit(name).alias("stored"), "MONTH", "n_rows", "gas"))
    return reduce(DataFrame.unionAll, parts)


@query("x2_etl_job")
def x2(spark, folder):
    base = scratch(spark)
    land_raw(spark, folder, f"{base}/drop", FILE_ROWS)
    result = jobs.run_etl(spark, f"{base}/drop/*.csv.gz", f"{base}/tables")
    if not result.ok:
        raise RuntimeError(result.error)
    return as_doubles(stored_table(spark, f"{base}/tables", "pwell_data").select(*STORED), NUMERICS)


@query("x2_load_parts", over("pwell", body=f"SELECT {', '.join(STORED)} FROM pwell"))
def x2_parts(spark, folder):
    """The load without imputation: six part files, whose order says which line is the last."""
    base = scratch(spark)
    land_parts(spark, folder, f"{base}/drop")
    result = jobs.run_etl(spark, f"{base}/drop/*.csv.gz", f"{base}/tables", impute=False)
    if not result.ok:
        raise RuntimeError(result.error)
    return as_doubles(stored_table(spark, f"{base}/tables", "pwell_data").select(*STORED), NUMERICS)


@query("x3_x4_tick")
def x3(spark, folder):
    """Pick the newest drop with all its part files, load it, train two families, export."""
    base = scratch(spark)
    land_raw(spark, folder, f"{base}/drop/lineitem", FILE_ROWS)
    tick = jobs.run_once(spark, f"{base}/drop", f"{base}/tables", f"{base}/out", ["linear", "lookback20"])
    failed = [r.error for r in tick.models if not r.ok] + ([tick.etl.error] if not tick.etl.ok else [])
    if failed:
        raise RuntimeError("; ".join(failed))
    return spark.read.option("header", True).csv(tick.export).select("model_type", "DAYTIME", *[f"{t}_pred" for t in TARGETS])


# ---------------------------------------------------------------- streams


@query(
    "t1_file_stream",
    over("well_raw", body="SELECT WELL_BORE_CODE, DATEPRD, COUNT(*) AS row_count FROM well_raw GROUP BY 1, 2"),
)
def t1(spark, folder):
    base = scratch(spark)
    land_raw(spark, folder, f"{base}/drop")
    stream = file_stream(spark, f"{base}/drop", RAW_WELL, archive=f"{base}/archive")

    def keep(batch, batch_id):
        batch.select("WELL_BORE_CODE", "DATEPRD").write.mode("overwrite").parquet(f"{base}/picked/batch={batch_id}")

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/state").trigger(
        availableNow=True
    ).start().awaitTermination()
    picked = spark.read.parquet(f"{base}/picked")
    return picked.groupBy("WELL_BORE_CODE", "DATEPRD").agg(F.count(F.lit(1)).alias("row_count"))


@query("t2_stream_upsert", over("pwell", body=f"SELECT {', '.join(STORED)} FROM pwell"))
def t2(spark, folder):
    base = scratch(spark)
    schema = read_table(spark, folder, "lineitem").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(folder)

    def prepare(batch):
        return clean_wells(raw_wells(batch)).select(*STORED, *SEQUENCE)

    stream_upsert(stream, base, "pwell_data", f"{base}/state", prepare, SEQUENCE).awaitTermination()
    return as_doubles(stored_table(spark, base, "pwell_data").select(*STORED), NUMERICS)


BACKLOG = 3
BATCH_FILES = 4


@query(
    "t1_t2_backlog",
    over(
        "clean",
        extra=f"newest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY DAYTIME, WELL_BORE_CODE ORDER BY l_orderkey % {BACKLOG} DESC, {oracle.ORDER}) AS rn FROM clean) z WHERE rn = 1)",
        body=f"SELECT {', '.join(STORED)} FROM newest",
    ),
)
def t1_t2(spark, folder):
    """Three waiting drops with common keys, taken newest first, then all of them again oldest first: the newest drop's rows stay."""
    base = scratch(spark)
    raw = raw_view(spark, folder)
    for k in range(BACKLOG):
        rows = latest_per_key(raw.filter(F.col("l_orderkey") % BACKLOG == k), ["DATEPRD", "WELL_BORE_CODE"], SEQUENCE)
        # No more part files than a batch takes, or the batches, each of which merges with all, would grow with the drop.
        land_csv(rows.coalesce(BATCH_FILES).select(*RAW_WELL.fieldNames()), f"{base}/drop/{k}")
    prepare = lambda batch: jobs.load_frames(jobs.clean_rows(jobs.with_line(batch)), (VERSION,))["pwell_data"]
    for state, newest_first in (("down", True), ("up", False)):
        stream = file_stream(spark, f"{base}/drop/*", RAW_WELL, per_batch=BATCH_FILES, newest_first=newest_first)
        stream_upsert(stream, base, "pwell_data", f"{base}/{state}", prepare).awaitTermination()
    return as_doubles(stored_table(spark, base, "pwell_data").select(*STORED), NUMERICS)


@query("t3_t4_corrected_totals", over("daily_sum", "daily_avg", body="SELECT s.DAYTIME, s.OIL_VOL, s.GAS_VOL, s.WAT_VOL, a.OIL_VOL AS oil_mean, a.ON_STREAM_HRS AS hours_mean, a.AVG_WHP_P AS pressure_mean FROM daily_sum s JOIN daily_avg a ON a.DAYTIME = CAST(epoch(s.DAYTIME) AS BIGINT)"))
def t3_corrected(spark, folder):
    """Daily totals over two loads: the second corrects a third of the rows, some of which had a value too many or too few."""
    warehouse = scratch(spark)
    rows = cut_lineage(production(spark, folder))
    wrong = F.pmod(F.crc32(F.concat_ws("/", *KEY)), F.lit(3)) == 0
    spoilt = {"BORE_OIL_VOL": F.col("BORE_OIL_VOL") + 100, "BORE_GAS_VOL": F.lit(None), "ON_STREAM_HRS": F.coalesce("ON_STREAM_HRS", F.lit(7))}
    first = rows.withColumns({c: F.when(wrong, value).otherwise(F.col(c)).cast(rows.schema[c].dataType) for c, value in spoilt.items()})
    for load in (first, rows.filter(wrong)):
        upsert(spark, warehouse, "pwell_data", load.select(*STORED))
    totals = stored_table(spark, warehouse, "daily_totals")
    means = daily_avg_of(totals).select("DAYTIME", F.col("OIL_VOL").alias("oil_mean"), F.col("ON_STREAM_HRS").alias("hours_mean"), F.col("AVG_WHP_P").alias("pressure_mean"))
    return daily_sum_of(totals).join(means.withColumn("DAYTIME", date_part(from_epoch(F.col("DAYTIME")))), "DAYTIME")


@query(
    "t3_stream_daily",
    "SELECT CAST(ts AS DATE) AS DAYTIME, event_type, COUNT(value) AS row_count, "
    "ROUND(SUM(value), 6) AS total, ROUND(SUM(value) / COUNT(value), 6) AS mean FROM events GROUP BY 1, 2",
)
def t3(spark, folder):
    base = scratch(spark)
    schema = T.StructType([f for f in read_table(spark, folder, "events").schema if f.name in ("ts", "event_type", "value")])
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    daily = stream_daily(stream, "value", "ts", ["event_type"], "1 day")
    write_daily(daily, f"{base}/daily", f"{base}/state").awaitTermination()
    daily = read_daily(spark, f"{base}/daily", ["event_type"])
    return daily.withColumns({c: F.round(c, 6) for c in ("total", "mean")})


# ---------------------------------------------------------------- training against SQL
#
# One feature, the day: the fit of each target is then a regression line that SQL has too.

_TREND_ROWS = (
    "rows AS (SELECT *, ROW_NUMBER() OVER (ORDER BY DAYTIME) AS rn, COUNT(*) OVER () AS n, CAST(epoch(DAYTIME) AS DOUBLE) / 86400 AS x FROM daily_sum), "
    "known AS (SELECT *, n - CAST(CEIL(n * 0.2e0) AS BIGINT) AS m FROM rows WHERE rn <= n - CAST(CEIL(n * 0.2e0) AS BIGINT)), "
    "fold AS (SELECT *, CASE WHEN rn - 1 >= m - 3 * (m // 4) THEN (rn - 1 - (m - 3 * (m // 4))) // (m // 4) END AS f FROM known)"
)


def _trend_frame(sums):
    return split_by_share(sums).withColumn("DAY", F.unix_date("DAYTIME").cast("double"))


def _fit_trend(sums, **grid):
    return models.train_frame(models.MODELS["linear"], _trend_frame(sums), {"DAY": "DAY"}, TARGETS, grid=grid)


def _trend(spark, folder, **grid):
    return _fit_trend(daily_sum(production(spark, folder)), **grid)


_TREND_LINE = over(
    "daily_sum",
    extra=_TREND_ROWS,
    body="SELECT r.DAYTIME, "
    + ", ".join(f"ANY_VALUE(r.{t}) AS {t}_test, ROUND(ANY_VALUE(l.{t}_a) + ANY_VALUE(l.{t}_b) * ANY_VALUE(r.x), 5) AS {t}_pred" for t in TARGETS)
    + " FROM rows r, (SELECT "
    + ", ".join(f"REGR_INTERCEPT({t}, x) AS {t}_a, REGR_SLOPE({t}, x) AS {t}_b" for t in TARGETS)
    + " FROM known) l WHERE r.rn > r.n - CAST(CEIL(r.n * 0.2e0) AS BIGINT) GROUP BY r.DAYTIME",
)


@query("m10_m11_trend_line", _TREND_LINE)
def m11_trend(spark, folder):
    """Three targets on the day: fitted on the first four fifths, predicted for the rest."""
    found = _trend(spark, folder, fitIntercept=[True]).predictions
    return found.select("DAYTIME", *[f"{t}_test" for t in TARGETS], *[F.round(f"{t}_pred", 5).alias(f"{t}_pred") for t in TARGETS])


@query("k13_k14_saved_trend_line", _TREND_LINE)
def k13_trend(spark, folder):
    """The trend line saved, found again by its id, and applied to the days after its training."""
    warehouse = scratch(spark)
    sums = cut_lineage(daily_sum(production(spark, folder)))
    fitted = _fit_trend(sums, fitIntercept=[True])
    save_model(spark, warehouse, fitted)
    pipeline, _ = load_model(spark, warehouse, fitted.id_model)
    found = pipeline.transform(_trend_frame(sums).filter("is_test"))
    return found.select("DAYTIME", *[F.col(t).alias(f"{t}_test") for t in TARGETS], *[F.round(f"{t}_pred", 5).alias(f"{t}_pred") for t in TARGETS])


@query("x1_x3_x4_trend_tick", _TREND_LINE)
def x3_trend(spark, folder):
    """A tick over a drop: load, two models of the registry, of which one fails and one is the trend line, and the export read back."""
    base = scratch(spark)
    land_parts(spark, folder, f"{base}/drop/lineitem")

    def trainer(series, spec):
        if spec.name != "linear":
            raise RuntimeError("this family fails")
        return _fit_trend(series.sums, fitIntercept=[True])

    tick = jobs.run_once(spark, f"{base}/drop", f"{base}/tables", f"{base}/out", ["forest", "linear"], trainer, impute=False)
    if not tick.etl.ok or [r.ok for r in tick.models] != [False, True]:
        raise RuntimeError(f"{tick}")
    export = spark.read.option("header", True).csv(tick.export)
    numbers = [F.col(f"{t}_test").cast("double") for t in TARGETS] + [F.round(F.col(f"{t}_pred").cast("double"), 5).alias(f"{t}_pred") for t in TARGETS]
    return export.select(F.to_date("DAYTIME").alias("DAYTIME"), *numbers)


@query("m17_forest_forecast")
def m17_forest(spark, folder):
    """Boosted look-back trees, saved, loaded and rolled forward 90 days in one pass."""
    warehouse = scratch(spark)
    sums = cut_lineage(daily_sum(production(spark, folder)))
    spec = models.ModelSpec("boosted20", "GBT20", "BoostedLookback20", models.MODELS["boosted"].build, LOOKBACK_TREES, 20, shared=True)
    fitted = models.train_lookback(sums, spec)
    save_model(spark, warehouse, fitted)
    pipeline, params = load_model(spark, warehouse, fitted.id_model)
    return forecast_saved(pipeline, fitted.id_model, params, sums, 90).drop("id_model")


_fold_error = " + ".join(
    f"(SELECT AVG(POWER(e.{t} - (l.a + l.b * e.x), 2)) FROM fold e, (SELECT REGR_INTERCEPT({t}, x) AS a, REGR_SLOPE({t}, x) AS b "
    f"FROM fold WHERE COALESCE(f, -1) < g.g) l WHERE e.f = g.g) / (SELECT VAR_POP({t}) FROM known)"
    for t in TARGETS
)


@query(
    "m9_a12_trend_scores",
    over(
        "daily_sum",
        extra=_TREND_ROWS,
        body=f"SELECT CAST(0 AS INTEGER) AS candidate, CAST(g.g AS INTEGER) AS fold, {oracle.significant(f'({_fold_error}) / 3e0', 6)} AS mse FROM range(3) g(g)",
    ),
)
def m9_trend(spark, folder):
    """Error of the trend line on each of the three time-ordered folds, in standardised units."""
    trials = _trend(spark, folder, fitIntercept=[True]).trials
    scores = spark.createDataFrame(trials, "candidate int, fold int, mse double")
    return scores.withColumn("mse", significant("mse", 6))


LOOKBACK_TREES = {"maxIter": [100], "maxDepth": [3], "stepSize": [0.05, 0.1]}
STUMP = {"numTrees": [1], "maxDepth": [1], "minInstancesPerNode": [5], "featureSubsetStrategy": ["1.0"], "bootstrap": [False]}


@query(
    "m12_stump_by_month",
    over(
        "daily_sum",
        extra=_TREND_ROWS
        + ", months AS (SELECT *, month(DAYTIME) AS v FROM rows), seen AS (SELECT * FROM months WHERE rn <= n - CAST(CEIL(n * 0.2e0) AS BIGINT)), "
        "cuts AS (SELECT DISTINCT v AS cut FROM seen), whole AS (SELECT COUNT(*) AS w, "
        + ", ".join(f"SUM({t}) AS {t}" for t in TARGETS)
        + " FROM seen), sides AS (SELECT c.cut, COUNT(*) AS wl, "
        + ", ".join(f"SUM(s.{t}) AS {t}_l" for t in TARGETS)
        + " FROM cuts c JOIN seen s ON s.v <= c.cut GROUP BY c.cut), "
        + ", ".join(
            f"best_{t} AS (SELECT cut, {t}_l / wl AS low, (w.{t} - {t}_l) / (w.w - wl) AS high FROM sides, whole w WHERE wl >= 5 AND w.w - wl >= 5 "
            f"ORDER BY {t}_l * {t}_l / wl + (w.{t} - {t}_l) * (w.{t} - {t}_l) / (w.w - wl) DESC, cut LIMIT 1)"
            for t in TARGETS
        ),
        body="SELECT m.DAYTIME, "
        + ", ".join(f"ROUND(CASE WHEN m.v <= {t}_b.cut THEN {t}_b.low ELSE {t}_b.high END, 5) AS {t}_pred" for t in TARGETS)
        + " FROM months m, "
        + ", ".join(f"best_{t} {t}_b" for t in TARGETS)
        + " WHERE m.rn > m.n - CAST(CEIL(m.n * 0.2e0) AS BIGINT)",
    ),
)
def m12_stump(spark, folder):
    """The forest trainer with one tree of one split on one feature, without resampling: the best cut between months."""
    frame = split_by_share(daily_sum(production(spark, folder))).withColumn("MONTH_NO", F.month("DAYTIME").cast("double"))
    found = models.train_frame(models.MODELS["forest"], frame, {"MONTH_NO": "MONTH_NO"}, TARGETS, grid=STUMP).predictions
    return found.select("DAYTIME", *[F.round(f"{t}_pred", 5).alias(f"{t}_pred") for t in TARGETS])


@query(
    "m12_forest_in_range",
    over(
        "daily_sum",
        extra=_TREND_ROWS,
        body="SELECT DAYTIME, OIL_VOL AS OIL_VOL_test, TRUE AS in_range FROM rows WHERE rn > n - CAST(CEIL(n * 0.2e0) AS BIGINT)",
    ),
)
def m12_range(spark, folder):
    """A forest averages what it has seen: no prediction leaves the range of the training rows."""
    frame = split_by_share(daily_sum(production(spark, folder))).withColumn("DAY", F.unix_date("DAYTIME").cast("double"))
    found = models.train_frame(models.MODELS["forest"], frame, {"DAY": "DAY"}, TARGETS, grid=SMALL_FOREST).predictions
    bounds = frame.filter(~F.col("is_test")).agg(F.min("OIL_VOL").alias("low"), F.max("OIL_VOL").alias("high"))
    low, high = (bounds.select(c).scalar() for c in ("low", "high"))
    return found.select("DAYTIME", "OIL_VOL_test", F.col("OIL_VOL_pred").between(low - 1e-6, high + 1e-6).alias("in_range"))


# ---------------------------------------------------------------- fits from sums of products against SQL
#
# Four days back of three targets are twelve features. SQL sums the same products and eliminates
# column by column, for every series, candidate and fold at once.

LAGS = 4
_LAG_CANDIDATES = [{"fitIntercept": i, "regParam": r} for i in (True, False) for r in (0.0, 0.1, 1.0)]
_P = 1 + LAGS * len(TARGETS)
_D = _P + len(TARGETS)
_lag_names = list(models.lag_names(LAGS))


def _elimination(vectors: str) -> str:
    """Steps from ``vectors`` (``key``, ``f``: the block, ``v``: 1, features, targets) to ``errors`` and ``picked``, and to ``weights``
    (``key``, ``cand``, ``fold`` (3: all rows), ``i``, ``t``, ``b``)."""
    candidates = ", ".join(f"({c}, {int(x['fitIntercept'])}, {x['regParam']}e0)" for c, x in enumerate(_LAG_CANDIDATES))
    return f"""{vectors},
products AS (SELECT key, f, i.i, j.j, SUM(v[i.i + 1] * v[j.j + 1]) AS s FROM vectors, range({_D}) i(i), range({_D}) j(j) GROUP BY ALL),
candidates(cand, free, reg) AS (VALUES {candidates}),
sums AS (SELECT key, g.g AS fold, i, j, SUM(s) AS s FROM products, range(4) g(g) WHERE f < g.g GROUP BY ALL),
sizes AS (SELECT key, fold, s AS n FROM sums WHERE i = 0 AND j = 0),
entries AS (
  SELECT s.key, s.fold, c.cand, s.i, s.j,
    CASE WHEN c.free = 0 AND s.i = 0 THEN CASE WHEN s.j = 0 THEN 1e0 ELSE 0e0 END
         WHEN c.free = 0 AND s.j = 0 THEN 0e0
         ELSE s.s + CASE WHEN s.i = s.j AND s.i > 0 THEN z.n * c.reg ELSE 0e0 END END AS s
  FROM sums s JOIN sizes z ON z.key = s.key AND z.fold = s.fold, candidates c WHERE s.i < {_P}),
matrices AS (SELECT key, fold, cand, list(r ORDER BY i) AS m FROM (SELECT key, fold, cand, i, list(s ORDER BY j) AS r FROM entries GROUP BY ALL) GROUP BY ALL),
walk AS (
  SELECT key, fold, cand, 1 AS k, m FROM matrices
  UNION ALL
  SELECT key, fold, cand, k + 1, list_transform(range(1, {_P + 1}), lambda i: list_transform(range(1, {_D + 1}), lambda j:
    CASE WHEN i = k THEN m[k][j] / m[k][k] ELSE m[i][j] - m[i][k] * m[k][j] / m[k][k] END))
  FROM walk WHERE k <= {_P}),
weights AS (SELECT key, fold, cand, i.i, t.t, m[i.i + 1][{_P} + t.t + 1] AS b FROM walk, range({_P}) i(i), range({len(TARGETS)}) t(t) WHERE k = {_P + 1}),
misses AS (SELECT key, fold, cand, i, t, b FROM weights WHERE fold < 3
  UNION ALL SELECT DISTINCT key, fold, cand, {_P} + t, t, -1e0 FROM weights WHERE fold < 3),
errors AS (SELECT a.key, a.cand, a.fold, SUM(a.b * c.b * g.s) / ANY_VALUE(z.s) / {len(TARGETS)} AS mse
  FROM misses a JOIN misses c ON c.key = a.key AND c.fold = a.fold AND c.cand = a.cand AND c.t = a.t
  JOIN products g ON g.key = a.key AND g.f = a.fold AND g.i = a.i AND g.j = c.i
  JOIN products z ON z.key = a.key AND z.f = a.fold AND z.i = 0 AND z.j = 0 GROUP BY a.key, a.cand, a.fold),
picked AS (SELECT key, cand, mse, ROW_NUMBER() OVER (PARTITION BY key ORDER BY mse, cand) AS place
  FROM (SELECT key, cand, SUM(mse) / 3 AS mse FROM errors GROUP BY key, cand))"""


def _lag_vectors(table: str, key: str, share: str) -> str:
    """Standardised look-back rows of every series up to ``share`` of its length, with their block."""
    over_key = f"PARTITION BY {key} ORDER BY DAYTIME"
    lags = ", ".join(f"LAG({t}, {i}) OVER ({over_key}) AS {t}_lag{i}" for i in range(LAGS, 0, -1) for t in TARGETS)
    scaled = [f"(r.{f} - s.{f.rsplit('_lag', 1)[0]}_mean) / CASE WHEN s.{f.rsplit('_lag', 1)[0]}_std = 0 THEN 1e0 ELSE s.{f.rsplit('_lag', 1)[0]}_std END" for f in [*_lag_names, *TARGETS]]
    stats = ", ".join(f"AVG({t}) AS {t}_mean, STDDEV_POP({t}) AS {t}_std" for t in TARGETS)
    return f"""lagged AS (SELECT *, ROW_NUMBER() OVER ({over_key}) - {LAGS} AS rn, COUNT(*) OVER (PARTITION BY key) - {LAGS} AS whole FROM (
  SELECT *, {key} AS key, {lags} FROM {table})),
known AS (SELECT *, {share} AS m FROM lagged WHERE rn > 0 AND rn <= {share}),
stats AS (SELECT key, {stats} FROM known GROUP BY key),
vectors AS (SELECT r.key, CASE WHEN rn - 1 >= m - 3 * (m // 4) THEN (rn - 1 - (m - 3 * (m // 4))) // (m // 4) ELSE -1 END AS f, [1e0, {', '.join(scaled)}] AS v
  FROM known r JOIN stats s ON s.key = r.key)"""


@query(
    "m9_m11_lag_search",
    over(
        "daily_sum",
        extra=_elimination(_lag_vectors("daily_sum", "1", "CAST(FLOOR(whole * 0.8e0) AS BIGINT)")),
        recursive=True,
        body=f"SELECT CAST(e.cand AS INTEGER) AS candidate, CAST(e.fold AS INTEGER) AS fold, {oracle.significant('e.mse', 6)} AS mse, e.cand = p.cand AS chosen "
        "FROM errors e JOIN picked p ON p.key = e.key AND p.place = 1",
    ),
)
def m9_lags(spark, folder):
    """Six linear candidates on twelve look-back features, scored on three folds; the one with the smallest mean error is chosen."""
    frame = split_by_head(lagged(daily_sum(production(spark, folder)), TARGETS, LAGS)).filter(~F.col("is_test")).drop("rn", "n")
    scaled = cut_lineage(_lag_scaled(frame, []))
    trials = gram.cv_scores(with_folds(scaled, 3), _LAG_CANDIDATES, _lag_names, TARGETS, 3)
    chosen, _ = models.best_candidate(trials)
    scores = spark.createDataFrame(trials, "candidate int, fold int, mse double")
    return scores.select("candidate", "fold", significant("mse", 6).alias("mse"), (F.col("candidate") == chosen).alias("chosen"))


def _lag_scaled(frame, keys):
    """Lags and targets standardised by the targets' statistics in the series."""
    stats = standard_stats(frame, TARGETS, keys)
    bases = {f: f.rsplit("_lag", 1)[0] for f in [*_lag_names, *TARGETS]}
    scaled = {f: (F.col(f) - F.col(f"{b}_mean")) / F.when(F.col(f"{b}_std") == 0, 1.0).otherwise(F.col(f"{b}_std")) for f, b in bases.items()}
    both = frame.join(stats, keys) if keys else with_stats(frame, stats, stats.columns)
    return both.withColumns(scaled).drop(*stats.drop(*keys).columns)


_weight = "MAX(CASE WHEN w.i = {i} AND w.t = {t} THEN w.b END)"


@query(
    "m9_m11_lag_fit_by_well",
    over(
        "well_days",
        extra=_elimination(_lag_vectors("well_days", "WELL_BORE_CODE", "whole")),
        recursive=True,
        body="SELECT w.key AS WELL_BORE_CODE, ANY_VALUE(CAST(z.n AS BIGINT)) AS n_rows, ANY_VALUE(CAST(p.cand AS INTEGER)) AS candidate, "
        + oracle.significant("ANY_VALUE(p.mse)", 6)
        + " AS cv_mse, "
        + ", ".join(f"ROUND({_weight.format(i=_P - len(TARGETS) + j, t=j)}, 6) + 0e0 AS {t}_newest, ROUND({_weight.format(i=1, t=j)}, 6) + 0e0 AS {t}_oldest" for j, t in enumerate(TARGETS))
        + " FROM weights w JOIN picked p ON p.key = w.key AND p.place = 1 AND p.cand = w.cand JOIN sizes z ON z.key = w.key AND z.fold = 3 WHERE w.fold = 3 GROUP BY w.key",
    ),
)
def m9_lags_by_well(spark, folder):
    """The same search for every well at once, each well a row; the chosen fit's weights of the oldest and of its own newest day."""
    keys = ["WELL_BORE_CODE"]
    frame = lagged(daily_sum(production(spark, folder), keys), TARGETS, LAGS, series_cols=keys)
    fits = gram.fit_series(with_folds(_lag_scaled(frame, keys), 3, series_cols=keys), _LAG_CANDIDATES, _lag_names, TARGETS, keys, 3)
    ends = [
        F.round(F.get(f"{t}_weights", F.lit(at)), 6).alias(f"{t}_{name}")
        for j, t in enumerate(TARGETS)
        for name, at in (("newest", (LAGS - 1) * len(TARGETS) + j), ("oldest", 0))
    ]
    return fits.select(*keys, "n_rows", "candidate", significant("cv_mse", 6).alias("cv_mse"), *ends)
