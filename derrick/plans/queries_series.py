"""Queries over the daily series: imputation, scaling, encoding, splits, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from derrick.functions import exact
from derrick.functions.scalars import shift_append
from derrick.operators import encode, scale, split
from derrick.operators.aggregate import daily_avg, daily_sum
from derrick.operators.forecast import recent_frame, roll_linear
from derrick.operators.impute import knn_impute, knn_pairs
from derrick.operators.window import k_nearest, lagged, lookback
from derrick.plans import oracle
from derrick.plans.oracle import over, significant
from derrick.plans.registry import query
from derrick.plans.wells import production, read_table
from derrick.schema import KEY, NUMERICS, READINGS, TARGETS
from derrick.session import cut_lineage

DAY_COLUMNS = ["DAYTIME", *TARGETS, *READINGS]


SERIES = ["NPD_FIELD_CODE"]


def field_averages(spark, folder):
    """Daily means per field. Fields that report nothing on a day leave gaps; as large tables have none, two gauges
    are read out of service on every eleventh and thirteenth day."""
    means = daily_avg(production(spark, folder), SERIES)
    day = F.floor(F.col("DAYTIME") / 86400)
    gaps = {c: F.when(day % n != 0, F.col(c)) for c, n in oracle.OUT_OF_SERVICE.items()}
    return cut_lineage(means.withColumns(gaps))


# ---------------------------------------------------------------- nearest neighbours

_both = [f"(r.{c} IS NOT NULL AND d.{c} IS NOT NULL)" for c in DAY_COLUMNS]
_gaps = " + ".join(f"COALESCE((r.{c} - d.{c}) * (r.{c} - d.{c}), 0)" for c in DAY_COLUMNS)
_any_gap = " OR ".join(f"{c} IS NULL" for c in DAY_COLUMNS)
KNN_PAIRS = f"""pairs AS (
  SELECT r.DAYTIME AS day, r.NPD_FIELD_CODE AS field, d.DAYTIME AS donor, d.NPD_FIELD_CODE AS donor_field,
    ROUND(SQRT({len(DAY_COLUMNS)}e0 / ({' + '.join(f'CAST({b} AS INTEGER)' for b in _both)}) * ({_gaps})), 9) AS dist
  FROM (SELECT * FROM field_avg WHERE {_any_gap}) r CROSS JOIN field_avg d),
ranked AS ({' UNION ALL '.join(
    f"""(SELECT day, field, '{c}' AS "column", donor, donor_field, dist, value,
      ROW_NUMBER() OVER (PARTITION BY day, field ORDER BY dist, donor_field, donor) AS rank
    FROM (SELECT p.*, d.{c} AS value FROM pairs p JOIN field_avg d ON d.DAYTIME = p.donor AND d.NPD_FIELD_CODE = p.donor_field
    JOIN field_avg r ON r.DAYTIME = p.day AND r.NPD_FIELD_CODE = p.field WHERE r.{c} IS NULL AND d.{c} IS NOT NULL) z)""" for c in READINGS)}),
nearest AS (SELECT * FROM ranked WHERE rank <= 5)"""


@query(
    "j1_nearest_pairs",
    over(
        "field_avg",
        extra=KNN_PAIRS,
        body='SELECT field AS "NPD_FIELD_CODE", day AS "DAYTIME", "column", CAST(rank AS BIGINT) AS rank, donor_field AS "donor_NPD_FIELD_CODE", donor AS "donor_DAYTIME", ROUND(dist, 3) AS dist, value FROM nearest',
    ),
)
def j1(spark, folder):
    pairs = knn_pairs(field_averages(spark, folder), DAY_COLUMNS, 5, [*SERIES, "DAYTIME"])
    return pairs.withColumns({"rank": F.col("rank").cast("bigint"), "dist": F.round("dist", 3)})


@query(
    "w7_nearest_two",
    over(
        "field_avg",
        extra=KNN_PAIRS,
        body='SELECT field AS "NPD_FIELD_CODE", day AS "DAYTIME", "column", donor_field AS "donor_NPD_FIELD_CODE", donor AS "donor_DAYTIME", rank AS place FROM nearest WHERE rank <= 2',
    ),
)
def w7(spark, folder):
    pairs = knn_pairs(field_averages(spark, folder), DAY_COLUMNS, 5, [*SERIES, "DAYTIME"]).drop("rank")
    nearest = k_nearest(pairs, [*SERIES, "DAYTIME", "column"], ["dist", "donor_NPD_FIELD_CODE", "donor_DAYTIME"], 2)
    return nearest.select(*SERIES, "DAYTIME", "column", "donor_NPD_FIELD_CODE", "donor_DAYTIME", F.col("rank").cast("bigint").alias("place"))


_filled = ", ".join(
    f"COALESCE(a.{c}, (SELECT SUM(value ORDER BY rank) / COUNT(value) FROM nearest n WHERE n.day = a.DAYTIME AND n.field = a.NPD_FIELD_CODE AND n.\"column\" = '{c}')) AS {c}"
    for c in READINGS
)


@query(
    "m1_knn_impute",
    over(
        "field_avg",
        extra=KNN_PAIRS,
        body=f"SELECT a.NPD_FIELD_CODE, a.DAYTIME, a.OIL_VOL, a.GAS_VOL, a.WAT_VOL, {_filled} FROM field_avg a",
    ),
)
def m1(spark, folder):
    return knn_impute(field_averages(spark, folder), DAY_COLUMNS, [*SERIES, "DAYTIME"]).withColumn(
        "DAYTIME", F.col("DAYTIME").cast("bigint")
    )


@query("m1_knn_impute_rows")
def m1_rows(spark, folder):
    """Every stored row against every stored row; brute force is only feasible on
    the small fixture of the tests."""
    return knn_impute(cut_lineage(production(spark, folder).select(*KEY, *NUMERICS)), NUMERICS, KEY)


# ---------------------------------------------------------------- scaling

def sums(spark, folder):
    return daily_sum(production(spark, folder))


STANDARD = ", ".join(f"AVG({c}) AS {c}_mean, STDDEV_POP({c}) AS {c}_std" for c in TARGETS)
SIGNIFICANT = ", ".join(f"{significant(f'AVG({c})')} AS {c}_mean, {significant(f'STDDEV_POP({c})')} AS {c}_std" for c in TARGETS)
MINMAX = ", ".join(f"MIN({c}) AS {c}_min, MAX({c}) AS {c}_max" for c in TARGETS)


def _shift(c, lo, spread):
    return f"({c} - s.{lo}) / CASE WHEN {spread} = 0 THEN 1e0 ELSE {spread} END"


_standardised = ", ".join(f"ROUND({_shift('d.' + c, c + '_mean', f's.{c}_std')}, 6) AS {c}" for c in TARGETS)
_scaled = ", ".join(f"{_shift('d.' + c, c + '_mean', f's.{c}_std')} AS {c}" for c in TARGETS)
_minmaxed = ", ".join(f"{_shift('d.' + c, c + '_min', f'(s.{c}_max - s.{c}_min)')} AS {c}" for c in TARGETS)


NUMBERS = [c for c in NUMERICS if c != "BORE_WI_VOL"]


def stats_at_7(stats):
    """Means and deviations to 7 significant digits: the last bits of double sums follow the order of the rows."""
    return stats.withColumns({c: exact.significant(c) for c in stats.columns if c.endswith(("_mean", "_std"))})


def at_6(df, columns=TARGETS):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "a4_standard_stats",
    over(
        "pwell",
        body="SELECT "
        + ", ".join(f"{significant(f'AVG({c})')} AS {c}_mean, {significant(f'STDDEV_POP({c})')} AS {c}_std" for c in NUMBERS)
        + " FROM pwell",
    ),
)
def a4(spark, folder):
    return stats_at_7(scale.standard_stats(production(spark, folder), NUMBERS))


@query(
    "a4_standard_stats_by_well",
    over("well_days", body=f"SELECT WELL_BORE_CODE, {SIGNIFICANT} FROM well_days GROUP BY WELL_BORE_CODE"),
)
def a4_by_well(spark, folder):
    daily = daily_sum(production(spark, folder), ["WELL_BORE_CODE"])
    return stats_at_7(scale.standard_stats(daily, TARGETS, ["WELL_BORE_CODE"]))


@query("a5_minmax_stats", over("daily_sum", body=f"SELECT {MINMAX} FROM daily_sum"))
def a5(spark, folder):
    return scale.minmax_stats(sums(spark, folder), TARGETS)


@query("m2_standardise", over("daily_sum", body=f"SELECT d.DAYTIME, {_standardised} FROM daily_sum d, (SELECT {STANDARD} FROM daily_sum) s"))
def m2(spark, folder):
    scaled, _ = scale.normalize(sums(spark, folder))
    return at_6(scaled)


@query("j5_apply_stats", over("daily_sum", body=f"SELECT d.*, s.* FROM daily_sum d, (SELECT {MINMAX} FROM daily_sum) s"))
def j5(spark, folder):
    daily = sums(spark, folder)
    stats = scale.minmax_stats(daily, TARGETS)
    return scale.with_stats(daily, stats, stats.columns)


@query(
    "m2_standardise_by_well",
    over(
        "well_days",
        body=f"SELECT d.WELL_BORE_CODE, d.DAYTIME, {_standardised} FROM well_days d JOIN "
        f"(SELECT WELL_BORE_CODE, {STANDARD} FROM well_days GROUP BY WELL_BORE_CODE) s ON s.WELL_BORE_CODE = d.WELL_BORE_CODE",
    ),
)
def m2_by_well(spark, folder):
    keys = ["WELL_BORE_CODE"]
    scaled, _ = scale.normalize(daily_sum(production(spark, folder), keys), TARGETS, keys)
    return at_6(scaled)


_inverse_std = ", ".join(
    f"ROUND(z.{c} * CASE WHEN s.{c}_std = 0 THEN 1e0 ELSE s.{c}_std END + s.{c}_mean, 6) AS {c}" for c in TARGETS
)


@query(
    "m3_inverse_scale",
    over(
        "daily_sum",
        body=f"SELECT z.DAYTIME, {_inverse_std} FROM (SELECT d.DAYTIME, {_scaled} FROM daily_sum d, "
        f"(SELECT {STANDARD} FROM daily_sum) s) z, (SELECT {STANDARD} FROM daily_sum) s",
    ),
)
def m3(spark, folder):
    scaled, stats = scale.normalize(sums(spark, folder))
    return at_6(scale.invert_standard(scaled, stats, TARGETS))


_inverse_minmax = ", ".join(
    f"z.{c} * CASE WHEN (s.{c}_max - s.{c}_min) = 0 THEN 1e0 ELSE (s.{c}_max - s.{c}_min) END + s.{c}_min AS {c}" for c in TARGETS
)


@query(
    "m3_inverse_minmax",
    over(
        "daily_sum",
        body=f"SELECT z.DAYTIME, {_inverse_minmax} FROM (SELECT d.DAYTIME, {_minmaxed} FROM daily_sum d, "
        f"(SELECT {MINMAX} FROM daily_sum) s) z, (SELECT {MINMAX} FROM daily_sum) s",
    ),
)
def m3_minmax(spark, folder):
    daily = sums(spark, folder)
    stats = scale.minmax_stats(daily, TARGETS)
    return scale.invert_minmax(scale.apply_minmax(daily, stats, TARGETS), stats, TARGETS)


@query("m4_minmax", over("daily_sum", body=f"SELECT d.DAYTIME, {_minmaxed} FROM daily_sum d, (SELECT {MINMAX} FROM daily_sum) s"))
def m4(spark, folder):
    daily = sums(spark, folder)
    return scale.apply_minmax(daily, scale.minmax_stats(daily, TARGETS), TARGETS)


# ---------------------------------------------------------------- target encoding

_events = "SELECT event_id, event_type, value FROM events"
_prior = "(SELECT SUM(value) / COUNT(value) FROM events)"
_before = "OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
ORDERED = (
    f"SELECT event_id, event_type, value, ROUND(CAST(COALESCE(SUM(value) {_before}, 0) AS DOUBLE), 6) AS run_sum, "
    f"CAST(COALESCE(COUNT(value) {_before}, 0) AS BIGINT) AS run_count FROM events"
)


def event_values(spark, folder):
    return read_table(spark, folder, "events").select("event_id", "event_type", "value")


@query("w3_ordered_stat", ORDERED)
def w3(spark, folder):
    return at_6(encode.ordered_stat(event_values(spark, folder), "event_type", "value", "event_id"), ["run_sum"])


@query(
    "a11_category_stats",
    f"SELECT event_type, ROUND(SUM(value), 6) AS cat_sum, COUNT(value) AS cat_count, ROUND({_prior}, 6) AS prior FROM events GROUP BY event_type",
)
def a11(spark, folder):
    events = event_values(spark, folder)
    prior = encode.prior_mean(events, "value").scalar()
    return at_6(encode.category_stats(events, "event_type", "value").withColumn("prior", prior), ["cat_sum", "prior"])


_total = "CAST(SUM(CAST(value AS DECIMAL(18,4))) {} AS DOUBLE)"


@query(
    "m5_target_encode",
    f"SELECT event_id, value, (COALESCE({_total.format(_before)}, 0) + (SELECT {_total.format('')} / COUNT(value) FROM events)) / "
    f"(COALESCE(COUNT(value) {_before}, 0) + 1) AS event_type FROM events",
)
def m5(spark, folder):
    """The values enter as decimals, so that sums and codes are the same to the last bit."""
    events = event_values(spark, folder).withColumn("value", F.col("value").cast("decimal(18,4)"))
    return encode.encode_fit(events, ["event_type"], "value", "event_id").withColumn("value", F.col("value").cast("double"))


_train = "event_type <> 'error' OR event_id < 5"
_train_prior = f"(SELECT SUM(value) / COUNT(value) FROM events WHERE {_train})"


@query(
    "m5_target_encode_apply",
    f"SELECT e.event_id, e.value, ROUND(CASE WHEN s.n > 1 THEN (s.total + {_train_prior}) / (s.n + 1) ELSE {_train_prior} END, 6) AS event_type "
    f"FROM events e LEFT JOIN (SELECT event_type, SUM(value) AS total, COUNT(value) AS n FROM events WHERE {_train} "
    "GROUP BY event_type) s ON s.event_type = e.event_type",
)
def m5_apply(spark, folder):
    events = event_values(spark, folder)
    training = events.filter((F.col("event_type") != "error") | (F.col("event_id") < 5))
    return at_6(encode.encode_apply(events, training, ["event_type"], "value"), ["event_type"])


# ---------------------------------------------------------------- splits and folds

_indexed = "SELECT *, ROW_NUMBER() OVER (ORDER BY DAYTIME) AS rn, COUNT(*) OVER () AS n FROM daily_sum"


@query(
    "m6_split_by_share",
    over("daily_sum", body=f"SELECT DAYTIME, OIL_VOL, rn, rn > n - CAST(CEIL(n * 0.2e0) AS BIGINT) AS is_test FROM ({_indexed}) z"),
)
def m6(spark, folder):
    return split.split_by_share(sums(spark, folder)).select("DAYTIME", "OIL_VOL", "rn", "is_test")


_framed = f"SELECT *, ROW_NUMBER() OVER (ORDER BY DAYTIME) AS pos, n - 20 AS m FROM ({_indexed}) y WHERE rn > 20"


@query(
    "m7_split_by_head",
    over("daily_sum", body=f"SELECT DAYTIME, OIL_VOL, pos AS rn, pos > CAST(FLOOR(m * 0.8e0) AS BIGINT) AS is_test FROM ({_framed}) z"),
)
def m7(spark, folder):
    frames = lookback(sums(spark, folder), TARGETS, 20)
    return split.split_by_head(frames).select("DAYTIME", "OIL_VOL", "rn", "is_test")


_folded = (
    "SELECT DAYTIME, rn, CASE WHEN rn - 1 >= n - 3 * (n // 4) THEN (rn - 1 - (n - 3 * (n // 4))) // (n // 4) END AS test_fold "
    f"FROM ({_indexed}) z"
)


@query("m8_time_folds", over("daily_sum", body=_folded))
def m8(spark, folder):
    return split.with_folds(sums(spark, folder)).select("DAYTIME", "rn", "test_fold")


@query(
    "w5_fold_sizes",
    over(
        "daily_sum",
        body=f"SELECT f.fold, SUM(CASE WHEN COALESCE(test_fold, -1) < f.fold THEN 1 ELSE 0 END)::BIGINT AS train_rows, "
        f"SUM(CASE WHEN test_fold = f.fold THEN 1 ELSE 0 END)::BIGINT AS test_rows FROM ({_folded}) z, range(3) f(fold) GROUP BY f.fold",
    ),
)
def w5(spark, folder):
    return split.fold_sizes(split.with_folds(sums(spark, folder)))


# ---------------------------------------------------------------- sequences


@query(
    "w1_lookback20",
    over(
        "daily_sum",
        body=f"SELECT a.DAYTIME, CAST(20 - (a.rn - b.rn) AS BIGINT) AS step, b.OIL_VOL, b.GAS_VOL, b.WAT_VOL FROM ({_indexed}) a "
        f"JOIN ({_indexed}) b ON b.rn BETWEEN a.rn - 20 AND a.rn - 1 WHERE a.rn > 20",
    ),
)
def w1(spark, folder):
    frames = lookback(sums(spark, folder), TARGETS, 20)
    steps = frames.select("DAYTIME", F.posexplode("frame").alias("step", "v"))
    return steps.select("DAYTIME", F.col("step").cast("bigint").alias("step"), *[F.get("v", F.lit(i)).alias(t) for i, t in enumerate(TARGETS)])


@query(
    "w2_next_step_label",
    over("daily_sum", body=f"SELECT DAYTIME, OIL_VOL, GAS_VOL, WAT_VOL FROM ({_indexed}) z WHERE rn > 30"),
)
def w2(spark, folder):
    return lookback(sums(spark, folder), TARGETS, 30).select("DAYTIME", *TARGETS)


_lags = ", ".join(
    f"LAG({t}, {i}) OVER (PARTITION BY WELL_BORE_CODE ORDER BY DAYTIME) AS {t}_lag{i}" for i in range(20, 0, -1) for t in TARGETS
)


@query(
    "m14_sequences_by_well",
    over(
        "well_days",
        body=f"SELECT * EXCLUDE (rn) FROM (SELECT *, {_lags}, ROW_NUMBER() OVER (PARTITION BY WELL_BORE_CODE ORDER BY DAYTIME) AS rn "
        "FROM well_days) z WHERE rn > 20",
    ),
)
def m14(spark, folder):
    keys = ["WELL_BORE_CODE"]
    return lagged(daily_sum(production(spark, folder), keys), TARGETS, 20, series_cols=keys)


# ---------------------------------------------------------------- forecasts

# Weights of the linear model of the roll-forward check, newest day last.
WEIGHTS = (0.1, 0.3, 0.5)


@query(
    "m16_recursive_forecast",
    over(
        "daily_sum",
        recursive=True,
        extra=f"""last3 AS (SELECT *, ROW_NUMBER() OVER (ORDER BY DAYTIME DESC) AS back FROM daily_sum),
walk AS (
  SELECT 0 AS step, (SELECT MAX(DAYTIME) FROM daily_sum) AS day, {", ".join(
            f"(SELECT {t} FROM last3 WHERE back = {b}) AS {t}_{b}" for t in TARGETS for b in (3, 2, 1))}
  UNION ALL
  SELECT step + 1, day + 1, {", ".join(
            f"{t}_2, {t}_1, 0e0 + {t}_3 * 0.1e0 + {t}_2 * 0.3e0 + {t}_1 * 0.5e0" for t in TARGETS)}
  FROM walk WHERE step < 90)""",
        body="SELECT CAST(day AS DATE) AS DAYTIME, OIL_VOL_1 AS OIL_VOL, GAS_VOL_1 AS GAS_VOL, WAT_VOL_1 AS WAT_VOL FROM walk WHERE step > 0",
    ),
)
def m16(spark, folder):
    width = len(TARGETS)
    weights = [[w if i % width == j else 0.0 for i, w in enumerate(w for w in WEIGHTS for _ in TARGETS)] for j in range(width)]
    recent = recent_frame(sums(spark, folder), len(WEIGHTS))
    return roll_linear(recent, weights, [0.0] * width, 90)


@query(
    "f13_shift_append",
    over(
        "daily_sum",
        body=f"SELECT a.DAYTIME, CAST(19 - (a.rn - b.rn) AS BIGINT) AS step, b.OIL_VOL FROM ({_indexed}) a "
        f"JOIN ({_indexed}) b ON b.rn BETWEEN a.rn - 19 AND a.rn WHERE a.rn > 20",
    ),
)
def f13(spark, folder):
    frames = lookback(sums(spark, folder).select("DAYTIME", "OIL_VOL"), ["OIL_VOL"], 20)
    shifted = frames.select("DAYTIME", shift_append(F.flatten("frame"), F.col("OIL_VOL")).alias("frame"))
    steps = shifted.select("DAYTIME", F.posexplode("frame").alias("step", "OIL_VOL"))
    return steps.withColumn("step", F.col("step").cast("bigint"))
