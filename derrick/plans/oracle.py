"""SQL text shared by the oracles: the same derivation as ``plans.wells``.

Stored decimals are written as doubles of the declared scale, rounded half away
from zero on integers, which is what the decimal cast of the plan does.
"""

from __future__ import annotations

from derrick.schema import READINGS, TARGETS, VOLUMES


def at_scale(column: str, scale: int) -> str:
    step = 10 ** (6 - scale)
    units = f"(CAST(ROUND({column} * 1000000) AS BIGINT) + {step // 2}) // {step}"
    return f"CAST({units} AS DOUBLE) / 1e{scale}"


_stored = ",\n    ".join(
    [f"{at_scale(c, 2)} AS {c}" for c in READINGS]
    + [f"{at_scale(c, 3)} AS {c}" for c in VOLUMES if c != "BORE_WI_VOL"]
    + ["BORE_WI_VOL"]
)

WELL_RAW = """well_raw AS (
  SELECT
    CASE WHEN l_orderkey % 97 = 0 THEN 'bad' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS DATEPRD,
    CONCAT('W-', CAST(l_suppkey AS VARCHAR)) AS WELL_BORE_CODE,
    CAST(l_suppkey AS VARCHAR) AS NPD_WELL_BORE_CODE,
    CONCAT('WELL ', CAST(l_suppkey AS VARCHAR)) AS NPD_WELL_BORE_NAME,
    CAST(l_suppkey % 5 AS VARCHAR) AS NPD_FIELD_CODE,
    CONCAT('FIELD ', CAST(l_suppkey % 5 AS VARCHAR)) AS NPD_FIELD_NAME,
    CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_returnflag END AS WELL_TYPE,
    CASE WHEN l_linestatus = 'F' THEN 'production' ELSE 'injection' END AS FLOW_KIND,
    '%' AS AVG_CHOKE_UOM,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_discount * 240 END AS ON_STREAM_HRS,
    CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_extendedprice / 100 END AS AVG_DOWNHOLE_PRESSURE,
    CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE 80 + l_quantity / 2 END AS AVG_DOWNHOLE_TEMPERATURE,
    l_extendedprice / 200 AS AVG_DP_TUBING,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax * 300 END AS AVG_ANNULUS_PRESS,
    l_discount * 1000 AS AVG_CHOKE_SIZE_P,
    l_tax * 1000 AS AVG_WHP_P,
    20 + l_quantity AS AVG_WHT_P,
    l_tax * 500 AS DP_CHOKE_SIZE,
    l_quantity AS BORE_OIL_VOL,
    l_quantity * (1 + l_discount) * 10 AS BORE_GAS_VOL,
    l_quantity * l_tax * 5 AS BORE_WAT_VOL,
    CAST(NULL AS DOUBLE) AS BORE_WI_VOL,
    l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
  FROM lineitem)"""

ORDER = (
    "l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC, "
    "l_extendedprice DESC, l_discount DESC, l_tax DESC, l_shipdate DESC"
)

CLEAN = f"""clean AS (
  SELECT TRY_CAST(DATEPRD AS DATE) AS DAYTIME, WELL_BORE_CODE, NPD_WELL_BORE_CODE, NPD_WELL_BORE_NAME,
    NPD_FIELD_CODE, NPD_FIELD_NAME, WELL_TYPE, FLOW_KIND, AVG_CHOKE_UOM,
    {_stored},
    l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
  FROM well_raw WHERE TRY_CAST(DATEPRD AS DATE) IS NOT NULL)"""

PWELL = f"""pwell AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY DAYTIME, WELL_BORE_CODE ORDER BY {ORDER}) AS rn FROM clean) z
  WHERE rn = 1)"""


def fixed_mean(column: str, scale: int, alias: str) -> str:
    return f"SUM(ROUND({column} * 1e{scale})) / 1e{scale} / COUNT({column}) AS {alias}"


def fixed_sum(column: str, scale: int, alias: str) -> str:
    return f"SUM(ROUND({column} * 1e{scale})) / 1e{scale} AS {alias}"


def significant(expression: str, digits: int = 7) -> str:
    return f"CAST(format('{{:.{digits - 1}e}}', CAST({expression} AS DOUBLE)) AS DOUBLE)"


DAILY_AVG = (
    "daily_avg AS (SELECT CAST(epoch(DAYTIME) AS BIGINT) AS DAYTIME, "
    + ", ".join(
        [fixed_mean(f"BORE_{t}", 3, t) for t in TARGETS] + [fixed_mean(c, 2, c) for c in READINGS]
    )
    + " FROM pwell GROUP BY pwell.DAYTIME)"
)
# Readings that are missing every so many days in ``field_avg``.
OUT_OF_SERVICE = {"AVG_ANNULUS_PRESS": 11, "ON_STREAM_HRS": 13}
FIELD_AVG = (
    "field_avg AS (SELECT NPD_FIELD_CODE, DAYTIME, "
    + ", ".join(
        [*TARGETS]
        + [f"CASE WHEN DAYTIME // 86400 % {OUT_OF_SERVICE[c]} <> 0 THEN {c} END AS {c}" if c in OUT_OF_SERVICE else c for c in READINGS]
    )
    + " FROM (SELECT NPD_FIELD_CODE, CAST(epoch(DAYTIME) AS BIGINT) AS DAYTIME, "
    + ", ".join(
        [fixed_mean(f"BORE_{t}", 3, t) for t in TARGETS] + [fixed_mean(c, 2, c) for c in READINGS]
    )
    + " FROM pwell GROUP BY NPD_FIELD_CODE, pwell.DAYTIME) AS means)"
)
DAILY_SUM = (
    "daily_sum AS (SELECT DAYTIME, "
    + ", ".join([fixed_sum(f"BORE_{t}", 3, t) for t in TARGETS])
    + " FROM pwell GROUP BY DAYTIME)"
)
WELL_DAYS = (
    "well_days AS (SELECT WELL_BORE_CODE, DAYTIME, "
    + ", ".join([fixed_sum(f"BORE_{t}", 3, t) for t in TARGETS])
    + " FROM pwell GROUP BY WELL_BORE_CODE, DAYTIME)"
)
MODEL_AI = """model_ai AS (
  SELECT 'persistence' AS id_model, 'PERSISTENCE' AS model_type, DAYTIME,
    OIL_VOL AS OIL_VOL_test, GAS_VOL AS GAS_VOL_test, WAT_VOL AS WAT_VOL_test,
    OIL_VOL_pred, GAS_VOL_pred, WAT_VOL_pred
  FROM (SELECT *, LAG(OIL_VOL) OVER (ORDER BY DAYTIME) AS OIL_VOL_pred,
          LAG(GAS_VOL) OVER (ORDER BY DAYTIME) AS GAS_VOL_pred,
          LAG(WAT_VOL) OVER (ORDER BY DAYTIME) AS WAT_VOL_pred,
          ROW_NUMBER() OVER (ORDER BY DAYTIME) AS rn FROM daily_sum) z
  WHERE rn > 1)"""
REPORT = """report AS (
  SELECT model_type, DAYTIME, target, CASE WHEN target = 'GAS' THEN 'mcf/d' ELSE 'bbl/d' END AS unit,
    actual, predicted, CASE WHEN ABS(actual - predicted) > 80 THEN 'Check' ELSE 'Normal' END AS status
  FROM (
    SELECT model_type, DAYTIME, 'OIL' AS target, OIL_VOL_test AS actual, OIL_VOL_pred AS predicted FROM model_ai
    UNION ALL SELECT model_type, DAYTIME, 'GAS', GAS_VOL_test, GAS_VOL_pred FROM model_ai
    UNION ALL SELECT model_type, DAYTIME, 'WAT', WAT_VOL_test, WAT_VOL_pred FROM model_ai) z)"""

_STEPS = {
    "well_raw": ([], WELL_RAW),
    "clean": (["well_raw"], CLEAN),
    "pwell": (["well_raw", "clean"], PWELL),
    "daily_avg": (["well_raw", "clean", "pwell"], DAILY_AVG),
    "field_avg": (["well_raw", "clean", "pwell"], FIELD_AVG),
    "daily_sum": (["well_raw", "clean", "pwell"], DAILY_SUM),
    "well_days": (["well_raw", "clean", "pwell"], WELL_DAYS),
    "model_ai": (["well_raw", "clean", "pwell", "daily_sum"], MODEL_AI),
    "report": (["well_raw", "clean", "pwell", "daily_sum", "model_ai"], REPORT),
}


def over(*names: str, body: str, extra: str = "", recursive: bool = False) -> str:
    """``body`` with the named shared steps (and what they need) in front."""
    needed = [s for s in _STEPS if any(s == n or s in _STEPS[n][0] for n in names)]
    steps = [_STEPS[s][1] for s in needed] + ([extra] if extra else [])
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(steps) + "\n" + body
