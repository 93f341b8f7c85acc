"""Projection, cast and completeness operators of the clean step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

def parse_date(
    df: DataFrame, source: str, target: str = "DAYTIME", formats: tuple[str, ...] = ()
) -> DataFrame:
    """The date part of ISO text, or of the first given format that fits; text
    that fits none becomes null."""
    column = F.col(source)
    if isinstance(df.schema[source].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(target, F.to_date(column))
    parsed = [F.to_date(F.try_to_timestamp(column, F.lit(f))) for f in formats]
    return df.withColumn(target, F.coalesce(*parsed) if parsed else column.try_cast("date"))


def drop_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every given column; plain conditions reach the scan."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def present(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def strict_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text that is no number fails the query (Spark's ANSI cast)."""
    return df.withColumns({c: F.col(c).cast("double") for c in present(df, columns)})


def lenient_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in present(df, columns)})


def text_cast(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in present(df, columns)})


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = floats if columns is None else [c for c in columns if c in floats]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in chosen})


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many values of each column are null, in a single pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def observed(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Observation]:
    """The frame, and an observation that its first action fills: ``row_count`` and the nulls of every column.

    The action that writes the frame counts on the way; no pass of its own is needed. Observe
    last, so that the counts belong to the writing stage, whose tasks count once each."""
    found = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    return df.observe(found, F.count(F.lit(1)).alias("row_count"), *nulls), found


def null_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, nulls``: one row per audited column."""
    return null_counts(df, columns).unpivot([], columns, "column", "nulls")


def filled_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    return df.agg(*[F.count(c).alias(c) for c in columns])


def all_null_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Names of the columns that hold no value at all; one aggregate for all."""
    counts = filled_counts(df, columns).first()
    return [c for c, filled in counts.asDict().items() if filled == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.drop(*all_null_columns(df))


def conform(
    df: DataFrame, schema: T.StructType, required: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """The columns of ``schema`` (and those to ``keep``): a required one that is
    missing is an error naming it, an optional one is filled with nulls."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {', '.join(missing)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *keep,
    )


def quantise(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Round to the declared decimal types, half away from zero; a value too
    large for its type fails the query."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no rows to process")
    return df


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def feature_columns(df: DataFrame, targets: list[str], keys: tuple[str, ...] = ()) -> list[str]:
    """All columns but the targets (the day stays a feature) and the series keys."""
    return [c for c in df.columns if c not in targets and c not in keys]


def tag_rows(df: DataFrame, **literals: str) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def resolve_alias(df: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate that is a column of the frame."""
    found = present(df, candidates)
    return found[0] if found else None


def stage_count(df: DataFrame, stage: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(stage).alias("stage"), "row_count")


def stage_counts(stages: dict[str, tuple[DataFrame, Column | None]]) -> DataFrame:
    """Row counts of several stages; stages that are filters of one frame are
    given as conditions and share one scan."""
    by_frame: dict[int, tuple[DataFrame, list[tuple[str, Column]]]] = {}
    for name, (df, condition) in stages.items():
        _, tests = by_frame.setdefault(id(df), (df, []))
        tests.append((name, F.lit(True) if condition is None else condition))
    result = None
    for df, tests in by_frame.values():
        names = [name for name, _ in tests]
        counts = df.agg(*[F.count_if(test).alias(name) for name, test in tests])
        rows = counts.unpivot([], names, "stage", "row_count")
        result = rows if result is None else result.unionByName(rows)
    return result
