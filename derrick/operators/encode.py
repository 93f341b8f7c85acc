"""Ordered target encoding of text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.functions.exact import mean
from derrick.session import shuffle_width

MAX_SLICES = 10_000


def category_stats(df: DataFrame, cat: str, target: str) -> DataFrame:
    """Sum and count of the target per category."""
    return df.groupBy(cat).agg(F.sum(target).cast("double").alias("cat_sum"), F.count(target).alias("cat_count"))


def prior_mean(df: DataFrame, target: str) -> DataFrame:
    return df.agg(mean(target).alias("prior"))


def _sliced(df: DataFrame, order: str) -> DataFrame:
    """Add ``_slice``: the rows cut into runs of about equal size along ``order``."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        position = F.unix_date(order)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        position = F.unix_micros(F.col(order).cast("timestamp"))
    else:
        position = F.col(order)
    df = df.withColumn("_position", position.cast("double"))
    slices = max(2, min(MAX_SLICES, 2 * shuffle_width(df.sparkSession)))
    marks = [i / slices for i in range(1, slices)]
    cuts = df.agg(F.percentile_approx("_position", marks).alias("cuts")).first()["cuts"] or []
    edges = [float("-inf"), *sorted(set(cuts) or {0.0}), float("inf")]
    cutter = Bucketizer(splits=edges, inputCol="_position", outputCol="_slice", handleInvalid="keep")
    return cutter.transform(df).drop("_position")


def ordered_stat(df: DataFrame, cat: str, target: str, order: str) -> DataFrame:
    """Add ``run_sum`` and ``run_count``: the target over the earlier rows of the
    same category, in ``order`` (a unique sequence column).

    A running sum per category would send a hot category to one task. The rows
    are cut into slices along the order instead: slice totals are added up per
    category first (few rows), and each row needs only its own slice besides.
    """
    sliced = _sliced(df, order)
    totals = sliced.groupBy(cat, "_slice").agg(
        F.sum(target).alias("_sum"), F.count(target).alias("_count")
    )
    earlier = Window.partitionBy(cat).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col(cat).alias("_cat"),
        F.col("_slice").alias("_cat_slice"),
        F.sum("_sum").over(earlier).alias("_carried_sum"),
        F.sum("_count").over(earlier).alias("_carried_count"),
    )
    joined = sliced.join(
        carried, F.col(cat).eqNullSafe(F.col("_cat")) & (F.col("_slice") == F.col("_cat_slice")), "left"
    )
    within = Window.partitionBy(cat, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    run_sum = F.coalesce("_carried_sum", zero) + F.coalesce(F.sum(target).over(within), zero)
    run_count = F.coalesce(F.col("_carried_count"), F.lit(0)) + F.count(target).over(within)
    return joined.withColumns({"run_sum": run_sum.cast("double"), "run_count": run_count.cast("bigint")}).select(
        *df.columns, "run_sum", "run_count"
    )


def encode_fit(df: DataFrame, text_columns: list[str], target: str, order: str) -> DataFrame:
    """Replace each text column by (running sum + prior) / (running count + 1)."""
    prior = prior_mean(df, target)

    def encode_one(frame: DataFrame, column: str) -> DataFrame:
        encoded = (F.col("run_sum") + prior.scalar()) / (F.col("run_count") + 1)
        return ordered_stat(frame, column, target, order).withColumn(column, encoded).drop("run_sum", "run_count")

    return reduce(encode_one, text_columns, df)


def encode_apply(df: DataFrame, training: DataFrame, text_columns: list[str], target: str) -> DataFrame:
    """Encode other rows by the full statistics of the training rows; a category
    that is unseen or stands in one training row gets the prior."""
    prior = prior_mean(training, target)

    def encode_one(frame: DataFrame, column: str) -> DataFrame:
        stats = category_stats(training.filter(F.col(column).isNotNull()), column, target)
        value = (F.col("cat_sum") + prior.scalar()) / (F.col("cat_count") + 1)
        known = frame.join(stats, column, "left")
        return (
            known.withColumn(column, F.when(F.col("cat_count") > 1, value).otherwise(prior.scalar()))
            .select(*frame.columns)
        )

    return reduce(encode_one, text_columns, df)
