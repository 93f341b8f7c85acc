"""Places of rows in a global order, without bringing any group of rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derrick.session import cut_lineage

_ROWS_OF_A_PART = 33  # bits that ``monotonically_increasing_id`` gives to the row of a partition


def with_places(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``df`` with ``pos``, the row's place in its group from 0, and ``n``, the rows of the group.

    Rows are dealt to tasks by ranges of group and order; a place is the row's number in its
    task plus the rows of the group in earlier tasks. Only (task, group) counts meet
    in a window. Rows that are equal in group and order are split over tasks too, as the
    place in the input goes last. ``df`` should be a written table, since it is read for the ranges and again for the rows.
    """
    keys = [*[F.col(c) for c in group], *order, F.col("_tie")]
    rows = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = cut_lineage(rows.drop("_tie").withColumn("_row", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_row", _ROWS_OF_A_PART))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part", *group).agg(F.min("_row").alias("_first"), F.count("*").alias("_count"))
    starts = counts.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_count").over(whole).alias("n"),
    )
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(starts, same).select(*df.columns, (F.col("_row") + F.col("_shift")).alias("pos"), "n")
