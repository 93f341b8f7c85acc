"""Sums and means that are right at any magnitude.

A column is added in its own type: decimals (all stored columns) stay exact up to
38 digits and don't depend on the partitioning; doubles keep their full
relative precision, and only their last bits may vary with the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(column: Column | str) -> Column:
    return F.sum(column).cast("double")


def mean(column: Column | str) -> Column:
    return total(column) / F.count(column)


def significant(column: Column | str, digits: int = 7) -> Column:
    """A double rounded to ``digits`` significant digits."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.isNotNull(), F.format_string(f"%.{digits - 1}e", column.cast("double")).cast("double"))
