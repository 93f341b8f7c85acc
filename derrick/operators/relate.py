"""Joins and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.functions.scalars import pseudonym
from derrick.operators.window import latest_per_key
from derrick.schema import MODEL_AI, VERSION_SOURCE


def join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Bring two frames side by side by series and day instead of by position."""
    return left.join(right, keys)


def rows_if_absent(base: DataFrame, new: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """Rows of ``new`` whose key ``base`` lacks, the first writer of each key.

    Duplicates go before the join, so a hot key is a single row in it.
    """
    first = latest_per_key(new, keys, sequence, first=True)
    return first.join(base.select(*keys), keys, "left_anti")


def insert_if_absent(base: DataFrame, new: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    return base.unionByName(rows_if_absent(base, new, keys, sequence).select(*base.columns))


def semi_match(df: DataFrame, registry: DataFrame, key: str, secret: str, hashed: str) -> DataFrame:
    """Rows whose key and hashed secret stand in the registry together."""
    known = registry.select(key, hashed)
    probe = df.withColumn(hashed, pseudonym(secret))
    return probe.join(known, [key, hashed], "left_semi")


def stack_predictions(frames: list[DataFrame]) -> DataFrame:
    """Predictions of several models as one table."""
    names = MODEL_AI.fieldNames()
    return reduce(DataFrame.unionByName, [f.select(*names) for f in frames])


def one_per_key(updates: DataFrame, keys: list[str], sequence: list[str] | None = None) -> DataFrame:
    """The last update of each key in ``sequence`` order. Without one no update could be the last, so a
    second update of a key is an error."""
    if sequence:
        return latest_per_key(updates, keys, sequence)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    several = F.raise_error(F.lit(f"several updates of one {', '.join(keys)} need a sequence")).cast("boolean")
    return updates.withColumn("_n", n).filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(several)).drop("_n")


def changed_rows(base: DataFrame, updates: DataFrame, keys: list[str], version: str, images: list[str]) -> DataFrame:
    """The updates (one per key) that are not older than what the base holds under their key. ``_old`` has the
    named columns of the row that each replaces, null for a new key. Of the base only keys, version and images are read.
    With images, a row that comes again from the same file as it is stored is no change."""
    old = base.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(version, *images).alias("_old"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    stored, given = F.col(f"_old.{version}"), F.col(version)
    wins = stored.isNull() | given.isNull() | (given >= stored)
    if images:
        fields = [*[(f"{version}.{c}", f"_old.{version}.{c}") for c in VERSION_SOURCE], *[(c, f"_old.{c}") for c in images]]
        again = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(was)) for c, was in fields])
        wins = stored.isNull() | given.isNull() | ((given >= stored) & ~again)
    return updates.join(old, same, "left").filter(wins).drop(*[f"_{k}" for k in keys])


def replace_rows(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The base with ``rows`` in place of its rows of the same keys. The base is only filtered, not sorted by a rank."""
    kept = base.join(rows.select(*keys), keys, "left_anti")
    return kept.unionByName(rows.drop(*[c for c in rows.columns if c not in base.columns]), allowMissingColumns=True).select(*base.columns)


def merge_latest(
    base: DataFrame, updates: DataFrame, keys: list[str], sequence: list[str] | None = None
) -> DataFrame:
    """Upsert as one set operation: every update row replaces the whole base row
    of its key (nulls included); of several updates the last one wins.

    ``sequence`` orders the updates; it need not be a column of the base. The
    base holds one row per key already, so only the updates are ranked.
    """
    return replace_rows(base, one_per_key(updates, keys, sequence), keys)
