"""Scalar expressions: dates, names, text and arrays."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

SUPPORTED_SUFFIXES = (".xlsx", ".xls", ".csv", ".json", ".txt")
SECONDS_PER_DAY = 86_400


def epoch_of_day(day: Column | str) -> Column:
    """Seconds since 1970-01-01 of a date; independent of the session zone."""
    return F.unix_date(day) * F.lit(SECONDS_PER_DAY).cast("bigint")


def from_epoch(seconds: Column | str) -> Column:
    return F.timestamp_seconds(seconds)


def date_part(stamp: Column | str) -> Column:
    return F.to_date(stamp)


def following_days(day: Column, n: int) -> Column:
    """Array of the ``n`` dates after ``day``."""
    return F.sequence(F.date_add(day, 1), F.date_add(day, n))


def strip_extension(path: Column | str) -> Column:
    return F.regexp_replace(path, r"\.[^.]*$", "")


def has_suffix(path: Column, suffixes: tuple[str, ...] = SUPPORTED_SUFFIXES) -> Column:
    test = F.lit(False)
    for suffix in suffixes:
        test = test | path.endswith(suffix)
    return test


def pseudonym(column: Column | str) -> Column:
    """SHA-256 of the text, in hex."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sha2(column.cast("string"), 256)


def shift_append(window: Column, newest: Column) -> Column:
    """Drop the oldest element of an array and add ``newest`` at its end."""
    return F.concat(F.slice(window, F.lit(2), F.size(window) - 1), F.array(newest))


def as_json(column: Column | str) -> Column:
    return F.to_json(column)


def stamp_text(stamp: Column, pattern: str = "yyyy-MM-dd_HH-mm-ss") -> Column:
    return F.date_format(stamp, pattern)


def stamped_name(prefix: str, now: dt.datetime | None = None) -> str:
    return f"{prefix}_{(now or dt.datetime.now()).strftime('%Y-%m-%d_%H-%M-%S')}"


def new_id() -> str:
    """One id per run, made on the driver so that all rows share it."""
    return str(uuid.uuid4())
