"""Epoch and calendar expressions.

The session zone is pinned to UTC (``eventloom.session.prepare``); any other
zone is an explicit argument, never the zone of the machine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The time patterns used in paths, envelopes and ledgers.
DAY = "yyyy-MM-dd"
HOUR_PATH = "yyyy/MM/dd/HH"
SECOND = "yyyy-MM-dd HH:mm:ss"
COMPACT_DAY = "yyyyMMdd"
FILE_STAMP = "yyyy-MM-dd_HH-mm-ss"
DAY_PATH = "yyyy/MM/dd"
MINUTE = "yyyy-MM-dd HH:mm"
RUN_STAMP = "yyyyMMddHHmmss"
PACIFIC_ZONE = "America/Los_Angeles"
INDIA_ZONE = "Asia/Kolkata"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The epoch milliseconds of the years 1 to 9999.
FIRST_MILLIS = -62_135_596_800_000
LAST_MILLIS = 253_402_300_799_999


def valid_millis(millis: Column | str) -> Column:
    """The milliseconds where they are a time of the years 1 to 9999, else null."""
    return F.when(_col(millis).between(FIRST_MILLIS, LAST_MILLIS), _col(millis))


def epoch_to_text(millis: Column | str, pattern: str = SECOND, zone: str = "UTC") -> Column:
    """Epoch milliseconds as text in ``zone``; the milliseconds are cut off.

    Null outside the years 1 to 9999.
    """
    instant = F.timestamp_millis(valid_millis(millis))
    local = instant if zone == "UTC" else F.from_utc_timestamp(instant, zone)
    return F.date_format(local, pattern)


def epoch_to_pacific(millis: Column | str) -> Column:
    return epoch_to_text(millis, SECOND, PACIFIC_ZONE)


def in_zone(utc_time: Column | str, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC timestamp."""
    return F.from_utc_timestamp(_col(utc_time), zone)


def format_time(time: Column | str, pattern: str) -> Column:
    return F.date_format(_col(time), pattern)


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds of a timestamp column, with or without time zone."""
    if df.schema[name].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01', `{name}`)")
    return F.unix_millis(F.col(name))


def _sequence(first: Column, last: Column, step: str) -> Column:
    """All steps from first to last; no rows where last comes before first."""
    return F.explode(F.when(first <= last, F.sequence(first, last, F.expr(f"interval {step}"))))


def hour_sequence(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``date_hour`` rows from ``start`` to ``end`` ("yyyy/MM/dd/HH"), both included."""
    first, last = (F.to_timestamp(F.lit(bound), HOUR_PATH) for bound in (start, end))
    steps = spark.range(1).select(_sequence(first, last, "1 hour").alias("t"))
    return steps.select(F.date_format("t", HOUR_PATH).alias("date_hour"))


def day_sequence(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``date`` rows from ``start`` to ``end`` ("yyyy/MM/dd"), both included."""
    first, last = (F.to_date(F.lit(bound), DAY_PATH) for bound in (start, end))
    steps = spark.range(1).select(_sequence(first, last, "1 day").alias("d"))
    return steps.select(F.date_format("d", DAY_PATH).alias("date"))
