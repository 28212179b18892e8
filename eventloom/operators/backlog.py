"""Which hours and files are still to be read."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import day_of, file_hash, hour_of
from ..functions.times import hour_sequence
from ..session import scratch_path

# How far behind the newest data a run stays.
HELD_BACK_HOURS = 3
SETTLE_MINUTES = 5
NEXT_DAY_FROM_HOUR = 20
FEWEST_HOURS_AFTER_WATERMARK = 2
FEWEST_PENDING_HOURS = 1
HASH_LEDGER_HORIZON_HOURS = 24
HOUR_LEDGER_HORIZON_HOURS = 600


class LagAlert(RuntimeError):
    """Too few hours are waiting: the copy into the raw directories lags."""


def following_day(day: str) -> str:
    return (datetime.strptime(day, "%Y/%m/%d") + timedelta(days=1)).strftime("%Y/%m/%d")


# -- hours -----------------------------------------------------------------------


def next_day_hours(
    hours: DataFrame, watermark: str, from_hour: int = NEXT_DAY_FROM_HOUR
) -> DataFrame:
    """Hours of the watermark's day; late in the day those of the next day too."""
    days = [watermark[:10]]
    if int(watermark[-2:]) >= from_hour:
        days.append(following_day(watermark[:10]))
    return hours.where(day_of("date_hour").isin(days))


def hours_after(hours: DataFrame, watermark: str, missing: str = "none") -> DataFrame:
    """Hours behind the watermark.

    ``missing`` says what happens when the watermark's own hour is not listed:
    "none" gives no hours, "all" gives every hour, "fail" raises.
    """
    later = hours.where(F.col("date_hour") > watermark)
    mark = hours.where(F.col("date_hour") == watermark)
    if missing == "none":
        return later.where(mark.exists())
    if missing == "all":
        return hours.where((F.col("date_hour") > watermark) | ~mark.exists())
    if missing == "fail":
        if mark.isEmpty():
            raise ValueError(f"watermark {watermark} is not among the hours")
        return later
    raise ValueError(f"missing must be 'none', 'all' or 'fail', not {missing!r}")


def newest_hours(hours: DataFrame, n: int) -> DataFrame:
    return hours.orderBy(F.col("date_hour").desc()).limit(n)


def hold_back(hours: DataFrame, n: int = HELD_BACK_HOURS) -> DataFrame:
    """All but the newest ``n`` hours, which may still be filling."""
    return hours.join(newest_hours(hours, n), "date_hour", "left_anti")


def not_current(hours: DataFrame, current_hour: str) -> DataFrame:
    return hours.where(F.col("date_hour") != current_hour)


def pending_hours(
    hours: DataFrame,
    watermark: str,
    current_hour: str,
    held_back: int = HELD_BACK_HOURS,
    from_hour: int = NEXT_DAY_FROM_HOUR,
) -> DataFrame:
    """The hours a watermark run reads: distinct ``date_hour`` in, the same out."""
    after = hours_after(next_day_hours(hours, watermark, from_hour), watermark)
    return not_current(hold_back(after, held_back), current_hour)


def lag_rows(hours: DataFrame, at_least: int, stage: str) -> DataFrame:
    """One alert row when fewer than ``at_least`` hours are waiting, else none."""
    return (
        hours.agg(F.count("*").alias("n"), F.max("date_hour").alias("date_hour"))
        .where(F.col("n") < at_least)
        .select(
            F.lit(stage).alias("stage"),
            F.coalesce("date_hour", F.lit("")).alias("date_hour"),
            F.lit("lag").alias("kind"),
            "n",
            F.array().cast("array<string>").alias("samples"),
        )
    )


def backfill_hours(
    spark: SparkSession, first_day: str, last_day: str, watermark: str | None = None
) -> DataFrame:
    """Every hour of the days behind the watermark.

    A bare-hour watermark ("HH" or "/HH") counts within the first day; after hour
    23 that means starting over with hour 00.
    """
    hours = hour_sequence(spark, f"{first_day}/00", f"{last_day}/23")
    if watermark is None:
        return hours
    mark = watermark.strip().strip("/")
    if len(mark) == 2:
        if mark == "23":
            return hours
        mark = f"{first_day}/{mark}"
    return hours.where(F.col("date_hour") > mark)


def horizon(current_hour: str, hours: int) -> list[str]:
    """The ``hours`` + 1 hours up to the current one; what a ledger run lists again."""
    end = datetime.strptime(current_hour, "%Y/%m/%d/%H")
    return [(end - timedelta(hours=h)).strftime("%Y/%m/%d/%H") for h in range(hours, -1, -1)]


# -- files -----------------------------------------------------------------------


def settled(listing: DataFrame, now: Column, minutes: int = SETTLE_MINUTES) -> DataFrame:
    """Files untouched for more than ``minutes`` whole minutes."""
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp("modification_time")) / 60)
    return listing.where(age > minutes)


def settled_before(now: str, minutes: int = SETTLE_MINUTES) -> datetime:
    """The time before which a file must be written to be settled at ``now``: the bound to
    give to ``list_files``, which then lists exactly the files that ``settled`` keeps."""
    moment = datetime.strptime(now, "%Y-%m-%d %H:%M:%S")
    return moment - timedelta(minutes=minutes + 1) + timedelta(seconds=1)


def unseen(listing: DataFrame, hashes: DataFrame) -> DataFrame:
    """Files whose path hash is not in the file ledger."""
    return (
        listing.withColumn("hashed_path", file_hash("path"))
        .join(hashes.select("hashed_path"), "hashed_path", "left_anti")
        .select(*listing.columns)
    )


def flag_unread(listing: DataFrame, cells: DataFrame) -> DataFrame:
    """Add ``processed``: whether the file is in its hour's ledger cell."""
    known = cells.select(
        F.concat_ws("/", "date", "hour").alias("date_hour"),
        F.col("path").alias("clean_path"),
        F.lit(True).alias("processed"),
    ).distinct()
    flagged = listing.join(known, ["date_hour", "clean_path"], "left")
    return flagged.select(
        *listing.columns, F.coalesce("processed", F.lit(False)).alias("processed")
    )


def with_unread_hours(flagged: DataFrame) -> DataFrame:
    """Every file, read or not, of the hours that have an unread one."""
    unread = flagged.where("NOT processed").select("date_hour").distinct()
    return flagged.join(unread, "date_hour", "left_semi")


def group_paths(
    listing: DataFrame, by: tuple[str, ...] = ("date_hour",), path: str = "path"
) -> DataFrame:
    """The paths of each group in order: the keys, ``position`` from 1, ``path``.

    A row per path, as in the ledgers, so no list grows with the data.  Paths are dealt
    out by ranges; a position is the place in its range after the sizes of the ranges
    before, so a group with very many paths is numbered by many tasks.
    """
    keys = list(by)
    table = scratch_path(listing.sparkSession, "path-ranges")
    ranged = listing.select(*keys, F.col(path).alias("path")).repartitionByRange(*keys, "path")
    ranged.withColumn("range", F.spark_partition_id()).write.parquet(table)
    ranged = listing.sparkSession.read.parquet(table)
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # one row per group and range
    sizes = (
        ranged.groupBy(*keys, "range")
        .agg(F.count("*").alias("n"))
        .select(*keys, "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    place = F.row_number().over(Window.partitionBy(*keys, "range").orderBy("path"))
    return (
        ranged.withColumn("place", place)
        .join(sizes, [*keys, "range"])
        .select(*keys, (F.col("before") + F.col("place")).alias("position"), "path")
    )


def unread_by_hour(flagged: DataFrame) -> DataFrame:
    """Unread paths per date and hour in order; hours with none have no row."""
    unread = flagged.where("NOT processed").select(
        day_of("date_hour").alias("date"), hour_of("date_hour").alias("hour"), "clean_path"
    )
    return group_paths(unread, ("date", "hour"), "clean_path")


def append_listings(*listings: DataFrame) -> DataFrame:
    """All rows of several listings; a file that is listed twice stays twice."""
    rows = listings[0]
    for more in listings[1:]:
        rows = rows.unionByName(more)
    return rows


def not_read(listing: DataFrame, read: DataFrame) -> DataFrame:
    """Paths of a listing less those of another, each counted as often as it is listed."""
    return listing.select("path").exceptAll(read.select("path"))
