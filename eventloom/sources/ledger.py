"""Progress records: watermark, file ledger by path hash, hour ledger by path."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import date_hour_of_path, day_of, file_hash, hour_of
from ..functions.times import MINUTE, format_time

# One schema for the file ledger; files written with other columns still read,
# with nulls for what they lack.
HASH_LEDGER_SCHEMA = "hashed_path string, path string, datetime string, date string"
# The partition of files whose path names no day, and of entries of older ledgers.
NO_DAY = "none"
HOUR_LEDGER_SCHEMA = "path string, date string, hour string"


def _read_or_empty(spark: SparkSession, schema: str, path: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


# -- watermark ---------------------------------------------------------------


def read_watermark(spark: SparkSession, path: str) -> str:
    """The last hour read: the first line of a one-line text file."""
    row = spark.read.text(path).first()
    if row is None:
        raise ValueError(f"no watermark in {path}")
    return row.value.replace("\x00", "").strip()


def write_watermark(spark: SparkSession, date_hour: str, path: str) -> None:
    line = spark.range(1).select(F.lit(date_hour).alias("value"))
    line.coalesce(1).write.mode("overwrite").text(path)


# -- file ledger ---------------------------------------------------------------


def read_hash_ledger(
    spark: SparkSession, path: str, days: list[str] | None = None
) -> DataFrame:
    """Hashes of the files already read, maybe repeated; empty before the first run.

    ``date`` is the directory partition: with ``days`` ("yyyy/MM/dd") only theirs are
    read, and that of paths without a day.
    """
    ledger = _read_or_empty(spark, HASH_LEDGER_SCHEMA, path)
    if days is not None:
        wanted = [NO_DAY, *[d.replace("/", "-") for d in days]]
        ledger = ledger.where(F.col("date").isin(wanted))
    return ledger.select("hashed_path")


def hash_entries(listing: DataFrame) -> DataFrame:
    day = F.translate(day_of(date_hour_of_path("path")), "/", "-")
    return listing.select(
        file_hash("path").alias("hashed_path"),
        "path",
        format_time("modification_time", MINUTE).alias("datetime"),
        F.when(day == "", NO_DAY).otherwise(day).alias("date"),
    )


def _write_hashes(listing: DataFrame, path: str, mode: str) -> None:
    rows = hash_entries(listing).hint("rebalance", "date")
    rows.write.mode(mode).partitionBy("date").parquet(path)


def append_hashes(listing: DataFrame, path: str) -> None:
    _write_hashes(listing, path, "append")


def bootstrap_hashes(listing: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Seed the ledger with files that count as read, as before a first run."""
    _write_hashes(listing, path, mode)


# -- hour ledger -----------------------------------------------------------------


def read_hour_ledger(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """``(date, hour, path)``, one row per path, optionally for given days only.

    ``date`` is the directory partition, so a date filter reads only those days.
    """
    ledger = _read_or_empty(spark, HOUR_LEDGER_SCHEMA, path)
    if dates is not None:
        ledger = ledger.where(F.col("date").isin([d.replace("/", "-") for d in dates]))
    return ledger.select(F.translate("date", "-", "/").alias("date"), "hour", "path")


def hour_cells(listing: DataFrame) -> DataFrame:
    return listing.select(
        F.translate(day_of("date_hour"), "/", "-").alias("date"),
        hour_of("date_hour").alias("hour"),
        F.col("clean_path").alias("path"),
    )


def replace_hour_cells(listing: DataFrame, path: str) -> None:
    """Make each listed hour's cell hold exactly the files listed for it.

    Only the cells of listed hours are overwritten.  Rebalancing keeps one file
    per cell while splitting a cell too large for one task.
    """
    (
        hour_cells(listing)
        .hint("rebalance", "date", "hour")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "hour")
        .parquet(path)
    )
