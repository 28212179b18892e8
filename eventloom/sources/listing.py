"""File listings with modification times, without opening any file."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import clean_path, date_hour_of_path

LISTING_SCHEMA = (
    "path string, clean_path string, date_hour string, modification_time timestamp, length bigint"
)


def raw_directory(part: str, partitioned: bool = False) -> str:
    """Directory of a day ``yyyy/MM/dd`` or hour ``yyyy/MM/dd/HH`` below the root.

    Partitioned roots name it ``date=yyyy-MM-dd`` or ``date=yyyy-MM-dd/hour=HH``.
    """
    if not partitioned:
        return part
    day = f"date={part[:10].replace('/', '-')}"
    return day if len(part) == 10 else f"{day}/hour={part[-2:]}"


def list_files(
    spark: SparkSession,
    root: str,
    parts: Sequence[str] | None = None,
    partitioned: bool = False,
    before: datetime | None = None,
    after: datetime | None = None,
) -> DataFrame:
    """Files below ``root``, or only below the directories of the given days or hours.

    Files modified at ``before`` or later, or at ``after`` or earlier (UTC), are left out by
    the file index itself, so they take no part in anything that follows.

    Days and hours without a directory add nothing; if none exists the listing is empty.
    Only names and times are selected, so the file contents are pruned from the
    scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    for name, bound in (("modifiedBefore", before), ("modifiedAfter", after)):
        if bound is not None:
            reader = reader.option(name, bound.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    if parts is None:
        target = root
    elif len(parts) == 0:
        return spark.createDataFrame([], LISTING_SCHEMA)
    else:
        names = ",".join(raw_directory(part, partitioned) for part in parts)
        target = f"{root.rstrip('/')}/{{{names}}}"
    try:
        files = reader.load(target)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LISTING_SCHEMA)
        raise
    return files.select(
        "path",
        clean_path("path").alias("clean_path"),
        date_hour_of_path("path").alias("date_hour"),
        F.col("modificationTime").alias("modification_time"),
        "length",
    )


def list_hours(listing: DataFrame) -> DataFrame:
    """The distinct hours a listing holds files for."""
    return listing.where("date_hour <> ''").select("date_hour").distinct()
