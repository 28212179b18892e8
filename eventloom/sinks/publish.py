"""Where finished rows go."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import day_of, hour_of
from ..sources.listing import list_files, list_hours


def hour_columns(df: DataFrame) -> DataFrame:
    """Add the partition columns ``date`` (yyyy-MM-dd) and ``hour``."""
    return df.withColumns(
        {
            "date": F.translate(day_of("date_hour"), "/", "-"),
            "hour": hour_of("date_hour"),
        }
    )


def _by_hour(envelopes: DataFrame, gather: bool) -> DataFrame:
    rows = hour_columns(envelopes).select("date", "hour", F.col("envelope").alias("value"))
    return rows.hint("rebalance", "date", "hour") if gather else rows


def write_by_hour(
    envelopes: DataFrame, path: str, if_exists: str = "replace", gather: bool = True
) -> None:
    """Envelope text under ``date=/hour=``.

    ``gather`` shuffles the rows so that hours do not shatter into one file per
    task; it splits an hour that is too big for one task.  Without it every task
    writes the hours it has, which saves the shuffle where a run covers few hours.

    "replace" swaps exactly the hours at hand, so repeating a run changes nothing.
    Use it only where a run holds whole hours.  "error" refuses to write when any of
    the hours at hand is there already.
    """
    writer = _by_hour(envelopes, gather).write.partitionBy("date", "hour")
    if if_exists == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").text(path)
    elif if_exists == "error":
        written = list_hours(list_files(envelopes.sparkSession, path))
        clash = envelopes.select("date_hour").distinct().join(written, "date_hour", "left_semi")
        hour = clash.agg(F.min("date_hour")).first()[0]
        if hour is not None:
            raise FileExistsError(f"{path} already holds hour {hour}")
        writer.mode("append").text(path)
    else:
        raise ValueError(f"if_exists must be 'replace' or 'error', not {if_exists!r}")


def write_by_run(envelopes: DataFrame, path: str, run: str, gather: bool = True) -> None:
    """Envelope text under ``run=/date=/hour=``: an hour may be added to by later runs.

    Repeating a run replaces that run's directory and nothing else.
    """
    _by_hour(envelopes, gather).write.partitionBy("date", "hour").mode("overwrite").text(
        f"{path}/run={run}"
    )


def drop_other_runs(spark: SparkSession, path: str, run: str, hours: list[str]) -> None:
    """Delete what runs but ``run`` have published by ``write_by_run`` for these hours."""
    if not hours:
        return
    names = ",".join(f"date={h[:10].replace('/', '-')}/hour={h[-2:]}" for h in hours)
    jvm = spark._jvm.org.apache.hadoop.fs
    pattern = jvm.Path(f"{path}/run=*/{{{names}}}")
    system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in system.globStatus(pattern) or []:
        folder = found.getPath()
        if folder.getParent().getParent().getName() != f"run={run}":
            system.delete(folder, True)


def drop_hours_of_runs(spark: SparkSession, path: str, pairs: Iterable[tuple[str, str]]) -> None:
    """Delete what ``write_by_run`` wrote for these (run, date_hour)."""
    jvm = spark._jvm.org.apache.hadoop.fs
    for run, hour in pairs:
        folder = jvm.Path(f"{path}/run={run}/date={hour[:10].replace('/', '-')}/hour={hour[-2:]}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_rows(rows: DataFrame, path: str, run: str) -> None:
    """Rows as Parquet under ``run=``; repeating a run replaces its directory."""
    rows.write.mode("overwrite").parquet(f"{path}/run={run}")


def publish_topic(
    envelopes: DataFrame,
    topic: str,
    sink: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> None:
    """Envelope strings to a topic: values only, no key.

    The Kafka sink delivers at least once.  Any other Spark sink that takes a
    ``value`` column can stand in for it.
    """
    values = envelopes.select(F.col("envelope").alias("value"))
    settings = dict(options or {})
    if sink == "kafka":
        settings["topic"] = topic
        values.write.format(sink).options(**settings).save()
    else:
        values.write.format(sink).mode("append").options(**settings).save(topic)


def copy_text(spark: SparkSession, source: str, target: str) -> None:
    spark.read.text(source).write.text(target)
