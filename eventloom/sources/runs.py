"""Which runs have begun and which are finished: what makes a run's output count at once.

A run writes its rows below ``run=<name>`` of several folders and comes last to the table of
finished runs.  Readers take rows of finished runs only.  A finished run over whole hours also
takes the place of what runs finished before it hold for those hours, so its rows appear and
theirs vanish with one small file, before anything is deleted.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BEGUN_SCHEMA = "run string, kind string"
# A row per run with neither hour nor ``took``; one per hour it holds whole; one per run, in
# ``took``, whose parked rows it took up; one per run and hour whose text it holds instead.
FINISHED_SCHEMA = "run string, kind string, number bigint, date_hour string, took string"


class RunNameUsed(ValueError):
    """The name of a run that is finished, or of an unfinished one of another kind."""


def read_runs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table with a folder per run; empty where none was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def finished_runs(spark: SparkSession, path: str) -> DataFrame:
    """run, kind, number: a row per finished run, numbered as they were finished."""
    return read_runs(spark, path, FINISHED_SCHEMA).where("date_hour IS NULL AND took IS NULL").select(
        "run", "kind", "number"
    )


def is_finished(spark: SparkSession, path: str, run: str) -> bool:
    return not read_runs(spark, path, FINISHED_SCHEMA).where(F.col("run") == run).isEmpty()


def begin_runs(spark: SparkSession, begun: str, finished: str, names: Iterable[str], kind: str) -> None:
    """Enter the names of runs about to start; nothing is entered if one of them cannot be.

    A name is refused if its run is finished, whatever its kind, and if an unfinished run of
    another kind has it.  An unfinished run is repeated under its name.
    """
    names = list(names)
    for name in names:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
            raise ValueError(f"run names are letters, digits, dots, dashes and underscores: {name!r}")
    used = read_runs(spark, finished, FINISHED_SCHEMA).where(F.col("run").isin(names)).first()
    if used is not None:
        raise RunNameUsed(f"run {used.run} exists already, as a finished run of kind {used.kind}")
    known = {r.run: r.kind for r in read_runs(spark, begun, BEGUN_SCHEMA).where(F.col("run").isin(names)).collect()}
    for name, other in known.items():
        if other != kind:
            raise RunNameUsed(f"run {name} exists already, as an unfinished run of kind {other}")
    new = [(name, kind) for name in names if name not in known]
    if new:
        rows = spark.createDataFrame(new, BEGUN_SCHEMA).coalesce(1)
        rows.write.mode("append").partitionBy("run").parquet(begun)


def record_finished(
    spark: SparkSession,
    path: str,
    run: str,
    kind: str,
    hours: Iterable[str] = (),
    took: DataFrame | None = None,
) -> None:
    """Let a run's output count.  ``hours`` are those it holds whole; ``took`` has the runs
    (column ``run``) whose parked rows it has taken up or, with ``date_hour``, the runs and
    hours whose text it holds in their stead."""
    number = 1 + (read_runs(spark, path, FINISHED_SCHEMA).agg(F.max("number")).first()[0] or 0)
    schema = FINISHED_SCHEMA.replace("run string, ", "")
    rows = [(kind, number, None, None), *[(kind, number, h, None) for h in sorted(set(hours))]]
    table = spark.createDataFrame(rows, schema)
    if took is not None:
        hour = F.col("date_hour") if "date_hour" in took.columns else F.lit(None).cast("string")
        table = table.unionByName(
            took.select(
                F.lit(kind).alias("kind"), F.lit(number).cast("bigint").alias("number"),
                hour.alias("date_hour"), F.col("run").alias("took"),
            ).distinct()
        )
    # one file, so it is there whole or not at all
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}")


def counting_rows(spark: SparkSession, path: str, rows: DataFrame, text: bool = False) -> DataFrame:
    """Of ``rows`` (run, date_hour, ...) those that count: of finished runs, but for hours that
    a run finished later holds whole and, of ``text``, for hours merged into another run."""
    table = read_runs(spark, path, FINISHED_SCHEMA)
    runs = finished_runs(spark, path).select("run", "number")
    # one row per run and one per hour: small beside the rows
    whole = (
        table.where("date_hour IS NOT NULL AND took IS NULL")
        .groupBy("date_hour")
        .agg(F.max("number").alias("last"))
    )
    if text:
        merged = table.where("date_hour IS NOT NULL AND took IS NOT NULL")
        merged = merged.select(F.col("took").alias("run"), "date_hour").distinct()
        rows = rows.join(merged, ["run", "date_hour"], "left_anti").select(*rows.columns)
    return (
        rows.join(runs, "run")
        .join(whole, "date_hour", "left")
        .where(F.col("last").isNull() | (F.col("number") >= F.col("last")))
        .select(*rows.columns)
    )


def taken_runs(spark: SparkSession, path: str) -> DataFrame:
    """run: those whose parked rows a finished replay has taken up."""
    table = read_runs(spark, path, FINISHED_SCHEMA)
    return table.where("took IS NOT NULL AND date_hour IS NULL").select(F.col("took").alias("run")).distinct()
