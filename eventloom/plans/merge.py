"""Merging the small files that many runs leave in an hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.publish import drop_hours_of_runs, hour_columns
from ..sources.listing import list_files
from ..sources.runs import begin_runs, counting_rows, record_finished
from .ingest import Layout, _guarded, published_rows, run_stamp, stage

TARGET_BYTES = 128 << 20


def published_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """run, date_hour, length: the text files that count, from the listing alone."""
    files = list_files(spark, layout.published).select(
        F.regexp_extract("path", "/run=([^/]+)/", 1).alias("run"), "date_hour", "length"
    )
    return counting_rows(spark, layout.finished, files, text=True)


def merge_small_files(
    spark: SparkSession,
    layout: Layout,
    until: str,
    run: str | None = None,
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Rewrite the hours up to ``until`` that lie in more files than their size asks for.

    An hour of ``b`` bytes then has ``b / target_bytes`` files, rounded up, at most.  The merged
    text counts from the moment its run is finished, and what it was made of does not from
    then on: rows of just those runs and hours, so a late run that publishes to an hour
    meanwhile loses nothing.  Parked rows stay with their runs.  Returns the number of hours.
    """
    run = run or f"merge-{run_stamp()}"

    def work() -> int:
        begin_runs(spark, layout.begun, layout.finished, [run], "merge")
        files = published_files(spark, layout).where(F.col("date_hour") <= until)
        pieces = F.greatest(F.lit(1), F.ceil(F.sum("length") / target_bytes))
        many = (
            files.groupBy("date_hour")
            .agg(F.count("*").alias("n"), pieces.cast("int").alias("pieces"))
            .where(F.col("n") > F.col("pieces"))
            .select("date_hour", "pieces")
        )
        # what is merged is decided once, by run and hour
        parts = stage(files.join(many, "date_hour").select("run", "date_hour", "pieces").distinct(), "merge")
        if parts.isEmpty():
            return 0
        rows = published_rows(spark, layout).join(F.broadcast(parts), ["run", "date_hour"])
        piece = F.pmod(F.xxhash64("value"), F.col("pieces"))
        (
            hour_columns(rows)
            .withColumn("piece", piece)
            .repartition("date", "hour", "piece")
            .select("date", "hour", "value")
            .write.partitionBy("date", "hour")
            .mode("overwrite")
            .text(f"{layout.published}/run={run}")
        )
        record_finished(spark, layout.finished, run, "merge", took=parts.select("run", "date_hour"))
        # one folder each
        gone = [(r.run, r.date_hour) for r in parts.select("run", "date_hour").collect()]
        drop_hours_of_runs(spark, layout.published, gone)
        return len({hour for _, hour in gone})

    return _guarded(spark, layout, run, work)
