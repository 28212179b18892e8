"""Counts, samples and alert rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .route import PUBLISHED, QUARANTINE, UNRESOLVED

# Rows shown in an alert.
SAMPLES = 5

MINUTE_MILLIS = 60_000
FIRST_MINUTE = -(2**63)

ALERT_SCHEMA = "stage string, date_hour string, kind string, n bigint, samples array<string>"


def hour_counts(routed: DataFrame) -> DataFrame:
    """Rows per hour: all, published, without id, set aside.  One pass."""
    return routed.groupBy("date_hour").agg(
        F.count("*").alias("total"),
        *[
            F.count_if(F.col("route") == name).alias(name)
            for name in (PUBLISHED, UNRESOLVED, QUARANTINE)
        ],
    )


def observe_routes(routed: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows unchanged, with live counts to be read once they were written.

    For progress reports only: repeated stages may be counted again, so alerts use
    ``hour_counts``.
    """
    seen = Observation(name)
    counts = [
        F.count_if(F.col("route") == route).alias(route)
        for route in (PUBLISHED, UNRESOLVED, QUARANTINE)
    ]
    if "player_key" in routed.columns:
        # an estimate, since an observed metric cannot count distinct players exactly
        unknown = F.when(F.col("route") == UNRESOLVED, F.col("player_key"))
        counts.append(F.approx_count_distinct(unknown).alias("hits"))
    return routed.observe(seen, *counts), seen


def registration_hits(unresolved: DataFrame) -> DataFrame:
    """Players to register per hour, each counted in the first hour it appears.

    Counted from the rows, so a retried task does not count twice.
    """
    seen = unresolved.select("player_key", "date_hour").distinct()
    first = seen.groupBy("player_key").agg(F.min("date_hour").alias("date_hour"))
    return first.groupBy("date_hour").agg(F.count("*").alias("hits"))


def first_per_event_type(events: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The earliest whole row of each event type.

    The smallest first order key per type is found over two columns and without
    sorting, and written down: a row per type.  Spark knows the size of that table and
    sends it to the events if it is small, so they are not shuffled; only the rows that
    share the smallest key are compared in full.
    """
    rest = [c for c in events.columns if c != "event_type"]
    lead = order[0]
    path = scratch_path(events.sparkSession, "first-keys")
    floor = events.groupBy("event_type").agg(F.min(lead).alias("_floor"))
    floor.write.parquet(path)
    floor = events.sparkSession.read.schema(floor.schema).parquet(path)
    tied = events.alias("e").join(
        floor.alias("f"),
        (F.col("e.event_type") == F.col("f.event_type"))
        & F.col(f"e.{lead}").eqNullSafe(F.col("f._floor")),
        "left_semi",
    )
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return tied.groupBy("event_type").agg(first.alias("first")).select("event_type", "first.*")


def any_per_event_type(events: DataFrame) -> DataFrame:
    """Some whole row of each event type; which one is left to chance."""
    rest = [c for c in events.columns if c != "event_type"]
    some = F.first(F.struct(*rest)).alias("some")
    return events.groupBy("event_type").agg(some).select("event_type", "some.*")


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def alert_rows(routed: DataFrame, stage: str, samples: int = SAMPLES) -> DataFrame:
    """One row per hour and kind of trouble, with its count and some examples.

    The examples are the first rows by time.  Counting per minute first shows up to
    which minute they reach; that pass reads no texts and sorts no rows.  Only rows up
    to that minute are ranked, and every task cuts its own to ``samples`` per group
    before they are shuffled.
    """
    group = ["date_hour", "kind"]
    troubled = routed.where(F.col("route") != PUBLISHED).select(
        "date_hour",
        F.coalesce("reason", F.lit(UNRESOLVED)).alias("kind"),
        "ts",
        # rows without a time come first
        F.coalesce(F.floor(F.col("ts") / MINUTE_MILLIS), F.lit(FIRST_MINUTE)).alias("minute"),
        F.coalesce("packet", "envelope").alias("example"),
    )
    minutes = troubled.groupBy(*group, "minute").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy("minute").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0))
    counted = (
        minutes.withColumn("earlier", earlier)
        .groupBy(*group)
        .agg(
            F.sum("n").alias("n"),
            F.max(F.when(F.col("earlier") < samples, F.col("minute"))).alias("last_minute"),
        )
    )
    # one row per hour and kind
    near = troubled.join(F.broadcast(counted.select(*group, "last_minute")), group).where(
        F.col("minute") <= F.col("last_minute")
    )
    ranked = Window.partitionBy(*group).orderBy("ts", "example")
    picked = (
        near.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= samples)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "example"))).alias("picked"))
    )
    return counted.join(picked, group).select(
        F.lit(stage).alias("stage"), "date_hour", "kind", "n",
        F.col("picked.example").alias("samples"),
    )


def hit_alerts(unresolved: DataFrame, stage: str) -> DataFrame:
    """One row per hour that had players to register."""
    return registration_hits(unresolved).select(
        F.lit(stage).alias("stage"),
        "date_hour",
        F.lit("registration").alias("kind"),
        F.col("hits").alias("n"),
        F.array().cast("array<string>").alias("samples"),
    )
