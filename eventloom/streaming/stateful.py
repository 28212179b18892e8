"""Streams that keep state over batches and restarts, and streams with a sink of their own.

Each has its own checkpoint, reads every file of the raw directories once, and gives what a
batch job over all files gives.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import HOUR_PATH
from ..operators.identity import resolve_ids
from ..operators.project import interpret
from ..operators.route import PUBLISHED, UNRESOLVED
from ..plans.ingest import LINES, Framing, Layout, transform
from ..profiles import GameProfile
from ..session import prepare
from ..sources.identity import read_identity
from .incremental import stream_lines
from .listener import query_name, watch

# State in native memory and on disk instead of the heap: it grows with the players to register.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _parsed(spark, layout, profile, types, framing, max_files) -> DataFrame:
    prepare(spark)
    watch(spark, layout)
    return framing.packets(stream_lines(spark, layout.raw, max_files, None, framing.record), profile, types)


def _start(rows: DataFrame, layout: Layout, kind: str, sink: str, path: str, checkpoint: str, options) -> StreamingQuery:
    writer = rows.writeStream.format(sink).queryName(query_name(layout, kind)).outputMode("append")
    if sink == "kafka":
        writer = writer.option("topic", path)
    else:
        writer = writer.option("path", path)
    return (
        writer.options(**dict(options or {}))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_worklist(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    types: Mapping[str, str],
    checkpoint: str,
    path: str,
    max_files: int | None = 10_000,
    framing: Framing = LINES,
) -> StreamingQuery:
    """Players to register as Parquet below ``path``: player_key, user_id, numeric_user_id,
    date_hour; each player once over all batches and restarts.

    Which of a player's rows is kept is left to chance, as for any first row.  The state holds the
    keys of players without an id; set ``spark.sql.streaming.stateStore.providerClass`` to
    ``STATE_STORE`` where they are many.
    """
    parsed = _parsed(spark, layout, profile, types, framing, max_files)
    routed = transform(
        parsed, profile, types, read_identity(spark, layout.forward), resolve_ids, unique=True
    )
    new = routed.where(F.col("route") == UNRESOLVED).select(
        "player_key", "user_id", "numeric_user_id", "date_hour"
    )
    return _start(new.dropDuplicates(["player_key"]), layout, "worklist", "parquet", path, checkpoint, None)


def stream_hour_counts(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    types: Mapping[str, str],
    checkpoint: str,
    path: str,
    delay: str = "3 hours",
    max_files: int | None = 10_000,
    framing: Framing = LINES,
) -> StreamingQuery:
    """Events per event-time hour and type, as Parquet below ``path``, once an hour is closed:
    date_hour, event_name, n.

    An hour closes when an event ``delay`` after its end was seen.  Rows that come for a closed
    hour are not counted any more; ``QueryAlerts`` reports how many there were.
    """
    parsed = _parsed(spark, layout, profile, types, framing, max_files)
    good = interpret(parsed, profile, types).where("reason IS NULL")
    counts = (
        good.withColumn("at", F.timestamp_millis("ts"))
        .withWatermark("at", delay)
        .groupBy(F.window("at", "1 hour"), "event_name")
        .agg(F.count("*").alias("n"))
        .select(F.date_format("window.start", HOUR_PATH).alias("date_hour"), "event_name", "n")
    )
    return _start(counts, layout, "counts", "parquet", path, checkpoint, None)


def stream_topic(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    types: Mapping[str, str],
    checkpoint: str,
    topic: str,
    sink: str = "kafka",
    options: Mapping[str, str] | None = None,
    max_files: int | None = 10_000,
    framing: Framing = LINES,
) -> StreamingQuery:
    """Published envelopes straight to a topic, values only, as the stream's own sink.

    A file sink keeps a log of the batches it holds: a batch that is repeated after a crash is
    not written again, and readers take the files in the log only.  Kafka's sink delivers at
    least once.  Players are looked up in the identity table as it was when the query
    started; rows without an id are left to runs that park them.
    """
    parsed = _parsed(spark, layout, profile, types, framing, max_files)
    routed = transform(
        parsed, profile, types, read_identity(spark, layout.forward), resolve_ids, unique=True
    )
    values = routed.where(F.col("route") == PUBLISHED).select(F.col("envelope").alias("value"))
    return _start(values, layout, "topic", sink, topic, checkpoint, options)
