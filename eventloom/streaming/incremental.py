"""The same ingest as a Structured Streaming query over the raw directories.

The file source's own log takes the place of ledger and watermark: each file is
read once, late files in old hours included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import date_hour_of_path
from ..operators.identity import resolve_ids
from ..plans.ingest import (
    LINES, Framing, Layout, Progress, Resolver, Sink, finish_run, lookup_side, transform,
)
from ..profiles import GameProfile
from ..session import prepare, scratch_scope
from ..sources.runs import begin_runs, is_finished, record_finished
from .listener import query_name, watch


def stream_lines(
    spark: SparkSession,
    root: str,
    max_files: int | None = None,
    max_age: str | None = None,
    record_separator: str | None = None,
) -> DataFrame:
    """A streaming ``(value, date_hour)`` frame of the text files below ``root``.

    ``max_age`` is the horizon for late files, relative to the newest file seen.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_age is not None:
        reader = reader.option("maxFileAge", max_age)
    if record_separator is not None:
        reader = reader.option("lineSep", record_separator)
    text = reader.text(root)
    return text.select("value", date_hour_of_path("_metadata.file_path").alias("date_hour"))


def run_incremental(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    types: Mapping[str, str],
    checkpoint: str,
    max_files: int | None = 10_000,
    max_age: str | None = None,
    framing: Framing = LINES,
    resolve: Resolver = resolve_ids,
    publish: Sink | Sequence[Sink] | None = None,
    gather: bool = True,
    progress: Progress | None = None,
) -> StreamingQuery:
    """Start a query that reads everything unread in batches of ``max_files``, then stops.

    Files must arrive by rename: the source reads each once, and Spark refuses the options
    by which a batch listing leaves out unsettled files.  A query that fails leaves an alert
    row, also when its source or its checkpoint is at fault.

    Each batch is a run named by query and batch number and replaces only its own
    directories, so a batch that Spark repeats after a failure is not duplicated.
    The query's id lives in its checkpoint: a new checkpoint reads everything again
    and adds runs of its own.  The identity table is read again in every batch.
    """
    prepare(spark)
    lines = stream_lines(spark, layout.raw, max_files, max_age, framing.record)
    parsed = framing.packets(lines, profile, types)

    def ingest(batch: DataFrame, batch_id: int) -> None:
        session = prepare(batch.sparkSession)
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query is None:
            raise RuntimeError("the streaming query has no id")
        run = f"stream-{query}-{batch_id}"
        if is_finished(session, layout.finished, run):
            return  # all of it is in place; only Spark's own note of it was lost
        begin_runs(session, layout.begun, layout.finished, [run], "stream")
        with scratch_scope(session):
            identity, lookup = lookup_side(session, layout, resolve)
            routed = transform(batch, profile, types, identity, lookup, unique=True)
            finish_run(routed, layout, profile, run, publish, gather, progress)
        record_finished(session, layout.finished, run, "stream")

    watch(spark, layout)
    name = query_name(layout, "ingest")
    return (
        parsed.writeStream.foreachBatch(ingest)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
