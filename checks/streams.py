"""Streams with state over batches, and with a sink of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom import scratch_path
from eventloom.plans.ingest import hash_ledger_run
from eventloom.streaming import stream_hour_counts, stream_topic, stream_worklist

from . import standins as st
from .runs import layout_for, whole_span


def _streamed(spark, sf_dir, stream, times=1, **more):
    """What a stream leaves behind, started ``times`` times over the raw files."""
    layout = layout_for(spark, sf_dir)
    path, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "stream")
    for _ in range(times):
        stream(spark, layout, st.PROFILE, st.TYPES, checkpoint, path, **more).awaitTermination()
    return path


def stream_new_players(spark, sf_dir):
    """Players to register, in several batches; started again it finds no new one."""
    path = _streamed(spark, sf_dir, stream_worklist, times=2, max_files=300)
    return spark.read.parquet(path).select("player_key", "user_id", "numeric_user_id")


def closed_hour_counts(spark, sf_dir):
    """Events per hour and type of the hours that no row within the delay can still reach."""
    return spark.read.parquet(_streamed(spark, sf_dir, stream_hour_counts))


def streamed_topic(spark, sf_dir):
    """Envelopes by the stream's own sink, a file sink here; started again it adds none."""
    path = _streamed(spark, sf_dir, stream_topic, times=2, sink="text", max_files=300)
    return spark.read.text(path).select(F.col("value").alias("envelope"))


def live_run_counts(spark, sf_dir):
    """What a run reports while it goes on."""
    seen = []
    hash_ledger_run(
        spark, layout_for(spark, sf_dir), st.PROFILE, st.TYPES, run="one",
        slice_files=1_000_000, progress=lambda run, counts: seen.append(counts),
        **whole_span(spark, sf_dir),
    )
    total = {k: sum(c[k] for c in seen) for k in ("published", "unresolved", "quarantine")}
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(k) for k, n in total.items()])


QUERIES = {
    "stream_new_players": stream_new_players,
    "closed_hour_counts": closed_hour_counts,
    "streamed_topic": streamed_topic,
    "live_run_counts": live_run_counts,
}

_PARTS = (st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL, st.ENVELOPE_SQL)

SQL = {
    "stream_new_players": st.with_parts(
        "SELECT DISTINCT uid AS player_key, uid AS user_id, CAST(user_id AS VARCHAR) AS numeric_user_id "
        "FROM resolved WHERE goc_id = ''",
        *_PARTS[:3],
    ),
    "closed_hour_counts": st.with_parts(
        "SELECT date_hour, event_type AS event_name, count(*) AS n FROM typed "
        "WHERE epoch_ms(date_trunc('hour', ts)) + 3600000 <= (SELECT max(ms) FROM typed) - 3 * 3600000 "
        "GROUP BY 1, 2",
        *_PARTS[:2],
    ),
    "streamed_topic": st.with_parts("SELECT envelope FROM enveloped WHERE goc_id <> ''", *_PARTS),
    "live_run_counts": st.with_parts(
        "SELECT count(*) FILTER (goc_id <> '') AS published, count(*) FILTER (goc_id = '') AS unresolved, "
        "CAST(0 AS BIGINT) AS quarantine FROM resolved",
        *_PARTS[:3],
    ),
}
