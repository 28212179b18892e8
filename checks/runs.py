"""Whole runs over raw files written from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom import hashed_id_profile, scratch_path
from eventloom.functions.times import HOUR_PATH
from eventloom.plans.ingest import (
    Layout, UnresolvedIds, backfill_run, hash_ledger_run, hour_ledger_run, register, replay,
    seed_hash_ledger, text_sink, watermark_run,
)
from eventloom.sinks import publish_topic
from eventloom.sources import merge_identity, read_identity, read_watermark, write_watermark
from eventloom.streaming import run_incremental

from . import standins as st
from .joins import _assigned
from .sinks import read_published

# The run starts from the newest listed hour up to here from which on the next
# day is read too.
NEWEST_MARK = "2024/01/10/22"


def layout_for(spark, sf_dir) -> Layout:
    layout = Layout(st.raw_files(spark, sf_dir), scratch_path(spark, "game"), partitioned=True)
    merge_identity(st.identity(spark, sf_dir), layout.forward)
    return layout


def whole_span(spark, sf_dir):
    """The last hour of the events, and how many hours lie before it to the first."""
    span = st.table(spark, sf_dir, "events").agg(
        F.date_format(F.max("ts"), HOUR_PATH).alias("until"),
        F.expr("timestampdiff(HOUR, date_trunc('hour', min(ts)), date_trunc('hour', max(ts)))").alias("n"),
    ).first()
    return {"until": span.until, "horizon_hours": span.n}


def run_by_watermark(spark, sf_dir):
    """Hours behind the mark, the newest three held back, then the mark's new place."""
    layout = layout_for(spark, sf_dir)
    hours = st.file_listing(spark, sf_dir).where(
        (F.col("date_hour") <= NEWEST_MARK) & (F.right("date_hour", F.lit(2)) >= "20")
    )
    write_watermark(spark, hours.agg(F.max("date_hour")).first()[0], layout.watermark)
    watermark_run(spark, layout, st.PROFILE, st.TYPES, now="2024-01-12 05:00:00")
    mark = read_watermark(spark, layout.watermark)
    return read_published(spark, layout.published).withColumn("mark", F.lit(mark))


def run_by_file_ledger(spark, sf_dir):
    """All files but those seeded as read, in one run; a second run adds nothing."""
    layout = layout_for(spark, sf_dir)
    span = whole_span(spark, sf_dir)
    seed_hash_ledger(spark, layout, st.BEFORE_CUT_OFF, span["horizon_hours"])
    for run in ("one", "two"):
        hash_ledger_run(spark, layout, st.PROFILE, st.TYPES, run=run, **span)
    return read_published(spark, layout.published)


def run_by_hour_ledger(spark, sf_dir):
    """All settled files in one run; a second run adds nothing."""
    layout = layout_for(spark, sf_dir)
    for run in ("one", "two"):
        hour_ledger_run(
            spark, layout, st.PROFILE, st.TYPES, now="2100-01-01 00:00:00", run=run,
            **whole_span(spark, sf_dir),
        )
    return read_published(spark, layout.published)


def run_backfill(spark, sf_dir):
    """All days again for the players of one market segment."""
    layout = layout_for(spark, sf_dir)
    customers = st.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    users = customers.select(F.concat(F.lit("p"), F.col("c_custkey")).alias("user_id"))
    span = st.table(spark, sf_dir, "events").agg(
        F.date_format(F.min("ts"), "yyyy/MM/dd").alias("a"),
        F.date_format(F.max("ts"), "yyyy/MM/dd").alias("b"),
    ).first()
    backfill_run(
        spark, layout, st.PROFILE, st.TYPES, span.a, span.b, users=users, run="again"
    )
    return read_published(spark, layout.published)


def register_and_replay(spark, sf_dir):
    """New players get ids after the first run; the replay publishes their rows."""
    layout = layout_for(spark, sf_dir)
    hash_ledger_run(
        spark, layout, st.PROFILE, st.TYPES, run="one", **whole_span(spark, sf_dir)
    )
    register(spark, layout, _assigned(spark, sf_dir), seq=2)
    for run in ("replay-1", "replay-2"):
        replay(spark, layout, st.PROFILE, run)
    return read_published(spark, layout.published)


STRICT = hashed_id_profile(st.GAME, event_columns=st.PROFILE.event_columns, on_unresolved="fail")


def run_strict_after_register(spark, sf_dir):
    """A strict run stops on new players; once they are registered it is repeated whole."""
    layout = layout_for(spark, sf_dir)
    span = whole_span(spark, sf_dir)
    try:
        hash_ledger_run(spark, layout, STRICT, st.TYPES, run="one", **span)
    except UnresolvedIds:
        register(spark, layout, _assigned(spark, sf_dir), seq=2)
    hash_ledger_run(spark, layout, STRICT, st.TYPES, run="two", **span)
    return read_published(spark, layout.published)


def run_by_watermark_then_backfill(spark, sf_dir):
    """A backfill of all days replaces what a watermark run published; the text reads plainly."""
    layout = layout_for(spark, sf_dir)
    listing = st.file_listing(spark, sf_dir)
    hours = listing.where(
        (F.col("date_hour") <= NEWEST_MARK) & (F.right("date_hour", F.lit(2)) >= "20")
    )
    write_watermark(spark, hours.agg(F.max("date_hour")).first()[0], layout.watermark)
    watermark_run(spark, layout, st.PROFILE, st.TYPES, now="2024-01-12 05:00:00")
    span = listing.agg(F.min("date_hour").alias("a"), F.max("date_hour").alias("b")).first()
    backfill_run(
        spark, layout, st.PROFILE, st.TYPES, span.a[:10], span.b[:10], run="again", gather=False
    )
    return spark.read.text(layout.published).select(
        F.col("value").alias("envelope"),
        F.concat(
            F.date_format("date", "yyyy/MM/dd"), F.lit("/"), F.lpad("hour", 2, "0")
        ).alias("date_hour"),
    )


def run_to_topic_and_text(spark, sf_dir):
    """One run with two sinks, the topic stood in for by text files."""
    layout = layout_for(spark, sf_dir)
    topic = scratch_path(spark, "topic")
    sinks = [lambda rows, run: publish_topic(rows, topic, sink="text"), text_sink(layout)]
    hash_ledger_run(
        spark, layout, st.PROFILE, st.TYPES, run="one", publish=sinks, slice_files=1_000_000,
        **whole_span(spark, sf_dir),
    )
    sent = spark.read.text(topic).select(F.lit("topic").alias("sink"), F.col("value").alias("envelope"))
    text = read_published(spark, layout.published).select(F.lit("text").alias("sink"), "envelope")
    return sent.unionByName(text)


def registered_identities(spark, sf_dir):
    """The three identity tables after new players were registered."""
    layout = layout_for(spark, sf_dir)
    hash_ledger_run(
        spark, layout, st.PROFILE, st.TYPES, run="one", **whole_span(spark, sf_dir)
    )
    for _ in range(2):
        register(spark, layout, _assigned(spark, sf_dir), seq=2)
    forward = read_identity(spark, layout.forward).select(
        F.lit("forward").alias("kind"), F.col("player_id").alias("key"), "goc_id", "seq"
    )
    reverse = read_identity(spark, layout.reverse, "reverse").select(
        F.lit("reverse").alias("kind"), F.col("hashed_id").alias("key"), "goc_id", "seq"
    )
    numeric = read_identity(spark, layout.numeric, "numeric").select(
        F.lit("numeric").alias("kind"), F.col("hashed_id").alias("key"), "goc_id", "seq"
    )
    return forward.unionByName(reverse).unionByName(numeric)


def run_as_stream(spark, sf_dir):
    """The streaming form; started again it finds nothing new."""
    layout = layout_for(spark, sf_dir)
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):
        run_incremental(spark, layout, st.PROFILE, st.TYPES, checkpoint).awaitTermination()
    return read_published(spark, layout.published)


def stored_hour_counts(spark, sf_dir):
    """Counts a run leaves behind, and the event types its output holds."""
    layout = layout_for(spark, sf_dir)
    counts = hour_ledger_run(
        spark, layout, st.PROFILE, st.TYPES, now="2100-01-01 00:00:00", run="one",
        **whole_span(spark, sf_dir),
    )
    stored = spark.read.parquet(*[f"{layout.counts}/run={run}" for run in counts])
    written = read_published(spark, layout.published).groupBy("date_hour").agg(
        F.count_if(F.get_json_object("envelope", "$.event_name") == "click").alias("clicks")
    )
    return stored.join(written, "date_hour", "left").select(
        "date_hour", "total", "published", "unresolved", "quarantine",
        F.coalesce("clicks", F.lit(0)).cast("bigint").alias("clicks"),
    )


QUERIES = {
    "run_by_watermark": run_by_watermark,
    "run_by_file_ledger": run_by_file_ledger,
    "run_by_hour_ledger": run_by_hour_ledger,
    "run_backfill": run_backfill,
    "register_and_replay": register_and_replay,
    "run_strict_after_register": run_strict_after_register,
    "run_by_watermark_then_backfill": run_by_watermark_then_backfill,
    "run_to_topic_and_text": run_to_topic_and_text,
    "registered_identities": registered_identities,
    "run_as_stream": run_as_stream,
    "stored_hour_counts": stored_hour_counts,
}

_REGISTERED_SQL = st.RESOLVED_SQL.replace(
    "coalesce(c_name, '')",
    f"CASE WHEN c_mktsegment = '{st.UNREGISTERED}' THEN 'new ' ELSE '' END || c_name",
).replace(f" AND c_mktsegment <> '{st.UNREGISTERED}'", "")
_PARTS = (st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL, st.ENVELOPE_SQL)
_ALL = st.with_parts("SELECT envelope, date_hour FROM enveloped WHERE goc_id <> ''", *_PARTS)

SQL = {
    "run_by_watermark": st.with_parts(
        "SELECT envelope, date_hour, (SELECT max(date_hour) FROM due) AS mark FROM enveloped "
        "WHERE goc_id <> '' AND date_hour IN (SELECT date_hour FROM due)",
        *_PARTS,
        "mark AS (SELECT max(ts) AS m FROM raw WHERE right(date_hour, 2) >= '20' "
        f"AND date_hour <= '{NEWEST_MARK}')",
        "due AS (SELECT date_hour FROM (SELECT date_hour, "
        "row_number() OVER (ORDER BY date_hour DESC) AS r FROM (SELECT DISTINCT date_hour "
        "FROM raw, mark WHERE date_hour > strftime(m, '%Y/%m/%d/%H') "
        "AND ts < date_trunc('day', m) + INTERVAL 2 DAY)) WHERE r > 3)",
    ),
    "run_by_file_ledger": st.with_parts(
        "SELECT envelope, date_hour FROM enveloped WHERE goc_id <> '' "
        f"AND date_hour >= '{st.CUT_OFF}'",
        *_PARTS,
    ),
    "run_by_hour_ledger": _ALL,
    "run_backfill": st.with_parts(
        "SELECT envelope, date_hour FROM enveloped WHERE user_id IN "
        "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
        *_PARTS,
    ),
    "register_and_replay": st.with_parts(
        "SELECT envelope, date_hour FROM enveloped",
        st.RAW_SQL, st.VALUE_SQL,
        _REGISTERED_SQL, st.ENVELOPE_SQL,
    ),
    "run_strict_after_register": st.with_parts(
        "SELECT envelope, date_hour FROM enveloped",
        st.RAW_SQL, st.VALUE_SQL, _REGISTERED_SQL, st.ENVELOPE_SQL,
    ),
    "run_by_watermark_then_backfill": _ALL,
    "run_to_topic_and_text": st.with_parts(
        "SELECT sink, envelope FROM enveloped, (VALUES ('topic'), ('text')) AS sinks(sink) "
        "WHERE goc_id <> ''",
        *_PARTS,
    ),
    "registered_identities": st.with_parts(
        "SELECT 'forward' AS kind, 'p' || c_custkey AS key, c_name AS goc_id, "
        "CAST(1 AS BIGINT) AS seq FROM customer "
        f"WHERE c_mktsegment <> '{st.UNREGISTERED}' UNION ALL "
        "SELECT kind, uid, goc_id, CAST(2 AS BIGINT) FROM "
        "(SELECT DISTINCT uid, goc_id FROM resolved WHERE goc_id LIKE 'new %'), "
        "(VALUES ('forward'), ('reverse'), ('numeric')) AS kinds(kind)",
        st.RAW_SQL, st.VALUE_SQL, _REGISTERED_SQL,
    ),
    "run_as_stream": _ALL,
    "stored_hour_counts": st.with_parts(
        "SELECT date_hour, count(*) AS total, count(*) FILTER (goc_id <> '') AS published, "
        "count(*) FILTER (goc_id = '') AS unresolved, CAST(0 AS BIGINT) AS quarantine, "
        "count(*) FILTER (goc_id <> '' AND event_type = 'click') AS clicks "
        "FROM resolved GROUP BY 1",
        *_PARTS[:3],
    ),
}
