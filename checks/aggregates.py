"""Counts, first rows, samples and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators.counts import (
    alert_rows, any_per_event_type, first_per_event_type, hit_alerts, hour_counts, registration_hits, top_rows,
)

from eventloom.operators.identity import distinct_players as players
from eventloom.plans.ingest import stage

from . import standins as st
from .routing import routed


def first_events(spark, sf_dir):
    return first_per_event_type(st.raw_events(spark, sf_dir))


def some_events(spark, sf_dir):
    """A row per event type, whichever it is, found again among the events."""
    events = st.raw_events(spark, sf_dir)
    some = any_per_event_type(events)
    return some.join(events, events.columns).groupBy("event_type").agg(
        F.count("*").alias("found")
    )


def route_counts(spark, sf_dir):
    return hour_counts(routed(spark, sf_dir))


def new_player_hits(spark, sf_dir):
    return registration_hits(routed(spark, sf_dir).where("route = 'unresolved'"))


def new_player_alerts(spark, sf_dir):
    alerts = hit_alerts(routed(spark, sf_dir).where("route = 'unresolved'"), "ingest")
    return alerts.select("stage", "date_hour", "kind", "n")


def distinct_players(spark, sf_dir):
    return players(st.raw_events(spark, sf_dir))


def newest_events(spark, sf_dir):
    events = st.raw_events(spark, sf_dir)
    return top_rows(events, 10, F.col("ts").desc(), F.col("event_id").desc()).select(
        "event_id", "ts", "event_type"
    )


def trouble_alerts(spark, sf_dir):
    # read twice, once to count and once to pick, so written once as a run does
    alerts = alert_rows(stage(routed(spark, sf_dir), "routed", "route"), "ingest")
    return alerts.select(
        "stage", "date_hour", "kind", "n", F.concat_ws(" | ", "samples").alias("samples")
    )


QUERIES = {
    "first_events": first_events,
    "some_events": some_events,
    "route_counts": route_counts,
    "new_player_hits": new_player_hits,
    "new_player_alerts": new_player_alerts,
    "distinct_players": distinct_players,
    "newest_events": newest_events,
    "trouble_alerts": trouble_alerts,
}

_RESOLVED = (st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL)
_HITS = "(SELECT uid, min(date_hour) AS date_hour FROM resolved WHERE goc_id = '' GROUP BY 1)"

SQL = {
    "first_events": st.with_parts(
        "SELECT event_type, ms AS ts, uid AS user_id, CAST(user_id AS VARCHAR) AS numeric_user_id, "
        "event_id, value, k, date_hour FROM (SELECT *, row_number() OVER "
        "(PARTITION BY event_type ORDER BY ms, event_id) AS r FROM raw) WHERE r = 1",
        st.RAW_SQL,
    ),
    "some_events": "SELECT event_type, CAST(1 AS BIGINT) AS found FROM events GROUP BY 1",
    "route_counts": st.with_parts(
        "SELECT date_hour, count(*) AS total, count(*) FILTER (route = 'published') AS published, "
        "count(*) FILTER (route = 'unresolved') AS unresolved, "
        "count(*) FILTER (route = 'quarantine') AS quarantine FROM ("
        "SELECT date_hour, CASE WHEN goc_id = '' THEN 'unresolved' ELSE 'published' END AS route "
        "FROM resolved UNION ALL SELECT date_hour, 'quarantine' FROM spoiled) GROUP BY 1",
        *_RESOLVED, st.SPOILED_SQL,
    ),
    "new_player_hits": st.with_parts(
        f"SELECT date_hour, count(*) AS hits FROM {_HITS} GROUP BY 1", *_RESOLVED
    ),
    "new_player_alerts": st.with_parts(
        "SELECT 'ingest' AS stage, date_hour, 'registration' AS kind, count(*) AS n "
        f"FROM {_HITS} GROUP BY 2",
        *_RESOLVED,
    ),
    "distinct_players": st.with_parts("SELECT DISTINCT uid AS user_id FROM raw", st.RAW_SQL),
    "newest_events": st.with_parts(
        "SELECT event_id, ms AS ts, event_type FROM raw ORDER BY ms DESC, event_id DESC LIMIT 10",
        st.RAW_SQL,
    ),
    "trouble_alerts": st.with_parts(
        "SELECT 'ingest' AS stage, date_hour, kind, max(n) AS n, "
        "string_agg(example, ' | ' ORDER BY r) AS samples FROM ("
        "SELECT *, row_number() OVER (PARTITION BY date_hour, kind "
        "ORDER BY sent NULLS FIRST, example) AS r, count(*) OVER (PARTITION BY date_hour, kind) AS n "
        "FROM (SELECT date_hour, 'unresolved' AS kind, ms AS sent, envelope AS example "
        "FROM enveloped WHERE goc_id = '' UNION ALL SELECT date_hour, reason, "
        "CASE WHEN reason IN ('corrupt', 'missing_key') THEN NULL ELSE ms END, packet FROM spoiled)) "
        "WHERE r <= 5 GROUP BY 2, 3",
        *_RESOLVED, st.ENVELOPE_SQL, st.SPOILED_SQL,
    ),
}
