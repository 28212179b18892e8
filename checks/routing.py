"""Allowlists, required keys and the routes rows take."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators.project import interpret
from eventloom.operators.route import allow_events, allow_users
from eventloom.plans.ingest import transform
from eventloom.sources import packet_fields, parse_packets

from . import standins as st


def spoiled_parsed(spark, sf_dir):
    lines = st.spoiled(st.raw_events(spark, sf_dir))
    return parse_packets(lines, packet_fields(st.PROFILE, st.TYPES))


def routed(spark, sf_dir):
    return transform(
        spoiled_parsed(spark, sf_dir), st.PROFILE, st.TYPES, st.identity(spark, sf_dir)
    )


def event_allowlist(spark, sf_dir):
    events = allow_events(st.raw_events(spark, sf_dir), st.PROFILE.event_names)
    return events.select("event_id", "event_type", "user_id")


def user_allowlist(spark, sf_dir):
    customers = st.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    users = customers.select(F.concat(F.lit("p"), F.col("c_custkey")).alias("user_id"))
    allowed = allow_events(st.raw_events(spark, sf_dir), st.PROFILE.event_names)
    return allow_users(allowed, users).select("event_id", "event_type", "user_id")


def required_keys(spark, sf_dir):
    """Why each row that cannot be published is set aside; '' for good rows."""
    rows = interpret(spoiled_parsed(spark, sf_dir), st.PROFILE, st.TYPES)
    return rows.groupBy("date_hour", F.coalesce("reason", F.lit("")).alias("reason")).agg(
        F.count("*").alias("n")
    )


def quarantined_rows(spark, sf_dir):
    rows = routed(spark, sf_dir).where("route = 'quarantine'")
    return rows.select("date_hour", "reason", "packet")


def split_by_id(spark, sf_dir):
    rows = routed(spark, sf_dir).where("route <> 'quarantine'")
    return rows.select("route", "goc_id", "player_key", "event_value")


def unresolved_rows(spark, sf_dir):
    rows = routed(spark, sf_dir).where("route = 'unresolved'")
    return rows.select("date_hour", "player_key", "envelope")


QUERIES = {
    "event_allowlist": event_allowlist,
    "user_allowlist": user_allowlist,
    "required_keys": required_keys,
    "quarantined_rows": quarantined_rows,
    "split_by_id": split_by_id,
    "unresolved_rows": unresolved_rows,
}

SQL = {
    "event_allowlist": st.with_parts(
        "SELECT event_id, event_type, uid AS user_id FROM typed", st.RAW_SQL, st.VALUE_SQL
    ),
    "user_allowlist": st.with_parts(
        "SELECT event_id, event_type, uid AS user_id FROM typed WHERE user_id IN "
        "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
        st.RAW_SQL, st.VALUE_SQL,
    ),
    "required_keys": st.with_parts(
        "SELECT date_hour, reason, count(*) AS n FROM (SELECT date_hour, '' AS reason FROM typed "
        "UNION ALL SELECT date_hour, reason FROM spoiled) GROUP BY 1, 2",
        st.RAW_SQL, st.VALUE_SQL, st.SPOILED_SQL,
    ),
    "quarantined_rows": st.with_parts(
        "SELECT date_hour, reason, packet FROM spoiled", st.RAW_SQL, st.SPOILED_SQL
    ),
    "split_by_id": st.with_parts(
        "SELECT CASE WHEN goc_id = '' THEN 'unresolved' ELSE 'published' END AS route, goc_id, "
        "uid AS player_key, event_value FROM resolved",
        st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL,
    ),
    "unresolved_rows": st.with_parts(
        "SELECT date_hour, uid AS player_key, envelope FROM enveloped WHERE goc_id = ''",
        st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL, st.ENVELOPE_SQL,
    ),
}
