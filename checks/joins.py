"""Identity resolution and the upserts that register new ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators.backlog import unseen
from eventloom.operators.identity import (
    forward_entries, numeric_entries, resolve_by_distinct_keys, resolve_ids, reverse_entries,
    unresolved_keys, upsert,
)
from eventloom.operators.project import interpret
from eventloom.plans.ingest import stage
from eventloom import scratch_path
from eventloom.sources import identity_buckets, merge_identity, packet_fields, parse_packets, read_identity
from eventloom.sources.ledger import hash_entries

from . import standins as st


def typed_rows(spark, sf_dir):
    lines = st.packet_text(st.raw_events(spark, sf_dir))
    parsed = parse_packets(lines, packet_fields(st.PROFILE, st.TYPES))
    return interpret(parsed, st.PROFILE, st.TYPES)


def resolve_players(spark, sf_dir):
    rows = resolve_ids(typed_rows(spark, sf_dir), st.identity(spark, sf_dir))
    return rows.select("date_hour", "player_key", "goc_id", "event_value")


def resolve_distinct_players(spark, sf_dir):
    rows = stage(typed_rows(spark, sf_dir), "typed")
    resolved = resolve_by_distinct_keys(rows, st.identity(spark, sf_dir))
    return resolved.select("date_hour", "player_key", "goc_id", "event_value")


def resolve_salted_players(spark, sf_dir):
    """The heaviest players, unknown ones among them, are salted."""
    rows = stage(typed_rows(spark, sf_dir), "typed")
    resolved = resolve_by_distinct_keys(
        rows, st.identity(spark, sf_dir), max_hot_keys=500
    )
    return resolved.select("date_hour", "player_key", "goc_id", "event_value")


def worklist(spark, sf_dir):
    ids = st.identity(spark, sf_dir)
    missed = resolve_ids(typed_rows(spark, sf_dir), ids).where("goc_id = ''")
    return unresolved_keys(missed, ids)


def players_to_register(spark, sf_dir):
    return worklist(spark, sf_dir).select("player_id", "hashed_id", "numeric_id", "events")


def _assigned(spark, sf_dir):
    """Ids as a service returns them: one per unregistered customer."""
    customers = st.table(spark, sf_dir, "customer").where(
        F.col("c_mktsegment") == st.UNREGISTERED
    )
    return customers.select(
        F.concat(F.lit("p"), F.col("c_custkey")).alias("player_id"),
        F.concat(F.lit("new "), F.col("c_name")).alias("goc_id"),
    )


def forward_upsert(spark, sf_dir):
    """Known customers and newly registered players; a re-registration wins."""
    current = st.identity(spark, sf_dir).withColumn("player_id", F.trim("player_id"))
    entered = forward_entries(worklist(spark, sf_dir), _assigned(spark, sf_dir), 2)
    orders = st.table(spark, sf_dir, "orders")
    renewed = orders.select(
        F.concat(F.lit("p"), F.col("o_custkey")).alias("player_id"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("goc_id"),
        F.col("o_custkey").cast("string").alias("numeric_id"),
        (F.col("o_orderkey") + 10).cast("bigint").alias("seq"),
    )
    return upsert(current, entered.unionByName(renewed), "player_id")


def reverse_upsert(spark, sf_dir):
    current = st.identity(spark, sf_dir).select(
        "goc_id", "numeric_id", F.trim("player_id").alias("hashed_id"), "seq"
    )
    entered = reverse_entries(worklist(spark, sf_dir), _assigned(spark, sf_dir), 2)
    return upsert(current, entered, "goc_id")


def numeric_upsert(spark, sf_dir):
    current = st.identity(spark, sf_dir).select(
        "numeric_id", F.trim("player_id").alias("hashed_id"), "goc_id", "seq"
    )
    entered = numeric_entries(worklist(spark, sf_dir), _assigned(spark, sf_dir), 2)
    return upsert(current, entered, "numeric_id")


def _bucketed_identity(spark, sf_dir):
    """The customers, then newly registered players and renewed ids, each as an update."""
    path = scratch_path(spark, "identity")
    merge_identity(st.identity(spark, sf_dir), path)
    merge_identity(forward_entries(worklist(spark, sf_dir), _assigned(spark, sf_dir), 2), path)
    return path


def updated_identity_buckets(spark, sf_dir):
    """Three updates in place; the last meets few players and rewrites their buckets only."""
    path = _bucketed_identity(spark, sf_dir)
    orders = st.table(spark, sf_dir, "orders").where("o_custkey % 50 = 0")
    merge_identity(
        orders.select(
            F.concat(F.lit(" p"), F.col("o_custkey"), F.lit(" ")).alias("player_id"),
            F.concat(F.lit("order "), F.col("o_orderkey")).alias("goc_id"),
            F.col("o_custkey").cast("string").alias("numeric_id"),
            (F.col("o_orderkey") + 10).cast("bigint").alias("seq"),
        ),
        path,
    )
    return read_identity(spark, path)


def resolve_bucketed_players(spark, sf_dir):
    """Distinct players meet the identity table as it lies in its buckets."""
    path = _bucketed_identity(spark, sf_dir)
    rows = stage(typed_rows(spark, sf_dir), "typed")
    resolved = resolve_by_distinct_keys(
        rows, read_identity(spark, path, bucketed=True), unique=True, max_hot_keys=500,
        buckets=identity_buckets(spark, path),
    )
    return resolved.select("date_hour", "player_key", "goc_id", "event_value")


def ledger_anti_join(spark, sf_dir):
    """Files not in a ledger that holds every click's file twice."""
    listing = st.file_listing(spark, sf_dir)
    clicks = st.table(spark, sf_dir, "events").where("event_type = 'click'").select("event_id")
    read = hash_entries(listing.join(clicks, "event_id", "left_semi"))
    return unseen(listing, read.unionByName(read)).select("event_id")


QUERIES = {
    "resolve_players": resolve_players,
    "resolve_distinct_players": resolve_distinct_players,
    "resolve_salted_players": resolve_salted_players,
    "players_to_register": players_to_register,
    "forward_upsert": forward_upsert,
    "reverse_upsert": reverse_upsert,
    "numeric_upsert": numeric_upsert,
    "ledger_anti_join": ledger_anti_join,
    "updated_identity_buckets": updated_identity_buckets,
    "resolve_bucketed_players": resolve_bucketed_players,
}

_RESOLVED = st.with_parts(
    "SELECT date_hour, uid AS player_key, goc_id, event_value FROM resolved",
    st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL,
)
_WORK = """
work AS (
  SELECT uid AS player_id, CAST(user_id AS VARCHAR) AS numeric_id, count(*) AS events,
         max(user_id) AS custkey
  FROM resolved WHERE goc_id = '' GROUP BY 1, 2)"""
_ENTERED = f"""
entered AS (
  SELECT player_id, numeric_id, 'new ' || c_name AS goc_id, CAST(2 AS BIGINT) AS seq
  FROM work JOIN customer ON c_custkey = custkey AND c_mktsegment = '{st.UNREGISTERED}')"""
_CURRENT = f"""
present AS (
  SELECT 'p' || c_custkey AS player_id, CAST(c_custkey AS VARCHAR) AS numeric_id,
         c_name AS goc_id, CAST(1 AS BIGINT) AS seq
  FROM customer WHERE c_mktsegment <> '{st.UNREGISTERED}')"""
_BASE = (st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL, _WORK, _ENTERED, _CURRENT)

SQL = {
    "resolve_players": _RESOLVED,
    "resolve_distinct_players": _RESOLVED,
    "resolve_salted_players": _RESOLVED,
    "players_to_register": st.with_parts(
        "SELECT player_id, player_id AS hashed_id, numeric_id, events FROM work",
        st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL, _WORK,
    ),
    "forward_upsert": st.with_parts(
        "SELECT player_id, goc_id, numeric_id, seq FROM (SELECT *, row_number() OVER "
        "(PARTITION BY player_id ORDER BY seq DESC) AS r FROM ("
        "SELECT player_id, goc_id, numeric_id, seq FROM present "
        "UNION ALL SELECT player_id, goc_id, numeric_id, seq FROM entered "
        "UNION ALL SELECT 'p' || o_custkey, 'order ' || o_orderkey, CAST(o_custkey AS VARCHAR), "
        "o_orderkey + 10 FROM orders)) WHERE r = 1",
        *_BASE,
    ),
    "reverse_upsert": st.with_parts(
        "SELECT goc_id, numeric_id, player_id AS hashed_id, seq FROM present "
        "UNION ALL SELECT goc_id, numeric_id, player_id, seq FROM entered",
        *_BASE,
    ),
    "numeric_upsert": st.with_parts(
        "SELECT numeric_id, player_id AS hashed_id, goc_id, seq FROM present "
        "UNION ALL SELECT numeric_id, player_id, goc_id, seq FROM entered",
        *_BASE,
    ),
    "updated_identity_buckets": st.with_parts(
        "SELECT player_id, goc_id, numeric_id, seq FROM (SELECT *, row_number() OVER "
        "(PARTITION BY player_id ORDER BY seq DESC) AS r FROM ("
        "SELECT player_id, goc_id, numeric_id, seq FROM present "
        "UNION ALL SELECT player_id, goc_id, numeric_id, seq FROM entered "
        "UNION ALL SELECT 'p' || o_custkey, 'order ' || o_orderkey, CAST(o_custkey AS VARCHAR), "
        "o_orderkey + 10 FROM orders WHERE o_custkey % 50 = 0)) WHERE r = 1",
        *_BASE,
    ),
    "resolve_bucketed_players": st.with_parts(
        "SELECT date_hour, uid AS player_key, goc_id, event_value FROM resolved",
        st.RAW_SQL, st.VALUE_SQL, st.REGISTERED_SQL,
    ),
    "ledger_anti_join": "SELECT event_id FROM events WHERE event_type <> 'click'",
}
