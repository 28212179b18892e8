"""Framing, projection and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import (
    brace_slice, clean_path, date_hour_after_prod, date_hour_of_path, day_of, day_sequence,
    default_empty, epoch_to_pacific, epoch_to_text, event_type_of, file_hash, format_time, hour_of,
    hour_sequence, in_zone, packets_of, path_after, path_tail, row_json, trimmed,
)
from eventloom.functions import times as t
from eventloom.operators.project import interpret
from eventloom.plans.ingest import transform
from eventloom.sources import packet_fields, parse_packets

from . import standins as st


def parsed_events(spark, sf_dir, lines=None):
    lines = st.framed_events(spark, sf_dir) if lines is None else lines
    return parse_packets(lines, packet_fields(st.PROFILE, st.TYPES))


def unframe_packets(spark, sf_dir):
    lines = st.framed_events(spark, sf_dir)
    return lines.select("date_hour", F.explode(packets_of("value")).alias("packet"))


def _texts(spark, sf_dir):
    pages = st.table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("value")
    )
    documents = st.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("value")
    )
    return pages.unionByName(documents)


def slice_braces(spark, sf_dir):
    sliced = _texts(spark, sf_dir).withColumn("part", brace_slice("value"))
    return sliced.select(
        "kind", "id", F.length("part").cast("bigint").alias("chars"), F.md5("part").alias("hash")
    )


def drop_empty_packets(spark, sf_dir):
    return _texts(spark, sf_dir).select("kind", "id", F.explode(packets_of("value")).alias("p")).select(
        "kind", "id", F.md5("p").alias("hash")
    )


def extract_event_type(spark, sf_dir):
    packets = st.packet_text(st.raw_events(spark, sf_dir))
    return packets.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
        event_type_of("value").alias("event_type"),
    )


def rows_to_json(spark, sf_dir):
    """Null fields do not appear in the text."""
    events = st.raw_events(spark, sf_dir)
    return events.select(
        "event_id",
        row_json(
            "event_type",
            F.when(F.col("event_type") != "click", F.col("value")).alias("value"),
            F.when(F.col("event_type") != "view", F.col("k")).alias("k"),
        ).alias("json"),
    )


def typed_projection(spark, sf_dir):
    rows = interpret(parsed_events(spark, sf_dir), st.PROFILE, st.TYPES)
    return rows.select("date_hour", "event_name", "ts", "player_key", "event_value")


def event_times(spark, sf_dir):
    events = st.raw_events(spark, sf_dir)
    return events.select(
        "event_id",
        epoch_to_text("ts").alias("utc"),
        epoch_to_pacific("ts").alias("pacific"),
        epoch_to_text("ts", t.SECOND, t.INDIA_ZONE).alias("india"),
    )


def zone_times(spark, sf_dir):
    orders = st.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        format_time(in_zone("o_orderdate", t.INDIA_ZONE), t.SECOND).alias("india"),
        format_time(in_zone("o_orderdate", t.PACIFIC_ZONE), t.SECOND).alias("pacific"),
    )


def time_formats(spark, sf_dir):
    events = st.table(spark, sf_dir, "events")
    patterns = {
        "day": t.DAY, "hour_path": t.HOUR_PATH, "second": t.SECOND, "compact_day": t.COMPACT_DAY,
        "file_stamp": t.FILE_STAMP, "day_path": t.DAY_PATH, "minute": t.MINUTE,
        "run_stamp": t.RUN_STAMP,
    }
    return events.select(
        "event_id", *[format_time("ts", pattern).alias(name) for name, pattern in patterns.items()]
    )


def path_hashes(spark, sf_dir):
    return st.file_listing(spark, sf_dir).select("event_id", file_hash("path").alias("hashed_path"))


def hours_from_paths(spark, sf_dir):
    files = st.file_listing(spark, sf_dir).select("path")
    urls = st.table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return files.unionByName(urls).select(
        "path",
        date_hour_after_prod("path").alias("date_hour"),
        date_hour_of_path("path").alias("any_root"),
    )


def path_parts(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    directory = F.concat(F.lit("/raw/prod/"), F.col("date_hour"))
    return listing.select(
        "event_id",
        path_tail(directory).alias("tail"),
        day_of("date_hour").alias("day"),
        hour_of("date_hour").alias("hour"),
        path_after("path").alias("behind_root"),
        path_after("path", "prod/", 13).alias("date_hour"),
    )


def clean_paths(spark, sf_dir):
    pages = st.table(spark, sf_dir, "pages")
    return pages.select("page_id", clean_path("url").alias("clean"))


def trim_keys(spark, sf_dir):
    """Padded keys on both sides still meet."""
    events = st.raw_events(spark, sf_dir)
    padded = events.select("event_id", trimmed(F.concat(F.col("user_id"), F.lit("  "))).alias("key"))
    ids = st.identity(spark, sf_dir).select(trimmed("player_id").alias("key"), "goc_id")
    return padded.join(ids, "key").select("event_id", "key", "goc_id")


def default_empty_ids(spark, sf_dir):
    events = st.raw_events(spark, sf_dir)
    absent = F.when(F.col("event_type") != "error", F.col("numeric_user_id"))
    return events.select(
        "event_id", default_empty("user_id").alias("user_id"),
        default_empty(absent).alias("numeric_user_id"),
    )


def event_envelopes(spark, sf_dir):
    """The whole transform: framed packets to the six published columns."""
    rows = transform(
        parsed_events(spark, sf_dir), st.PROFILE, st.TYPES, st.identity(spark, sf_dir)
    )
    return rows.where("route = 'published'").select(
        "envelope", "game_id", "goc_id", "event_time", "event_name", "event_value"
    )


def envelope_columns(spark, sf_dir):
    """Envelopes read back as columns."""
    envelopes = event_envelopes(spark, sf_dir)
    shape = (
        "game_id string, event_time string, event_name string, user_id string, event_value "
        "struct<k bigint, value double, event_id bigint, epoch_time bigint, event_time string, "
        "user_id_hashed string, user_id_numeric string>"
    )
    read = envelopes.select(F.from_json("envelope", shape).alias("e"))
    return read.select(
        "e.game_id", "e.event_time", "e.event_name", "e.user_id",
        F.coalesce("e.event_value.k", F.lit(-1)).alias("k"),
        F.coalesce("e.event_value.value", F.lit(-1.0)).alias("value"),
        "e.event_value.event_id", "e.event_value.epoch_time", "e.event_value.user_id_hashed",
        "e.event_value.user_id_numeric",
    )


def hour_grid(spark, sf_dir):
    """Every hour of the events' span with its event count, empty hours included."""
    hours = st.table(spark, sf_dir, "events").select(
        F.date_format("ts", t.HOUR_PATH).alias("date_hour")
    )
    span = hours.agg(F.min("date_hour").alias("a"), F.max("date_hour").alias("b")).first()
    counts = hours.groupBy("date_hour").agg(F.count("*").alias("n"))
    grid = hour_sequence(spark, span.a, span.b).join(counts, "date_hour", "left")
    return grid.select("date_hour", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def day_grid(spark, sf_dir):
    """Every day of the orders' span with its order count, empty days included."""
    days = st.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", t.DAY_PATH).alias("date")
    )
    span = days.agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
    counts = days.groupBy("date").agg(F.count("*").alias("n"))
    grid = day_sequence(spark, span.a, span.b).join(counts, "date", "left")
    return grid.select("date", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


QUERIES = {
    "unframe_packets": unframe_packets,
    "slice_braces": slice_braces,
    "drop_empty_packets": drop_empty_packets,
    "extract_event_type": extract_event_type,
    "rows_to_json": rows_to_json,
    "typed_projection": typed_projection,
    "event_times": event_times,
    "zone_times": zone_times,
    "time_formats": time_formats,
    "path_hashes": path_hashes,
    "hours_from_paths": hours_from_paths,
    "path_parts": path_parts,
    "clean_paths": clean_paths,
    "trim_keys": trim_keys,
    "default_empty_ids": default_empty_ids,
    "event_envelopes": event_envelopes,
    "envelope_columns": envelope_columns,
    "hour_grid": hour_grid,
    "day_grid": day_grid,
}

_TEXTS = """
texts AS (
  SELECT 'page' AS kind, page_id AS id, html AS value FROM pages
  UNION ALL SELECT 'document', doc_id, text FROM documents)"""
_SLICES = """
slices AS (
  SELECT kind, id,
         CASE WHEN a > 0 AND b > a THEN substr(value, a, b - a + 1) ELSE '' END AS part
  FROM (SELECT *, strpos(value, '{') AS a,
               CASE WHEN contains(value, '}')
                    THEN length(value) - strpos(reverse(value), '}') + 1 ELSE 0 END AS b
        FROM texts))"""
_PIECES = """
pieces AS (
  SELECT kind, id, unnest(string_split(value, '*##*')) AS value FROM texts)"""
# US daylight saving time: until 2006 from the first Sunday of April to the last
# of October, then from the second of March to the first of November, at 02:00
# local time.  The order dates are midnights UTC, 16:00 or 17:00 the day before.
_PACIFIC = """
spring AS (
  SELECT y, CASE WHEN y < 2007 THEN make_date(y, 4, 1) ELSE make_date(y, 3, 8) END AS s,
         CASE WHEN y < 2007 THEN make_date(y, 10, 25) ELSE make_date(y, 11, 1) END AS e
  FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)),
saving AS (
  SELECT y, CAST(s AS TIMESTAMP) + to_days(CAST((7 - dayofweek(s)) % 7 AS INTEGER)) + INTERVAL 10 HOUR AS s,
         CAST(e AS TIMESTAMP) + to_days(CAST((7 - dayofweek(e)) % 7 AS INTEGER)) + INTERVAL 9 HOUR AS e
  FROM spring)"""

SQL = {
    "unframe_packets": st.with_parts(
        "SELECT date_hour, packet FROM packets", st.RAW_SQL, st.PACKET_SQL
    ),
    "slice_braces": st.with_parts(
        "SELECT kind, id, length(part) AS chars, md5(part) AS hash FROM slices", _TEXTS, _SLICES
    ),
    "drop_empty_packets": st.with_parts(
        "SELECT kind, id, md5(part) AS hash FROM slices WHERE part <> ''",
        _TEXTS, _PIECES, _SLICES.replace("FROM texts", "FROM pieces"),
    ),
    "extract_event_type": "SELECT event_id, event_type FROM events",
    "rows_to_json": st.with_parts(
        "SELECT event_id, '{\"event_type\":\"' || event_type || '\"' "
        "|| CASE WHEN event_type <> 'click' THEN ',\"value\":' || value ELSE '' END "
        "|| CASE WHEN event_type <> 'view' THEN ',\"k\":' || k ELSE '' END || '}' AS json FROM raw",
        st.RAW_SQL,
    ),
    "typed_projection": st.with_parts(
        "SELECT date_hour, event_type AS event_name, ms AS ts, uid AS player_key, event_value "
        "FROM typed",
        st.RAW_SQL, st.VALUE_SQL,
    ),
    "event_times": (
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc, "
        "strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS pacific, "
        "strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS india FROM events"
    ),
    "zone_times": st.with_parts(
        "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS india, "
        "strftime(o_orderdate - CASE WHEN o_orderdate >= s AND o_orderdate < e "
        "THEN INTERVAL 7 HOUR ELSE INTERVAL 8 HOUR END, '%Y-%m-%d %H:%M:%S') AS pacific "
        "FROM orders JOIN saving ON y = year(o_orderdate)",
        _PACIFIC,
    ),
    "time_formats": (
        "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y/%m/%d/%H') AS hour_path, "
        "strftime(ts, '%Y-%m-%d %H:%M:%S') AS second, strftime(ts, '%Y%m%d') AS compact_day, "
        "strftime(ts, '%Y-%m-%d_%H-%M-%S') AS file_stamp, strftime(ts, '%Y/%m/%d') AS day_path, "
        "strftime(ts, '%Y-%m-%d %H:%M') AS minute, strftime(ts, '%Y%m%d%H%M%S') AS run_stamp FROM events"
    ),
    "path_hashes": st.with_parts(
        "SELECT event_id, md5('hdfs://cluster:8020' || clean_path) AS hashed_path FROM raw",
        st.RAW_SQL,
    ),
    "hours_from_paths": st.with_parts(
        "SELECT 'hdfs://cluster:8020' || clean_path AS path, date_hour, date_hour AS any_root FROM raw "
        "UNION ALL SELECT url, '', '' FROM pages",
        st.RAW_SQL,
    ),
    "path_parts": st.with_parts(
        "SELECT event_id, date_hour AS tail, substr(date_hour, 1, 10) AS day, "
        "substr(date_hour, 12) AS hour, date_hour || '/part-' || event_id AS behind_root, "
        "date_hour FROM raw",
        st.RAW_SQL,
    ),
    "clean_paths": (
        "SELECT page_id, substr(rest, CASE WHEN contains(rest, '/') THEN strpos(rest, '/') "
        "ELSE length(rest) + 1 END) AS clean "
        "FROM (SELECT page_id, substr(url, strpos(url, '://') + 3) AS rest FROM pages)"
    ),
    "trim_keys": st.with_parts(
        "SELECT event_id, uid AS key, c_name AS goc_id FROM raw JOIN customer ON c_custkey = user_id "
        f"WHERE c_mktsegment <> '{st.UNREGISTERED}'",
        st.RAW_SQL,
    ),
    "default_empty_ids": st.with_parts(
        "SELECT event_id, uid AS user_id, CASE WHEN event_type <> 'error' "
        "THEN CAST(user_id AS VARCHAR) ELSE '' END AS numeric_user_id FROM raw",
        st.RAW_SQL,
    ),
    "event_envelopes": st.with_parts(
        f"SELECT envelope, '{st.GAME}' AS game_id, goc_id, event_time, event_type AS event_name, "
        "event_value FROM enveloped WHERE goc_id <> ''",
        st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL, st.ENVELOPE_SQL,
    ),
    "envelope_columns": st.with_parts(
        f"SELECT '{st.GAME}' AS game_id, event_time, event_type AS event_name, goc_id AS user_id, "
        "CASE WHEN event_type = 'view' THEN -1 ELSE k END AS k, "
        "CASE WHEN event_type = 'click' THEN -1.0 ELSE value END AS value, "
        "event_id, ms AS epoch_time, uid AS user_id_hashed, "
        "CAST(user_id AS VARCHAR) AS user_id_numeric FROM resolved WHERE goc_id <> ''",
        st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL,
    ),
    "hour_grid": st.with_parts(
        "SELECT strftime(h, '%Y/%m/%d/%H') AS date_hour, count(raw.event_id) AS n "
        "FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS h "
        "FROM raw) LEFT JOIN raw ON date_hour = strftime(h, '%Y/%m/%d/%H') GROUP BY 1",
        st.RAW_SQL,
    ),
    "day_grid": (
        "SELECT strftime(d, '%Y/%m/%d') AS date, count(o_orderkey) AS n FROM (SELECT "
        "unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders) "
        "LEFT JOIN orders ON o_orderdate = d GROUP BY 1"
    ),
}
