"""Sources: every query writes files from the given tables and scans them."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom import scratch_path
from eventloom.functions.text import RECORD_SEPARATOR, packets_of
from eventloom.functions.times import HOUR_PATH
from eventloom.operators.backlog import flag_unread
from eventloom.operators.route import early_allowlist
from eventloom.sinks.publish import hour_columns
from eventloom.sources import (
    append_hashes, bootstrap_hashes, list_files, merge_identity, packet_fields, parse_packets,
    read_catalog, read_hash_ledger, read_hour_ledger, read_identity, read_json_events, read_lines, read_listed,
    read_records, read_watermark, replace_hour_cells, write_watermark,
)

from . import standins as st


def scan_hour_directories(spark, sf_dir):
    lines = read_lines(spark, f"{st.raw_files(spark, sf_dir)}/*/*")
    return lines.groupBy("date_hour").agg(
        F.count("*").alias("lines"),
        F.sum(F.size(packets_of("value"))).cast("bigint").alias("packets"),
    )


def scan_file_list(spark, sf_dir):
    """Reads exactly the files their hour's ledger cell lacks."""
    root = st.raw_files(spark, sf_dir)
    listing = list_files(spark, root)
    ledger = scratch_path(spark, "cells")
    replace_hour_cells(listing.where(F.col("date_hour") < st.CUT_OFF), ledger)
    unread = flag_unread(listing, read_hour_ledger(spark, ledger)).where("NOT processed")
    hours = [r.date_hour for r in unread.select("date_hour").distinct().collect()]
    lines = read_listed(spark, root, unread, hours, partitioned=True)
    return lines.groupBy("date_hour").agg(F.count("*").alias("lines"))


def scan_separated_records(spark, sf_dir):
    """Records that hold newlines, told apart by the record separator alone."""
    events = st.raw_events(spark, sf_dir)
    root = scratch_path(spark, "records")
    pretty = F.to_json(F.struct(*st.FIELDS), {"pretty": "true"}).alias("value")
    rows = hour_columns(events.select(pretty, "date_hour")).select("date", "hour", "value")
    rows.hint("rebalance", "date", "hour").write.option("lineSep", RECORD_SEPARATOR).partitionBy(
        "date", "hour"
    ).text(root)
    records = early_allowlist(read_records(spark, root), st.PROFILE.event_names)
    return records.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
        "event_type",
        "date_hour",
        F.contains("value", F.lit("\n")).alias("has_newline"),
    )


def _json_root(spark, sf_dir):
    root = scratch_path(spark, "json")
    rows = hour_columns(st.raw_events(spark, sf_dir)).drop("date_hour")
    rows.hint("rebalance", "date", "hour").write.partitionBy("date", "hour").json(root)
    return root


def _json_counts(rows):
    return rows.groupBy("date_hour", "event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("k").cast("bigint")).alias("sum_k")
    )


def scan_json_lines(spark, sf_dir):
    fields = packet_fields(st.PROFILE, st.TYPES)
    return _json_counts(read_json_events(spark, _json_root(spark, sf_dir), fields))


def scan_json_inferred(spark, sf_dir):
    return _json_counts(read_json_events(spark, _json_root(spark, sf_dir)))


def parse_json_packets(spark, sf_dir):
    lines = st.framed_events(spark, sf_dir)
    parsed = parse_packets(lines, packet_fields(st.PROFILE, st.TYPES))
    return parsed.select(
        F.col("event_id").cast("bigint").alias("event_id"), "event_type",
        F.col("ts").cast("bigint").alias("ts"), "user_id", "numeric_user_id",
        F.col("value").cast("double").alias("value"), F.col("k").cast("bigint").alias("k"),
        F.col("corrupt").isNotNull().alias("is_corrupt"),
    )


# Invented: a type for the column each customer stands for.
SEGMENT_TAGS = {
    "AUTOMOBILE": "string", "BUILDING": "long", "FURNITURE": "boolean", "HOUSEHOLD": "array",
    "MACHINERY": "double",
}


def read_type_catalog(spark, sf_dir):
    customers = st.table(spark, sf_dir, "customer")
    tags = F.create_map(*[F.lit(x) for pair in SEGMENT_TAGS.items() for x in pair])
    line = F.concat(
        F.lit(" attr_"), F.col("c_custkey"), F.lit(" : "), tags[F.col("c_mktsegment")], F.lit(" \n")
    )
    path = scratch_path(spark, "catalog")
    customers.select(line.alias("value")).write.text(path)
    return read_catalog(spark, path)


def read_file_ledger(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    ledger = scratch_path(spark, "hashes")
    bootstrap_hashes(listing.where(F.col("date_hour") < st.CUT_OFF), ledger)
    append_hashes(listing, ledger)
    return read_hash_ledger(spark, ledger).distinct()


def read_stored_watermark(spark, sf_dir):
    events = st.table(spark, sf_dir, "events")
    newest = events.agg(F.date_format(F.max("ts"), HOUR_PATH).alias("h")).first().h
    path = scratch_path(spark, "watermark")
    write_watermark(spark, newest, path)
    mark = read_watermark(spark, path)
    hours = events.select(F.date_format("ts", HOUR_PATH).alias("date_hour"))
    return hours.where(F.col("date_hour") <= mark).groupBy("date_hour").agg(
        F.count("*").alias("n")
    )


def dealt_lines(spark, sf_dir):
    """Lines dealt out anew over tasks; none is lost."""
    lines = read_lines(spark, f"{st.raw_files(spark, sf_dir)}/*/*", partitions=16)
    packets = parse_packets(lines, packet_fields(st.PROFILE, st.TYPES))
    return packets.groupBy("date_hour", "event_type").agg(F.count("*").alias("n"))


def list_files_with_times(spark, sf_dir):
    listing = list_files(spark, st.raw_files(spark, sf_dir))
    return listing.groupBy("date_hour").agg(
        F.bool_and(F.col("modification_time").isNotNull()).alias("timed"),
        F.bool_and(F.col("length") > 0).alias("filled"),
        F.bool_and(F.col("clean_path").startswith("/")).alias("cleaned"),
    )


def scan_identity_table(spark, sf_dir):
    path = scratch_path(spark, "identity")
    merge_identity(st.identity(spark, sf_dir), path)
    return read_identity(spark, path).select("player_id", "goc_id", "numeric_id", "seq")


def read_hour_cells(spark, sf_dir):
    ledger = scratch_path(spark, "cells")
    replace_hour_cells(st.file_listing(spark, sf_dir), ledger)
    return read_hour_ledger(spark, ledger).groupBy("date", "hour").agg(
        F.count("*").alias("paths"), F.min("path").alias("first_path")
    )


QUERIES = {
    "scan_hour_directories": scan_hour_directories,
    "scan_file_list": scan_file_list,
    "scan_separated_records": scan_separated_records,
    "scan_json_lines": scan_json_lines,
    "scan_json_inferred": scan_json_inferred,
    "parse_json_packets": parse_json_packets,
    "read_type_catalog": read_type_catalog,
    "read_file_ledger": read_file_ledger,
    "read_stored_watermark": read_stored_watermark,
    "dealt_lines": dealt_lines,
    "list_files_with_times": list_files_with_times,
    "scan_identity_table": scan_identity_table,
    "read_hour_cells": read_hour_cells,
}

_JSON_COUNTS = st.with_parts(
    "SELECT date_hour, event_type, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k "
    "FROM raw GROUP BY 1, 2",
    st.RAW_SQL,
)

SQL = {
    "scan_hour_directories": st.with_parts(
        "SELECT date_hour, count(DISTINCT event_id // 8) AS lines, count(*) AS packets "
        "FROM raw GROUP BY 1",
        st.RAW_SQL,
    ),
    "scan_file_list": st.with_parts(
        f"SELECT date_hour, count(DISTINCT event_id // 8) AS lines FROM raw "
        f"WHERE date_hour >= '{st.CUT_OFF}' GROUP BY 1",
        st.RAW_SQL,
    ),
    "scan_separated_records": st.with_parts(
        "SELECT event_id, event_type, date_hour, true AS has_newline FROM raw "
        "WHERE event_type IN ('click', 'view', 'purchase')",
        st.RAW_SQL,
    ),
    "scan_json_lines": _JSON_COUNTS,
    "scan_json_inferred": _JSON_COUNTS,
    "parse_json_packets": st.with_parts(
        "SELECT event_id, event_type, ms AS ts, uid AS user_id, "
        "CAST(user_id AS VARCHAR) AS numeric_user_id, value, k, false AS is_corrupt FROM raw",
        st.RAW_SQL,
    ),
    "read_type_catalog": (
        "SELECT 'attr_' || c_custkey AS column_name, CASE c_mktsegment "
        + " ".join(f"WHEN '{s}' THEN '{t}'" for s, t in SEGMENT_TAGS.items())
        + " END AS column_type FROM customer"
    ),
    "read_file_ledger": st.with_parts(
        "SELECT DISTINCT md5('hdfs://cluster:8020' || clean_path) AS hashed_path FROM raw",
        st.RAW_SQL,
    ),
    "read_stored_watermark": st.with_parts(
        "SELECT date_hour, count(*) AS n FROM raw "
        "WHERE date_hour <= (SELECT max(date_hour) FROM raw) GROUP BY 1",
        st.RAW_SQL,
    ),
    "dealt_lines": st.with_parts(
        "SELECT date_hour, event_type, count(*) AS n FROM raw GROUP BY 1, 2", st.RAW_SQL
    ),
    "list_files_with_times": st.with_parts(
        "SELECT DISTINCT date_hour, true AS timed, true AS filled, true AS cleaned FROM raw",
        st.RAW_SQL,
    ),
    "scan_identity_table": (
        "SELECT 'p' || c_custkey AS player_id, c_name AS goc_id, "
        "CAST(c_custkey AS VARCHAR) AS numeric_id, CAST(1 AS BIGINT) AS seq "
        f"FROM customer WHERE c_mktsegment <> '{st.UNREGISTERED}'"
    ),
    "read_hour_cells": st.with_parts(
        "SELECT substr(date_hour, 1, 10) AS date, substr(date_hour, 12, 2) AS hour, "
        "count(*) AS paths, min(clean_path) AS first_path FROM raw GROUP BY 1, 2",
        st.RAW_SQL,
    ),
}
