"""What is still to be read: hours by watermark, files by ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom import scratch_path
from eventloom.functions.times import DAY_PATH
from eventloom.operators.backlog import (
    FEWEST_HOURS_AFTER_WATERMARK, HASH_LEDGER_HORIZON_HOURS, HOUR_LEDGER_HORIZON_HOURS,
    append_listings, backfill_hours, flag_unread, group_paths, hold_back, horizon, hours_after, lag_rows,
    next_day_hours, not_current, not_read, pending_hours, settled, unread_by_hour, unseen,
)
from eventloom.sources import (
    append_hashes, bootstrap_hashes, list_hours, read_hash_ledger, read_hour_ledger,
    replace_hour_cells,
)

from . import standins as st

# Marks in the data's span.  ABSENT is an hour no event has: it is out of the span.
LATE_MARK = "2024/01/10/20"
EARLY_MARK = "2024/01/10/19"
ABSENT_MARK = "2023/12/31/23"


def _hours(spark, sf_dir):
    return list_hours(st.file_listing(spark, sf_dir))


def _cells(listing):
    return listing.where(F.col("date_hour") < st.CUT_OFF).select(
        F.left("date_hour", F.lit(10)).alias("date"),
        F.right("date_hour", F.lit(2)).alias("hour"),
        F.col("clean_path").alias("path"),
    )


def unseen_files(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    ledger = scratch_path(spark, "hashes")
    append_hashes(listing.where(F.col("date_hour") < st.CUT_OFF), ledger)
    return unseen(listing, read_hash_ledger(spark, ledger)).select("event_id", "path")


def flagged_files(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    return flag_unread(listing, _cells(listing)).select("event_id", "date_hour", "processed")


def settled_files(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    return settled(listing, F.to_timestamp(F.lit(st.NOW))).select("event_id", "path")


def hours_after_watermark(spark, sf_dir):
    hours = _hours(spark, sf_dir)
    cases = [("present", st.CUT_OFF, "none"), ("absent", ABSENT_MARK, "none"), ("restart", ABSENT_MARK, "all")]
    frames = [
        hours_after(hours, mark, missing).select(F.lit(name).alias("case"), "date_hour")
        for name, mark, missing in cases
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def hold_back_newest(spark, sf_dir):
    return hold_back(_hours(spark, sf_dir))


def leave_out_current(spark, sf_dir):
    return not_current(_hours(spark, sf_dir), st.NOW_HOUR)


def next_day_rollover(spark, sf_dir):
    hours = _hours(spark, sf_dir)
    early = next_day_hours(hours, EARLY_MARK).select(F.lit("early").alias("case"), "date_hour")
    late = next_day_hours(hours, LATE_MARK).select(F.lit("late").alias("case"), "date_hour")
    return early.unionByName(late)


def pending_hour_plan(spark, sf_dir):
    return pending_hours(_hours(spark, sf_dir), LATE_MARK, "2024/01/11/05")


def backfill_after_last_hour(spark, sf_dir):
    """Events per hour of a backfill: behind a bare hour, and all hours after hour 23."""
    counts = st.file_listing(spark, sf_dir).groupBy("date_hour").agg(F.count("*").alias("files"))
    span = counts.agg(F.min("date_hour").alias("a"), F.max("date_hour").alias("b")).first()
    frames = [
        backfill_hours(spark, span.a[:10], span.b[:10], mark)
        .join(counts, "date_hour", "left")
        .select(
            F.lit(mark).alias("mark"), "date_hour",
            F.coalesce("files", F.lit(0)).cast("bigint").alias("files"),
        )
        for mark in ("/07", "23")
    ]
    return frames[0].unionByName(frames[1])


def late_horizons(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    frames = [
        listing.where(F.col("date_hour").isin(horizon(st.NOW_HOUR, size)))
        .groupBy("date_hour")
        .agg(F.count("*").alias("files"))
        .select(F.lit(size).alias("horizon"), "date_hour", "files")
        for size in (HASH_LEDGER_HORIZON_HOURS, HOUR_LEDGER_HORIZON_HOURS)
    ]
    return frames[0].unionByName(frames[1])


def lag_check(spark, sf_dir):
    """One alert behind the newest hour but one, none behind an early one."""
    hours = _hours(spark, sf_dir)
    newest = hours.agg(F.max("date_hour").alias("h")).first().h
    lagging = lag_rows(hours_after(hours, newest), FEWEST_HOURS_AFTER_WATERMARK, "plan")
    fine = lag_rows(hours_after(hours, st.CUT_OFF), FEWEST_HOURS_AFTER_WATERMARK, "early")
    return lagging.unionByName(fine).select("stage", "kind", "n")


def files_by_hour(spark, sf_dir):
    return group_paths(st.file_listing(spark, sf_dir)).orderBy("date_hour", "position")


def unread_files_by_hour(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    return unread_by_hour(flag_unread(listing, _cells(listing)))


def joined_path_cells(spark, sf_dir):
    """The cells in the ledger's form: a row per path with its place in the hour's cell."""
    return group_paths(st.file_listing(spark, sf_dir), path="clean_path")


def union_listings(spark, sf_dir):
    """Each file's listing in its own day and, appended, in the day before it."""
    listing = st.file_listing(spark, sf_dir)
    own = listing.select("event_id", F.left("date_hour", F.lit(10)).alias("listed_for"))
    before = listing.select(
        "event_id",
        F.date_format(F.date_sub(F.col("modification_time"), 1), DAY_PATH).alias("listed_for"),
    )
    return append_listings(own, before)


def file_set_difference(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    read = listing.where(F.col("date_hour") < st.CUT_OFF)
    return not_read(listing, read)


def appended_file_ledger(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    ledger = scratch_path(spark, "hashes")
    early = F.col("date_hour") < st.CUT_OFF
    bootstrap_hashes(listing.where(early), ledger)
    append_hashes(listing.where(~early), ledger)
    return spark.read.parquet(ledger).select("hashed_path", "path", "datetime")


def replaced_hour_cells(spark, sf_dir):
    """Cells first hold only the views' files; those of late hours are then replaced."""
    listing = st.file_listing(spark, sf_dir)
    views = listing.join(
        st.table(spark, sf_dir, "events").where("event_type = 'view'").select("event_id"),
        "event_id", "left_semi",
    )
    ledger = scratch_path(spark, "cells")
    replace_hour_cells(views, ledger)
    replace_hour_cells(listing.where(F.col("date_hour") >= st.CUT_OFF), ledger)
    return read_hour_ledger(spark, ledger)


QUERIES = {
    "unseen_files": unseen_files,
    "flagged_files": flagged_files,
    "settled_files": settled_files,
    "hours_after_watermark": hours_after_watermark,
    "hold_back_newest": hold_back_newest,
    "leave_out_current": leave_out_current,
    "next_day_rollover": next_day_rollover,
    "pending_hour_plan": pending_hour_plan,
    "backfill_after_last_hour": backfill_after_last_hour,
    "late_horizons": late_horizons,
    "lag_check": lag_check,
    "files_by_hour": files_by_hour,
    "unread_files_by_hour": unread_files_by_hour,
    "joined_path_cells": joined_path_cells,
    "union_listings": union_listings,
    "file_set_difference": file_set_difference,
    "appended_file_ledger": appended_file_ledger,
    "replaced_hour_cells": replaced_hour_cells,
}

_HOURS = "hours AS (SELECT DISTINCT date_hour FROM raw)"
_FULL = "'hdfs://cluster:8020' || clean_path"


def _raw(body, *more):
    return st.with_parts(body, st.RAW_SQL, *more)


SQL = {
    "unseen_files": _raw(
        f"SELECT event_id, {_FULL} AS path FROM raw WHERE date_hour >= '{st.CUT_OFF}'"
    ),
    "flagged_files": _raw(
        f"SELECT event_id, date_hour, date_hour < '{st.CUT_OFF}' AS processed FROM raw"
    ),
    "settled_files": _raw(
        f"SELECT event_id, {_FULL} AS path FROM raw "
        f"WHERE floor((epoch(TIMESTAMP '{st.NOW}') - floor(epoch(ts))) / 60.0) > 5"
    ),
    "hours_after_watermark": _raw(
        f"SELECT 'present' AS \"case\", date_hour FROM hours WHERE date_hour > '{st.CUT_OFF}' "
        f"AND EXISTS (SELECT 1 FROM hours WHERE date_hour = '{st.CUT_OFF}') "
        "UNION ALL SELECT 'restart', date_hour FROM hours",
        _HOURS,
    ),
    "hold_back_newest": _raw(
        "SELECT date_hour FROM (SELECT date_hour, row_number() OVER (ORDER BY date_hour DESC) AS r "
        "FROM hours) WHERE r > 3",
        _HOURS,
    ),
    "leave_out_current": _raw(
        f"SELECT date_hour FROM hours WHERE date_hour <> '{st.NOW_HOUR}'", _HOURS
    ),
    "next_day_rollover": _raw(
        "SELECT 'early' AS \"case\", date_hour FROM hours WHERE date_hour LIKE '2024/01/10/%' "
        "UNION ALL SELECT 'late', date_hour FROM hours "
        "WHERE date_hour LIKE '2024/01/10/%' OR date_hour LIKE '2024/01/11/%'",
        _HOURS,
    ),
    "pending_hour_plan": _raw(
        "SELECT date_hour FROM (SELECT date_hour, row_number() OVER (ORDER BY date_hour DESC) AS r "
        f"FROM hours WHERE date_hour > '{LATE_MARK}' AND date_hour < '2024/01/12') "
        "WHERE r > 3 AND date_hour <> '2024/01/11/05'",
        _HOURS,
    ),
    "backfill_after_last_hour": _raw(
        "SELECT mark, strftime(h, '%Y/%m/%d/%H') AS date_hour, count(raw.event_id) AS files "
        "FROM grid CROSS JOIN (VALUES ('/07'), ('23')) AS marks(mark) "
        "LEFT JOIN raw ON date_hour = strftime(h, '%Y/%m/%d/%H') "
        "WHERE mark = '23' OR h > first + INTERVAL 7 HOUR GROUP BY 1, 2",
        "grid AS (SELECT first, unnest(generate_series(first, last + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS h "
        "FROM (SELECT date_trunc('day', min(ts)) AS first, date_trunc('day', max(ts)) AS last FROM raw))",
    ),
    "late_horizons": _raw(
        "SELECT CAST(horizon AS INTEGER) AS horizon, date_hour, count(*) AS files FROM raw "
        "JOIN (VALUES (24), (600)) AS sizes(horizon) "
        "ON date_trunc('hour', ts) BETWEEN TIMESTAMP '2024-01-20 21:00:00' - to_hours(horizon) "
        "AND TIMESTAMP '2024-01-20 21:00:00' GROUP BY 1, 2"
    ),
    "lag_check": _raw(
        "SELECT 'plan' AS stage, 'lag' AS kind, CAST(0 AS BIGINT) AS n UNION ALL "
        "SELECT 'early', 'lag', n FROM (SELECT count(*) FILTER (EXISTS (SELECT 1 FROM hours "
        f"WHERE date_hour = '{st.CUT_OFF}') AND date_hour > '{st.CUT_OFF}') AS n FROM hours) WHERE n < 2",
        _HOURS,
    ),
    "files_by_hour": _raw(
        f"SELECT date_hour, {_FULL} AS path, "
        f"row_number() OVER (PARTITION BY date_hour ORDER BY {_FULL}) AS position FROM raw"
    ),
    "unread_files_by_hour": _raw(
        "SELECT left(date_hour, 10) AS date, right(date_hour, 2) AS hour, clean_path AS path, "
        "row_number() OVER (PARTITION BY date_hour ORDER BY clean_path) AS position "
        f"FROM raw WHERE date_hour >= '{st.CUT_OFF}'"
    ),
    "joined_path_cells": _raw(
        "SELECT date_hour, clean_path AS path, "
        "row_number() OVER (PARTITION BY date_hour ORDER BY clean_path) AS position FROM raw"
    ),
    "union_listings": _raw(
        "SELECT event_id, strftime(ts, '%Y/%m/%d') AS listed_for FROM raw UNION ALL "
        "SELECT event_id, strftime(ts - INTERVAL 1 DAY, '%Y/%m/%d') FROM raw"
    ),
    "file_set_difference": _raw(
        f"SELECT {_FULL} AS path FROM raw WHERE date_hour >= '{st.CUT_OFF}'"
    ),
    "appended_file_ledger": _raw(
        f"SELECT md5({_FULL}) AS hashed_path, {_FULL} AS path, "
        "strftime(ts, '%Y-%m-%d %H:%M') AS datetime FROM raw"
    ),
    "replaced_hour_cells": _raw(
        "SELECT left(date_hour, 10) AS date, right(date_hour, 2) AS hour, clean_path AS path "
        f"FROM raw WHERE date_hour >= '{st.CUT_OFF}' OR event_type = 'view'"
    ),
}
