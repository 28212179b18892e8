"""Sinks: every query writes whole results and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom import scratch_path
from eventloom.functions.paths import date_hour_of_path
from eventloom.plans.ingest import transform
from eventloom.sinks import copy_text, publish_topic, write_by_hour, write_by_run
from eventloom.sources import (
    bootstrap_hashes, packet_fields, parse_packets, read_watermark, write_watermark,
)

from . import standins as st


def published(spark, sf_dir):
    lines = st.packet_text(st.raw_events(spark, sf_dir))
    parsed = parse_packets(lines, packet_fields(st.PROFILE, st.TYPES))
    rows = transform(parsed, st.PROFILE, st.TYPES, st.identity(spark, sf_dir))
    return rows.where("route = 'published'")


def read_published(spark, path):
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    return text.select(
        F.col("value").alias("envelope"), date_hour_of_path("_metadata.file_path").alias("date_hour")
    )


def published_topic(spark, sf_dir):
    """A topic stood in for by text files: values only."""
    path = scratch_path(spark, "topic")
    publish_topic(published(spark, sf_dir), path, sink="text")
    return spark.read.text(path).select(F.col("value").alias("envelope"))


def envelopes_by_hour(spark, sf_dir):
    path = scratch_path(spark, "by-hour")
    rows = published(spark, sf_dir)
    write_by_hour(rows, path)
    write_by_hour(rows.where(F.col("date_hour") >= st.CUT_OFF), path)
    return read_published(spark, path)


def envelopes_by_run(spark, sf_dir):
    """Two runs write the same hours; the first one is then repeated."""
    path = scratch_path(spark, "by-run")
    rows = published(spark, sf_dir)
    clicks = rows.where("event_name = 'click'")
    write_by_run(clicks, path, "20240120220000")
    write_by_run(rows.where("event_name <> 'click'"), path, "20240120230000")
    write_by_run(clicks, path, "20240120220000")
    runs = spark.read.option("recursiveFileLookup", "true").text(path)
    return runs.select(
        F.col("value").alias("envelope"),
        F.regexp_extract("_metadata.file_path", "run=([0-9]+)", 1).alias("run"),
    )


def moved_watermark(spark, sf_dir):
    """The mark set to the cut-off, then to the newest hour; files behind it counted."""
    listing = st.file_listing(spark, sf_dir)
    newest = listing.agg(F.max("date_hour").alias("h")).first().h
    path = scratch_path(spark, "watermark")
    write_watermark(spark, st.CUT_OFF, path)
    write_watermark(spark, newest, path)
    mark = read_watermark(spark, path)
    return listing.agg(
        F.lit(mark).alias("mark"), F.count_if(F.col("date_hour") <= mark).alias("files")
    )


def seeded_file_ledger(spark, sf_dir):
    listing = st.file_listing(spark, sf_dir)
    path = scratch_path(spark, "hashes")
    bootstrap_hashes(listing, path)
    bootstrap_hashes(listing.where(F.col("date_hour") < st.CUT_OFF), path)
    return spark.read.parquet(path).select("hashed_path", "datetime")


def copied_text(spark, sf_dir):
    source = scratch_path(spark, "text")
    target = scratch_path(spark, "copy")
    st.framed_events(spark, sf_dir).select("value").write.text(source)
    copy_text(spark, source, target)
    parsed = parse_packets(spark.read.text(target), packet_fields(st.PROFILE, st.TYPES))
    return parsed.select("packet")


QUERIES = {
    "published_topic": published_topic,
    "envelopes_by_hour": envelopes_by_hour,
    "envelopes_by_run": envelopes_by_run,
    "moved_watermark": moved_watermark,
    "seeded_file_ledger": seeded_file_ledger,
    "copied_text": copied_text,
}

_PARTS = (st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL, st.ENVELOPE_SQL)

SQL = {
    "published_topic": st.with_parts("SELECT envelope FROM enveloped WHERE goc_id <> ''", *_PARTS),
    "envelopes_by_hour": st.with_parts(
        "SELECT envelope, date_hour FROM enveloped WHERE goc_id <> ''", *_PARTS
    ),
    "envelopes_by_run": st.with_parts(
        "SELECT envelope, CASE WHEN event_type = 'click' THEN '20240120220000' "
        "ELSE '20240120230000' END AS run FROM enveloped WHERE goc_id <> ''",
        *_PARTS,
    ),
    "moved_watermark": st.with_parts(
        "SELECT max(date_hour) AS mark, count(*) AS files FROM raw", st.RAW_SQL
    ),
    "seeded_file_ledger": st.with_parts(
        "SELECT md5('hdfs://cluster:8020' || clean_path) AS hashed_path, "
        f"strftime(ts, '%Y-%m-%d %H:%M') AS datetime FROM raw WHERE date_hour < '{st.CUT_OFF}'",
        st.RAW_SQL,
    ),
    "copied_text": st.with_parts("SELECT packet FROM packets", st.RAW_SQL, st.PACKET_SQL),
}
