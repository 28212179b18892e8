"""Which runs count: used names, hours that are replaced, files that are merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators.backlog import settled_before
from eventloom.plans.ingest import backfill_run, hash_ledger_run, published_rows, replay, watermark_run
from eventloom.plans.merge import merge_small_files, published_files
from eventloom.sources import RunNameUsed, list_files, write_watermark

from . import standins as st
from .runs import NEWEST_MARK, layout_for, whole_span


def _counting(spark, layout):
    return published_rows(spark, layout).withColumnRenamed("value", "envelope")


def refused_run_names(spark, sf_dir):
    """Other kinds of runs under the name of a finished one: refused, and its rows stay."""
    layout = layout_for(spark, sf_dir)
    hash_ledger_run(spark, layout, st.PROFILE, st.TYPES, run="one", **whole_span(spark, sf_dir))
    refused = 0
    for again in (
        lambda: replay(spark, layout, st.PROFILE, "one"),
        lambda: backfill_run(spark, layout, st.PROFILE, st.TYPES, "2024/01/01", "2024/01/02", run="one"),
        lambda: hash_ledger_run(spark, layout, st.PROFILE, st.TYPES, run="one", **whole_span(spark, sf_dir)),
    ):
        try:
            again()
        except RunNameUsed:
            refused += 1
    return _counting(spark, layout).withColumn("refused", F.lit(refused))


def counting_published_rows(spark, sf_dir):
    """A backfill takes the place of the hours of a watermark run; each row has its run."""
    layout = layout_for(spark, sf_dir)
    listing = st.file_listing(spark, sf_dir)
    hours = listing.where(
        (F.col("date_hour") <= NEWEST_MARK) & (F.right("date_hour", F.lit(2)) >= "20")
    )
    mark = hours.agg(F.max("date_hour")).first()[0]
    write_watermark(spark, mark, layout.watermark)
    watermark_run(spark, layout, st.PROFILE, st.TYPES, now="2024-01-12 05:00:00")
    day = f"{mark[:8]}{int(mark[8:10]) + 1:02d}"
    backfill_run(spark, layout, st.PROFILE, st.TYPES, day, day, watermark=f"{day}/05", run="again")
    rows = _counting(spark, layout)
    return rows.select("envelope", "date_hour", (F.col("run") == "again").alias("replaced"))


def merged_hour_files(spark, sf_dir):
    """Two ledger runs share hours; merged, each hour lies in one file and has all its rows."""
    layout = layout_for(spark, sf_dir)
    span = whole_span(spark, sf_dir)
    users = st.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("p"), F.col("c_custkey")).alias("user_id"), (F.col("c_custkey") % 2).alias("half")
    )
    days = st.file_listing(spark, sf_dir).agg(F.min("date_hour").alias("a"), F.max("date_hour").alias("b")).first()
    for half in (0, 1):
        backfill_run(
            spark, layout, st.PROFILE, st.TYPES, days.a[:10], days.b[:10], run=f"half-{half}",
            users=users.where(F.col("half") == half).select("user_id"),
        )
    merge_small_files(spark, layout, until=span["until"], run="merged")
    files = published_files(spark, layout).groupBy("date_hour").agg(F.count("*").alias("files"))
    return _counting(spark, layout).join(files, "date_hour").select("envelope", "date_hour", "files")


def settled_by_index(spark, sf_dir):
    """Hours with files that are settled, by bounds the file index applies; and with young ones."""
    root = st.raw_files(spark, sf_dir)
    bound = settled_before("2100-01-01 00:00:00")
    old = list_files(spark, root, before=bound).select("date_hour", F.lit(True).alias("settled"))
    young = list_files(spark, root, after=bound).select("date_hour", F.lit(False).alias("settled"))
    return old.unionByName(young).distinct()


QUERIES = {
    "refused_run_names": refused_run_names,
    "counting_published_rows": counting_published_rows,
    "merged_hour_files": merged_hour_files,
    "settled_by_index": settled_by_index,
}

_PARTS = (st.RAW_SQL, st.VALUE_SQL, st.RESOLVED_SQL, st.ENVELOPE_SQL)

SQL = {
    "refused_run_names": st.with_parts(
        "SELECT envelope, 'one' AS run, date_hour, 3 AS refused FROM enveloped WHERE goc_id <> ''", *_PARTS
    ),
    "counting_published_rows": st.with_parts(
        "SELECT envelope, date_hour, date_hour > day || '/05' AS replaced FROM enveloped, mark "
        "WHERE goc_id <> '' AND (date_hour IN (SELECT date_hour FROM due) "
        "OR (left(date_hour, 10) = day AND date_hour > day || '/05'))",
        *_PARTS,
        "mark AS (SELECT max(ts) AS m, strftime(max(ts) + INTERVAL 1 DAY, '%Y/%m/%d') AS day FROM raw "
        f"WHERE right(date_hour, 2) >= '20' AND date_hour <= '{NEWEST_MARK}')",
        "due AS (SELECT date_hour FROM (SELECT date_hour, "
        "row_number() OVER (ORDER BY date_hour DESC) AS r FROM (SELECT DISTINCT date_hour "
        "FROM raw, mark WHERE date_hour > strftime(m, '%Y/%m/%d/%H') "
        "AND ts < date_trunc('day', m) + INTERVAL 2 DAY)) WHERE r > 3)",
    ),
    "merged_hour_files": st.with_parts(
        "SELECT envelope, date_hour, CAST(1 AS BIGINT) AS files FROM enveloped WHERE goc_id <> ''", *_PARTS
    ),
    "settled_by_index": st.with_parts("SELECT DISTINCT date_hour, true AS settled FROM raw", st.RAW_SQL),
}
