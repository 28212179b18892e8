import os
from datetime import datetime, timezone

import pytest
from conftest import put_file
from pyspark.sql import functions as F

from eventloom.operators.backlog import (
    backfill_hours, flag_unread, group_paths, hold_back, horizon, hours_after, lag_rows,
    next_day_hours, pending_hours, settled, unread_by_hour, unseen, with_unread_hours,
)
from eventloom.sources import (
    append_hashes, bootstrap_hashes, list_files, list_hours, read_hash_ledger, read_hour_ledger,
    read_watermark, replace_hour_cells, write_watermark,
)


def hours(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "date_hour string")


def names(df):
    return sorted(r.date_hour for r in df.collect())


DAY = [f"2024/01/05/{h:02d}" for h in range(24)]
NEXT = [f"2024/01/06/{h:02d}" for h in range(24)]


def test_watermark_absent(spark):
    frame = hours(spark, *DAY[:5], *DAY[6:])
    assert names(hours_after(frame, DAY[5])) == []
    assert names(hours_after(frame, DAY[5], "all")) == sorted(DAY[:5] + DAY[6:])
    with pytest.raises(ValueError):
        hours_after(frame, DAY[5], "fail")
    for missing in ("none", "all", "fail"):
        assert names(hours_after(frame, DAY[4], missing)) == DAY[6:]


@pytest.mark.parametrize("hour, with_next", [(19, False), (20, True), (23, True)])
def test_next_day_only_late(spark, hour, with_next):
    got = names(next_day_hours(hours(spark, *DAY, *NEXT, "2024/01/07/00"), DAY[hour]))
    assert got == DAY + (NEXT if with_next else [])
    got = names(next_day_hours(hours(spark, *DAY), DAY[hour]))
    assert got == DAY


def test_pending(spark):
    frame = hours(spark, *DAY)
    assert names(pending_hours(frame, DAY[10], "2024/01/06/00")) == DAY[11:21]
    assert names(pending_hours(frame, DAY[10], DAY[15])) == DAY[11:15] + DAY[16:21]
    assert names(pending_hours(frame, DAY[10], DAY[15], held_back=0)) == DAY[11:15] + DAY[16:]
    # the newest hours are held back before the current hour is left out
    assert names(pending_hours(frame, DAY[10], DAY[23])) == DAY[11:21]
    assert names(hold_back(hours(spark, *DAY[:2]), 3)) == []


def test_lag_rows(spark):
    row = lag_rows(hours(spark, DAY[3]), 2, "plan").first()
    assert (row.kind, row.n, row.date_hour, row.samples) == ("lag", 1, DAY[3], [])
    assert lag_rows(hours(spark, *DAY[:2]), 2, "plan").isEmpty()
    assert lag_rows(hours(spark), 2, "plan").first().n == 0


def test_backfill_hours(spark):
    two = DAY + NEXT
    assert names(backfill_hours(spark, "2024/01/05", "2024/01/06")) == two
    assert names(backfill_hours(spark, "2024/01/05", "2024/01/06", "/21")) == two[22:]
    assert names(backfill_hours(spark, "2024/01/05", "2024/01/06", "23")) == two
    assert names(backfill_hours(spark, "2024/01/05", "2024/01/06", DAY[23])) == NEXT
    assert horizon("2024/01/06/01", 2) == ["2024/01/05/23", "2024/01/06/00", "2024/01/06/01"]


def test_listing(spark, tmp_path):
    a = put_file(tmp_path, DAY[3], "a", "x")
    put_file(tmp_path, DAY[4], "b", "yy")
    (tmp_path / DAY[5]).mkdir(parents=True)
    os.utime(a, (1704423600, 1704423600))
    rows = {r.clean_path: r for r in list_files(spark, str(tmp_path)).collect()}
    assert len(rows) == 2 and rows[str(a)].date_hour == DAY[3] and rows[str(a)].length == 1
    assert rows[str(a)].path == f"file:{a}"
    assert rows[str(a)].modification_time == datetime.fromtimestamp(1704423600)
    assert names(list_files(spark, str(tmp_path), [DAY[0][:10]])) == DAY[3:5]
    part = list_files(spark, str(tmp_path), [DAY[2], DAY[4], DAY[5], NEXT[0]])
    assert [r.date_hour for r in part.collect()] == [DAY[4]]
    assert list_files(spark, str(tmp_path), [NEXT[0]]).count() == 0
    assert list_files(spark, str(tmp_path), []).count() == 0
    assert names(list_hours(list_files(spark, str(tmp_path)))) == DAY[3:5]
    plan = list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


LISTING = "path string, clean_path string, date_hour string, modification_time timestamp, length bigint"


def listing(spark, *files):
    when = datetime(2024, 1, 5, 12, 0, 0, tzinfo=timezone.utc)
    return spark.createDataFrame([(f"file:/r/{h}/{n}", f"/r/{h}/{n}", h, when, 1) for h, n in files], LISTING)


@pytest.mark.parametrize("age, kept", [(0, 0), (300, 0), (359, 0), (360, 1), (3600, 1)])
def test_settled_counts_whole_minutes(spark, age, kept):
    now = F.timestamp_seconds(F.lit(1704456000 + age))
    assert settled(listing(spark, (DAY[0], "a")), now).count() == kept


def test_hash_ledger(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    first, second = (DAY[0], "a"), (DAY[1], "b")
    assert read_hash_ledger(spark, ledger).count() == 0
    bootstrap_hashes(listing(spark, first), ledger)
    rest = unseen(listing(spark, first, second, second), read_hash_ledger(spark, ledger))
    assert [r.clean_path for r in rest.collect()] == [f"/r/{DAY[1]}/b"] * 2
    assert rest.columns == listing(spark, first).columns
    append_hashes(listing(spark, second), ledger)
    append_hashes(listing(spark, second), ledger)
    assert read_hash_ledger(spark, ledger).distinct().count() == 2
    assert unseen(listing(spark, first, second), read_hash_ledger(spark, ledger)).isEmpty()
    row = spark.read.parquet(ledger).where("path like '%/a'").first()
    assert row.datetime == "2024-01-05 12:00"


def test_hash_ledger_reads_older_columns(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    old = spark.createDataFrame([("p", "t", "h1")], "path string, timestamp string, hashed_path string")
    old.write.parquet(f"{ledger}/date=none")
    append_hashes(listing(spark, (DAY[0], "a")), ledger)
    assert read_hash_ledger(spark, ledger).count() == 2


def test_hour_ledger(spark, tmp_path):
    ledger = f"{tmp_path}/cells"
    assert read_hour_ledger(spark, ledger).count() == 0
    replace_hour_cells(listing(spark, (DAY[0], "a"), (DAY[1], "a")), ledger)
    now = listing(spark, (DAY[0], "a"), (DAY[0], "late"), (DAY[1], "a"), (DAY[2], "new"))
    flags = flag_unread(now, read_hour_ledger(spark, ledger, ["2024/01/05"]))
    got = {(r.date_hour[-2:], r.clean_path[-4:]): r.processed for r in flags.collect()}
    assert got == {("00", "00/a"): True, ("00", "late"): False, ("01", "01/a"): True, ("02", "/new"): False}
    touched = with_unread_hours(flags)
    assert names(touched) == [DAY[0], DAY[0], DAY[2]]
    groups = sorted((r.date, r.hour, r.position, r.path[-4:]) for r in unread_by_hour(flags).collect())
    replace_hour_cells(touched, ledger)
    cells = {(r.date, r.hour, r.path) for r in read_hour_ledger(spark, ledger).collect()}
    assert cells == {("2024/01/05", r.date_hour[-2:], r.clean_path) for r in now.collect()}
    assert read_hour_ledger(spark, ledger, ["2024/01/06"]).count() == 0
    assert groups == [("2024/01/05", "00", 1, "late"), ("2024/01/05", "02", 1, "/new")]


@pytest.mark.parametrize("tasks", [1, 8])
def test_group_paths_numbers_every_path_in_order(spark, tasks):
    files = [(DAY[0], f"f{i:03d}") for i in range(300)] + [(DAY[1], "z"), (DAY[1], "y"), (DAY[1], "y")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        # many ranges: a group is numbered by several tasks
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false" if tasks > 1 else "true")
        got = sorted((r.date_hour, r.position, r.path) for r in group_paths(listing(spark, *files)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = []
    for hour in (DAY[0], DAY[1]):
        want += [(hour, i + 1, f"file:/r/{hour}/{n}") for i, n in enumerate(sorted(n for h, n in files if h == hour))]
    assert got == want


def test_hash_ledger_reads_only_the_days_asked_for(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    append_hashes(listing(spark, (DAY[0], "a"), (NEXT[0], "b")), ledger)
    one = read_hash_ledger(spark, ledger, [DAY[0][:10]])
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date" in plan and "Aggregate" not in plan


def test_watermark_file(spark, tmp_path):
    path = f"{tmp_path}/mark"
    write_watermark(spark, DAY[3], path)
    write_watermark(spark, DAY[4], path)
    assert read_watermark(spark, path) == DAY[4]
