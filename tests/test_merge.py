"""Merging the small files of closed hours."""

import glob
import json

import pytest
from conftest import packet, put_file

from eventloom.plans import merge
from eventloom.plans.ingest import backfill_run, hash_ledger_run, parked_rows, published_rows, register, replay
from eventloom.plans.merge import merge_small_files, published_files
from test_runs import HOURS, NOW, layout, published, want  # noqa: F401


def rows(spark, layout):
    return sorted((r.value, r.date_hour) for r in published_rows(spark, layout).collect())


@pytest.fixture
def many(spark, layout, hashed, types, tmp_path):
    """Three runs, so three files in two of the hours."""
    for n in range(3):
        if n:
            for hour in HOURS[1:3]:
                put_file(tmp_path / "raw", hour, f"late{n}", packet(user_id="u1", session_id=f"{hour} {n}"))
        hash_ledger_run(spark, layout, hashed, types, now=NOW, run=f"r{n}")
    return layout


def files(layout, hour):
    return glob.glob(f"{layout.published}/run=*/date={hour[:10].replace('/', '-')}/hour={hour[-2:]}/part-*")


def test_rows_stay_and_files_are_few(spark, many):
    before = rows(spark, many)
    assert [len(files(many, h)) for h in HOURS[1:4]] == [3, 3, 1]
    assert merge_small_files(spark, many, until=HOURS[1]) == 1
    assert [len(files(many, h)) for h in HOURS[1:4]] == [1, 3, 1]
    assert merge_small_files(spark, many, until=HOURS[7]) == 1
    assert [len(files(many, h)) for h in HOURS[1:4]] == [1, 1, 1]
    assert rows(spark, many) == before and spark.read.text(many.published).count() == len(before)
    assert merge_small_files(spark, many, until=HOURS[7]) == 0
    assert parked_rows(spark, many).count() == len(HOURS)  # these are not merged and still wait


def test_large_hours_keep_as_many_files_as_their_size_asks_for(spark, many):
    size = sum(r.length for r in published_files(spark, many).where(f"date_hour = '{HOURS[1]}'").collect())
    before = rows(spark, many)
    assert merge_small_files(spark, many, until=HOURS[7], target_bytes=size // 2 + 1) == 2
    assert 1 <= len(files(many, HOURS[1])) <= 2 and rows(spark, many) == before


def test_later_runs_and_replacements(spark, many, hashed, types, tmp_path):
    merge_small_files(spark, many, until=HOURS[7], run="m")
    put_file(tmp_path / "raw", HOURS[2], "later", packet(user_id="u2", session_id="later"))
    hash_ledger_run(spark, many, hashed, types, now=NOW, run="more")
    register(spark, many, spark.createDataFrame([("new", "g9")], "player_id string, goc_id string"), seq=2)
    replay(spark, many, hashed, "again")
    want_rows = rows(spark, many)
    assert sum(json.loads(v)["user_id"] == "g9" for v, _ in want_rows) == len(HOURS)
    merge_small_files(spark, many, until=HOURS[7])
    assert rows(spark, many) == want_rows
    backfill_run(spark, many, hashed, types, "2024/01/05", "2024/01/05", run="whole")
    assert rows(spark, many) == want_rows


def test_a_late_run_loses_nothing_to_a_merge(spark, many, hashed, types, tmp_path, monkeypatch):
    """It finishes after the merge has chosen its files and before the merge is finished."""
    real = merge.record_finished

    def record(*args, **more):
        put_file(tmp_path / "raw", HOURS[2], "meanwhile", packet(user_id="u2", session_id="meanwhile"))
        hash_ledger_run(spark, many, hashed, types, now=NOW, run="meanwhile")
        real(*args, **more)

    monkeypatch.setattr(merge, "record_finished", record)
    before = published(spark, many)
    merge_small_files(spark, many, until=HOURS[7])
    assert sorted(json.loads(v)["event_value"]["session_id"] for v, _ in rows(spark, many)).count("meanwhile") == 1
    assert published(spark, many) == sorted(before + [("meanwhile", "g2")])


def test_a_merge_that_stops_changes_nothing(spark, many, monkeypatch):
    before = rows(spark, many)
    with monkeypatch.context() as patch:
        patch.setattr(merge, "record_finished", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge_small_files(spark, many, until=HOURS[7], run="m")
    assert rows(spark, many) == before
    assert merge_small_files(spark, many, until=HOURS[7], run="m") == 2
    assert rows(spark, many) == before and len(files(many, HOURS[2])) == 1
