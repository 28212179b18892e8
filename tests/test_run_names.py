"""Names of runs and the table of finished ones: what counts, what is refused, and when."""

import json

import pytest
from conftest import packet, put_file
from pyspark.sql import functions as F

from eventloom.plans import ingest
from eventloom.plans.ingest import (
    backfill_run, hash_ledger_run, parked_rows, published_rows, register, replay, watermark_run,
)
from eventloom.sources import RunNameUsed, finished_runs, write_watermark
from eventloom.streaming import run_incremental
from test_runs import HOURS, NOW, layout, published, want  # noqa: F401


def counting(spark, layout):
    """(session, id, hour, run) of the rows a reader meets now."""
    rows = [(json.loads(r.value), r) for r in published_rows(spark, layout).collect()]
    return sorted((e["event_value"]["session_id"], e["user_id"], r.date_hour, r.run) for e, r in rows)


def ids_of(spark, player="new", goc_id="g9"):
    return spark.createDataFrame([(player, goc_id)], "player_id string, goc_id string")


def test_replay_under_a_used_name_is_refused(spark, layout, hashed, types):
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    replay(spark, layout, hashed, "zero")
    before, parked = counting(spark, layout), parked_rows(spark, layout).count()
    assert len(before) == 2 * len(HOURS) and parked == len(HOURS)
    for name in ("one", "zero"):
        with pytest.raises(RunNameUsed, match="exists already"):
            replay(spark, layout, hashed, name)
    assert counting(spark, layout) == before and parked_rows(spark, layout).count() == parked
    register(spark, layout, ids_of(spark), seq=2)
    replay(spark, layout, hashed, "two")
    assert published(spark, layout) == want(HOURS, ["g1", "g2", "g9"]) and parked_rows(spark, layout).count() == 0
    kinds = {r.run: r.kind for r in finished_runs(spark, layout.finished).collect()}
    assert kinds == {"one": "ledger", "zero": "replay", "two": "replay"}


def test_backfill_under_a_used_name_is_refused(spark, layout, hashed, types, tmp_path):
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    put_file(tmp_path / "raw", HOURS[2], "late", packet(user_id="u1", session_id="late"))
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="two")
    before = counting(spark, layout)
    for users in (spark.createDataFrame([("nobody",)], "user_id string"), None):
        with pytest.raises(RunNameUsed):
            backfill_run(spark, layout, hashed, types, "2024/01/05", "2024/01/05", users=users, run="two")
    assert counting(spark, layout) == before and ("late", "g1", HOURS[2], "two") in before


def test_names_of_slices_are_checked_before_anything_is_written(spark, layout, hashed, types):
    backfill_run(spark, layout, hashed, types, "2024/01/05", "2024/01/05", run="one-2",
                 users=spark.createDataFrame([("u2",)], "user_id string"))
    before = counting(spark, layout)
    with pytest.raises(RunNameUsed, match="one-2"):
        hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one", slice_files=3)
    assert counting(spark, layout) == before
    # the name itself was free and stays so for a run of its kind
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one") == ["one"]
    for bad in ("a/b", "a,b", "a=b", "", "ä"):
        with pytest.raises(ValueError):
            replay(spark, layout, hashed, bad)


def test_an_unfinished_run_keeps_its_name_for_its_kind(spark, layout, hashed, types, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "record_finished", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            backfill_run(spark, layout, hashed, types, "2024/01/05", "2024/01/05", run="again")
    assert counting(spark, layout) == []  # written, but not finished
    with pytest.raises(RunNameUsed, match="unfinished run of kind backfill"):
        replay(spark, layout, hashed, "again")
    backfill_run(spark, layout, hashed, types, "2024/01/05", "2024/01/05", run="again")
    assert published(spark, layout) == want(HOURS)
    assert {r[3] for r in counting(spark, layout)} == {"again"}


def test_no_reader_meets_a_row_twice(spark, layout, hashed, types, monkeypatch):
    """Reads at each step of a run that replaces the hours of another."""
    write_watermark(spark, HOURS[0], layout.watermark)
    watermark_run(spark, layout, hashed, types, now=NOW)
    first = counting(spark, layout)
    seen = {}
    real_record, real_drop = ingest.record_finished, ingest.drop_other_runs

    def record(*args, **more):
        seen["published, not finished"] = counting(spark, layout)
        real_record(*args, **more)

    def drop(*args):
        seen["finished, not dropped"] = counting(spark, layout)
        seen["text"] = spark.read.option("recursiveFileLookup", "true").text(layout.published).count()
        real_drop(*args)

    monkeypatch.setattr(ingest, "record_finished", record)
    monkeypatch.setattr(ingest, "drop_other_runs", drop)
    backfill_run(spark, layout, hashed, types, "2024/01/05", "2024/01/05", run="again")
    after = counting(spark, layout)
    assert seen["published, not finished"] == first and {r[3] for r in first} == {"after-2024010500"}
    assert seen["text"] == len(first) + len(after)  # both lie there
    assert seen["finished, not dropped"] == after and [r[:2] for r in after] == want(HOURS)
    assert {r.date_hour for r in parked_rows(spark, layout).collect()} == set(HOURS)
    assert parked_rows(spark, layout).count() == len(HOURS)  # those of the first run count no more


def test_a_watermark_run_that_finished_just_moves_the_mark(spark, layout, hashed, types, monkeypatch):
    write_watermark(spark, HOURS[0], layout.watermark)
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "write_watermark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            watermark_run(spark, layout, hashed, types, now=NOW)
    done = counting(spark, layout)
    assert [r[:2] for r in done] == want(HOURS[1:5])
    monkeypatch.setattr(ingest, "finish_run", lambda *a: 1 / 0)  # nothing is read again
    counts = watermark_run(spark, layout, hashed, types, now=NOW)
    assert sorted(r.date_hour for r in counts.collect()) == HOURS[1:5]
    assert counting(spark, layout) == done and spark.read.text(layout.watermark).first().value == HOURS[4]


def test_a_ledger_run_that_finished_just_enters_its_files(spark, layout, hashed, types, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "append_hashes", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    monkeypatch.setattr(ingest, "finish_run", lambda *a: 1 / 0)
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="two") == ["one"]
    assert [r[:2] for r in counting(spark, layout)] == want(HOURS)


def test_a_batch_of_a_stream_that_finished_is_not_done_again(spark, layout, hashed, types, tmp_path, monkeypatch):
    from eventloom.streaming import incremental

    check, real = str(tmp_path / "checkpoint"), incremental.record_finished

    def recorded_then_lost(*args, **more):
        real(*args, **more)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "record_finished", recorded_then_lost)
        with pytest.raises(Exception, match="driver lost"):
            run_incremental(spark, layout, hashed, types, check).awaitTermination()
    done = counting(spark, layout)
    assert [r[:2] for r in done] == want(HOURS)
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "finish_run", lambda *a: 1 / 0)
        run_incremental(spark, layout, hashed, types, check).awaitTermination()
    assert counting(spark, layout) == done


def test_hours_prune_by_folder(spark, layout, hashed, types):
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    rows = published_rows(spark, layout).where(F.col("date_hour") == HOURS[3])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 2 and "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan.split("FileScan text")[1].split("\n")[0]
