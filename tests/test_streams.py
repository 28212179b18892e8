"""Streams with state and with sinks of their own; what they report."""

import glob
import os
import time

import pytest
from conftest import packet, put_file

from eventloom.operators.identity import unresolved_keys
from eventloom.operators.counts import ALERT_SCHEMA
from eventloom.plans.ingest import hash_ledger_run, parked_rows
from eventloom.streaming import STATE_STORE, run_incremental, stream_hour_counts, stream_topic, stream_worklist, watch
from test_runs import HOURS, NOW, layout, published, want  # noqa: F401

HOUR = 3_600_000
START = 1704412800000  # 2024-01-05 00:00


def alerts(spark, layout, kind, wait=30):
    """Alert rows, which a listener writes a little after the query."""
    for _ in range(wait * 4):
        if glob.glob(f"{layout.alerts}/run=*/_SUCCESS"):
            found = spark.read.schema(ALERT_SCHEMA).parquet(layout.alerts).where(f"kind = '{kind}'").collect()
            if found:
                return found
        time.sleep(0.25)
    return []


def test_worklist_has_each_player_once_over_batches_and_restarts(spark, layout, hashed, types, tmp_path):
    path, check = str(tmp_path / "worklist"), str(tmp_path / "check")
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, STATE_STORE)
    try:
        stream_worklist(spark, layout, hashed, types, check, path, max_files=3).awaitTermination()
        assert [r.player_key for r in spark.read.parquet(path).collect()] == ["new"]
        put_file(tmp_path / "raw", HOURS[1], "late", packet(user_id="new") + "*##*" + packet(user_id=" newer ") + "*##*" + packet(user_id="u1"))
        stream_worklist(spark, layout, hashed, types, check, path, max_files=3).awaitTermination()
    finally:
        spark.conf.unset(provider)
    got = sorted(r.player_key for r in spark.read.parquet(path).collect())
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="batch")
    assert got == sorted(r.player_id for r in unresolved_keys(parked_rows(spark, layout)).collect()) == ["new", "newer"]


def test_an_hour_is_counted_once_it_is_closed(spark, layout, hashed, types, tmp_path):
    path, check, raw = str(tmp_path / "counts"), str(tmp_path / "check"), tmp_path / "other"
    other = type(layout)(str(raw), layout.base)

    def put(name, *times):
        put_file(raw, HOURS[0], name, "*##*".join(packet("spin", ts=START + t) for t in times))

    def run():
        stream_hour_counts(spark, other, hashed, types, check, path, delay="1 hour").awaitTermination()
        return sorted((r.date_hour, r.event_name, r.n) for r in spark.read.parquet(path).collect())

    put("a", 1, 2, HOUR + 1)
    assert run() == []
    put("b", 3, 2 * HOUR + 5)  # the first hour, open still; the watermark then passes its end
    assert run() == [(HOURS[0], "spin", 3)]
    put("c", 4, HOUR + 2, 4 * HOUR)  # one row too late
    assert run() == [(HOURS[0], "spin", 3), (HOURS[1], "spin", 2), (HOURS[2], "spin", 1)]
    late = alerts(spark, other, "late")
    assert [(a.stage, a.n) for a in late] == [("counts", 1)]


def test_a_batch_that_is_repeated_leaves_each_row_once(spark, layout, hashed, types, tmp_path):
    topic, check = str(tmp_path / "topic"), tmp_path / "check"

    def run():
        stream_topic(spark, layout, hashed, types, str(check), topic, sink="text", max_files=3).awaitTermination()
        return spark.read.text(topic).count()

    assert run() == 2 * len(HOURS)
    # stopped between the sink's commit and the query's: the last batch is done again
    last = max((check / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (check / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    written = sum(n.startswith("part-") for n in os.listdir(topic))
    assert run() == 2 * len(HOURS)
    assert sum(n.startswith("part-") for n in os.listdir(topic)) >= written
    put_file(tmp_path / "raw", HOURS[1], "late", packet(user_id="u1"))
    assert run() == 2 * len(HOURS) + 1


def test_a_query_that_dies_leaves_an_alert_row(spark, layout, hashed, types, tmp_path):
    def broken(rows, run):
        raise RuntimeError("the sink is gone")

    query = run_incremental(spark, layout, hashed, types, str(tmp_path / "check"), publish=broken)
    with pytest.raises(Exception, match="the sink is gone"):
        query.awaitTermination()
    found = alerts(spark, layout, "failed")
    assert [a.stage for a in found] == ["ingest"] and "the sink is gone" in found[0].samples[0]
    # the query of another layout is none of this one's business
    assert watch(spark, layout) is watch(spark, type(layout)(layout.raw, layout.base))


def test_a_source_that_fails_leaves_an_alert_row(spark, layout, hashed, types, tmp_path):
    check = tmp_path / "check"
    run_incremental(spark, layout, hashed, types, str(check)).awaitTermination()
    for offset in (check / "offsets").iterdir():
        offset.write_text("damaged") if not offset.name.startswith(".") else offset.unlink()
    with pytest.raises(Exception):
        run_incremental(spark, layout, hashed, types, str(check)).awaitTermination()
    assert len(alerts(spark, layout, "failed")) == 1
    assert published(spark, layout) == want(HOURS)


def test_live_counts_of_a_run(spark, layout, hashed, types, tmp_path):
    seen = []
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one", progress=lambda run, counts: seen.append((run, counts)))
    assert seen == [("one", {"published": 16, "unresolved": 8, "quarantine": 32, "hits": 1})]
    run_incremental(
        spark, layout, hashed, types, str(tmp_path / "check"), max_files=4, progress=lambda run, counts: seen.append(counts["published"])
    ).awaitTermination()
    assert sum(n for n in seen[1:]) == 16 and len(seen) == 3
