"""Whole runs over real directories: completeness, replay, crash and stream."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from conftest import packet, put_file
from pyspark.sql import functions as F

from eventloom import hashed_id_profile
from eventloom.session import discard
from eventloom.plans import ingest
from eventloom.plans.ingest import (
    RECORDS, Framing, Layout, UnresolvedIds, backfill_run, hash_ledger_run, hour_ledger_run, parked_rows,
    register, replay, seed_hash_ledger, text_sink, transform, watermark_run,
)
from eventloom.operators.backlog import LagAlert
from eventloom.operators.counts import (
    alert_rows, any_per_event_type, first_per_event_type, hour_counts, observe_routes,
    registration_hits, top_rows,
)
from eventloom.operators.identity import resolve_by_distinct_keys, unresolved_keys
from eventloom.operators.route import QUARANTINE
from eventloom.sinks import copy_text, publish_topic, write_by_hour
from eventloom.sources import merge_identity, packet_fields, parse_packets, read_identity, read_lines, write_watermark
from eventloom.streaming import run_incremental

HOURS = [f"2024/01/05/{h:02d}" for h in range(8)]
BAD = [
    packet(ts="ABSENT"), packet(user_id=""), "{broken}", packet("level_up", level="x"),
]


def lines_of(hour):
    """One hour: two known players, one unknown, four bad packets, one other event."""
    good = [
        packet("spin", user_id="u1", session_id=hour, level=1),
        packet("install", user_id="u2", session_id=hour),
        packet("spin", user_id="new", numeric_user_id=7, session_id=hour),
    ]
    return "*##*".join(good) + "\n" + "*##*".join(BAD + [packet("other")]) + "\n"


@pytest.fixture
def layout(spark, tmp_path):
    made = Layout(str(tmp_path / "raw"), str(tmp_path / "out"))
    for hour in HOURS:
        file = put_file(tmp_path / "raw", hour, "a", lines_of(hour))
        os.utime(file, (1704400000, 1704400000))
    ids = spark.createDataFrame(
        [("u1", "g1", "", 1), ("u2", "g2", "", 1)],
        "player_id string, goc_id string, numeric_id string, seq bigint",
    )
    merge_identity(ids, made.forward)
    return made


def published(spark, layout):
    try:
        rows = spark.read.option("recursiveFileLookup", "true").text(layout.published).collect()
    except Exception:
        return []
    return sorted((e["event_value"]["session_id"], e["user_id"]) for e in (json.loads(r.value) for r in rows))


def want(hours, ids=("g1", "g2")):
    return sorted((h, g) for h in hours for g in ids)


NOW = "2024-01-05 07:30:00"


def test_every_input_row_goes_exactly_one_way(spark, layout, hashed, types):
    parsed = parse_packets(read_lines(spark, layout.raw), packet_fields(hashed, types))
    routed = transform(
        parsed, hashed, types,
        spark.createDataFrame([("u1", "g1")], "player_id string, goc_id string"),
    )
    counts = {r.date_hour: r for r in hour_counts(routed).collect()}
    assert set(counts) == set(HOURS)
    for r in counts.values():
        assert (r.total, r.published, r.unresolved, r.quarantine) == (7, 1, 2, 4)
    alerts = alert_rows(routed, "ingest").collect()
    assert {(a.kind, a.n, len(a.samples)) for a in alerts} == {
        ("missing_key", 1, 1), ("no_user_id", 1, 1), ("corrupt", 1, 1), ("bad_value", 1, 1),
        ("unresolved", 2, 2),
    }
    hits = {(r.date_hour, r.hits) for r in registration_hits(routed.where("route = 'unresolved'")).collect()}
    assert hits == {(HOURS[0], 2)}
    reasons = {r.reason for r in routed.where(F.col("route") == QUARANTINE).collect()}
    assert reasons == {"missing_key", "no_user_id", "corrupt", "bad_value"}


KINDS = {
    "published": packet(user_id="u1"),
    "unresolved": packet("install", user_id="u9"),
    "no_user_id": packet(user_id="", numeric_user_id=4),
    "missing_key": packet(ts=None),
    "bad_value": packet("level_up", level=[1]),
    "corrupt": "{{}",
    None: packet("other"),
}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(list(KINDS)), max_size=6), max_size=6))
def test_no_packet_is_lost_or_doubled(spark, hashed, types, lines):
    text = [("*##*".join(KINDS[k] for k in line), "h") for line in lines]
    frame = spark.createDataFrame(text, "value string, date_hour string")
    ids = spark.createDataFrame([("u1", "g1"), ("u1", "g0")], "player_id string, goc_id string")
    routed = transform(parse_packets(frame, packet_fields(hashed, types)), hashed, types, ids)
    got = routed.groupBy(F.coalesce("reason", "route").alias("k")).count().collect()
    sent = [k for line in lines for k in line if k]
    assert {r.k: r["count"] for r in got} == {k: sent.count(k) for k in set(sent)}


def test_live_counts(spark):
    rows = spark.createDataFrame([("published",), ("published",), ("quarantine",)], "route string")
    same, seen = observe_routes(rows, "run")
    assert same.count() == 3
    assert seen.get == {"published": 2, "unresolved": 0, "quarantine": 1}


def test_alert_samples_are_cut_before_the_shuffle(spark):
    rows = spark.createDataFrame(
        [("h", "unresolved", None, i, None, f"e{i:02d}") for i in range(50)],
        "date_hour string, route string, reason string, ts bigint, packet string, envelope string",
    )
    alerts = alert_rows(rows, "s")
    row = alerts.first()
    assert row.n == 50 and row.samples == [f"e{i:02d}" for i in range(5)]
    assert "WindowGroupLimit" in alerts._jdf.queryExecution().executedPlan().toString()


def test_alert_samples_are_the_first_by_time(spark):
    """Against a plain ranking, over times that share minutes, span them or are missing."""
    rows = []
    for i in range(300):
        ts = None if i % 23 == 0 else 1704067200000 + (i * 7919) % 400_000 - 100_000 * (i % 4)
        kind = ("unresolved", None) if i % 3 else ("quarantine", "bad_value")
        rows.append((f"h{i % 7}", *kind, ts, f"p{i:03d}" if kind[1] else None, f"e{i:03d}"))
    rows.append(("h0", "published", None, 1, None, "never"))
    schema = "date_hour string, route string, reason string, ts bigint, packet string, envelope string"
    got = {(r.date_hour, r.kind): (r.n, r.samples) for r in alert_rows(spark.createDataFrame(rows, schema), "s").collect()}
    groups = {}
    for hour, route, reason, ts, text, envelope in rows:
        if route != "published":
            groups.setdefault((hour, reason or "unresolved"), []).append(
                (ts is not None, ts or 0, text or envelope)
            )
    assert got == {k: (len(v), [e for *_, e in sorted(v)[:5]]) for k, v in groups.items()}


def test_watermark_run(spark, layout, hashed, types):
    write_watermark(spark, HOURS[0], layout.watermark)
    counts = watermark_run(spark, layout, hashed, types, now=NOW)
    # hours 05 to 07 are held back
    assert sorted(r.date_hour for r in counts.collect()) == HOURS[1:5]
    assert published(spark, layout) == want(HOURS[1:5])
    assert spark.read.text(layout.watermark).first().value == HOURS[4]
    parked = spark.read.parquet(layout.unresolved)
    assert {r.player_key for r in parked.collect()} == {"new"} and parked.count() == 4
    assert spark.read.parquet(layout.quarantine).count() == 16
    alerts = spark.read.parquet(layout.alerts)
    assert alerts.where("kind = 'registration'").first().n == 1
    # hours 05 to 07 wait, all of them held back
    with pytest.raises(LagAlert):
        watermark_run(spark, layout, hashed, types, now=NOW)
    assert spark.read.parquet(layout.alerts).where("kind = 'lag'").count() == 1


def test_watermark_run_can_be_repeated(spark, layout, hashed, types, monkeypatch):
    write_watermark(spark, HOURS[0], layout.watermark)
    real = ingest.write_watermark
    monkeypatch.setattr(ingest, "write_watermark", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        watermark_run(spark, layout, hashed, types, now=NOW)
    failed = spark.read.parquet(layout.alerts).where("kind = 'failed'")
    assert "division" in failed.first().samples[0]
    monkeypatch.setattr(ingest, "write_watermark", real)
    watermark_run(spark, layout, hashed, types, now=NOW)
    assert published(spark, layout) == want(HOURS[1:5])
    assert spark.read.parquet(layout.unresolved).count() == 4


def test_stop_on_unresolved_publishes_nothing(spark, layout, types):
    strict = hashed_id_profile("g", on_unresolved="fail")
    write_watermark(spark, HOURS[0], layout.watermark)
    with pytest.raises(UnresolvedIds):
        watermark_run(spark, layout, strict, types, now=NOW)
    assert published(spark, layout) == []
    assert spark.read.parquet(layout.alerts).where("kind = 'unresolved'").count() == 4
    # the rows wait for ids; the run repeated under its name publishes all of them
    assigned = spark.createDataFrame([("new", "g9")], "player_id string, goc_id string")
    register(spark, layout, assigned, seq=2)
    watermark_run(spark, layout, strict, types, now=NOW)
    assert published(spark, layout) == want(HOURS[1:5], ["g1", "g2", "g9"])
    assert spark.read.parquet(layout.stopped).count() == 0
    replay(spark, layout, strict, "r")
    assert published(spark, layout) == want(HOURS[1:5], ["g1", "g2", "g9"])


def test_hash_ledger_run(spark, layout, hashed, types, tmp_path):
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one") == ["one"]
    assert published(spark, layout) == want(HOURS)
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="two") == []
    put_file(tmp_path / "raw", HOURS[2], "late", packet(user_id="u1", session_id="late"))
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="three") == ["three"]
    assert published(spark, layout) == sorted(want(HOURS) + [("late", "g1")])


def test_seeded_files_count_as_read(spark, layout, hashed, types):
    write_watermark(spark, HOURS[5], layout.watermark)
    seed_hash_ledger(spark, layout, horizon_hours=3)
    dealt = Framing(partitions=3)
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one", framing=dealt) == ["one"]
    assert published(spark, layout) == want(HOURS[:2] + HOURS[6:])


def test_hash_ledger_run_repeats_an_unfinished_run(spark, layout, hashed, types, tmp_path, monkeypatch):
    real = ingest.append_hashes
    monkeypatch.setattr(ingest, "append_hashes", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    monkeypatch.setattr(ingest, "append_hashes", real)
    put_file(tmp_path / "raw", HOURS[2], "late", packet(user_id="u1", session_id="late"))
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="two") == ["one", "two"]
    assert published(spark, layout) == sorted(want(HOURS) + [("late", "g1")])


def test_hour_ledger_run(spark, layout, hashed, types, tmp_path):
    assert hour_ledger_run(spark, layout, hashed, types, now=NOW, run="one") == ["one"]
    fresh = put_file(tmp_path / "raw", HOURS[2], "late", packet(user_id="u1", session_id="late"))
    stamp = 1704439800 - 359  # 07:30:00 less five minutes and 59 seconds
    os.utime(fresh, (stamp, stamp))
    assert hour_ledger_run(spark, layout, hashed, types, now=NOW, run="two") == []
    os.utime(fresh, (stamp - 1, stamp - 1))
    assert hour_ledger_run(spark, layout, hashed, types, now=NOW, run="three") == ["three"]
    assert published(spark, layout) == sorted(want(HOURS) + [("late", "g1")])
    cells = spark.read.parquet(layout.hour_ledger)
    assert cells.count() == 9 and cells.where("hour = 2").count() == 2


def test_partitioned_raw_root_and_record_framing(spark, layout, hashed, types, tmp_path):
    raw = tmp_path / "records"
    put_file(raw, "date=2024-01-05/hour=03", "a", packet(session_id="x\ny") + "**##**" + packet(user_id="u2", session_id="z"))
    other = Layout(str(raw), layout.base, partitioned=True)
    hash_ledger_run(spark, other, hashed, types, now=NOW, run="r", framing=RECORDS)
    assert published(spark, layout) == [("x\ny", "g1"), ("z", "g2")]


def test_runs_agree_whichever_way_ids_are_resolved(spark, layout, hashed, types):
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="r", resolve=resolve_by_distinct_keys)
    assert published(spark, layout) == want(HOURS)


def test_staging_tables_are_dropped(spark, layout, types):
    scratch = spark.conf.get("spark.checkpoint.dir") + "/eventloom"
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    for policy in ("continue", "fail"):
        profile = hashed_id_profile("g", on_unresolved=policy)
        other = Layout(layout.raw, f"{layout.base}-{policy}")
        try:
            hash_ledger_run(spark, other, profile, types, now=NOW, run="r")
        except UnresolvedIds:
            pass
    assert set(os.listdir(scratch)) == before
    with pytest.raises(ValueError):
        discard(spark, layout.raw)


def test_backfill_for_a_user_list(spark, layout, hashed, types):
    users = spark.createDataFrame([("u2",), ("new",)], "user_id string")
    counts = backfill_run(
        spark, layout, hashed, types, "2024/01/05", "2024/01/05", watermark="/05", users=users, run="fix"
    )
    assert {(r.date_hour, r.published, r.unresolved) for r in counts.collect()} == {(h, 1, 1) for h in HOURS[6:]}
    assert published(spark, layout) == want(HOURS[6:], ["g2"])


def test_register_and_replay(spark, layout, hashed, types):
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    worklist = unresolved_keys(spark.read.parquet(layout.unresolved))
    assert [(r.player_id, r.numeric_id, r.events) for r in worklist.collect()] == [("new", "7", 8)]
    replay(spark, layout, hashed, "r1")
    assert published(spark, layout) == want(HOURS)
    assigned = spark.createDataFrame([("new", "g9")], "player_id string, goc_id string")
    register(spark, layout, assigned, seq=2)
    counts = replay(spark, layout, hashed, "r2")
    assert sum(r.published for r in counts.collect()) == 8
    assert published(spark, layout) == want(HOURS, ["g1", "g2", "g9"])
    replay(spark, layout, hashed, "r3")
    assert published(spark, layout) == want(HOURS, ["g1", "g2", "g9"])
    numeric = read_identity(spark, layout.numeric, "numeric").first()
    assert (numeric.numeric_id, numeric.hashed_id, numeric.goc_id) == ("7", "new", "g9")


def test_stream_equals_batch_and_reads_late_files_once(spark, layout, hashed, types, tmp_path):
    check = str(tmp_path / "checkpoint")
    run_incremental(spark, layout, hashed, types, check, max_files=3).awaitTermination()
    assert published(spark, layout) == want(HOURS)
    put_file(tmp_path / "raw", HOURS[2], "late", packet(user_id="u1", session_id="late"))
    run_incremental(spark, layout, hashed, types, check, max_files=3).awaitTermination()
    assert published(spark, layout) == sorted(want(HOURS) + [("late", "g1")])
    counts = spark.read.parquet(layout.counts)
    assert counts.agg(F.sum("total")).first()[0] == 7 * len(HOURS) + 1
    assert len({r.run.rsplit("-", 1)[0] for r in counts.select("run").distinct().collect()}) == 1


def test_stream_ignores_files_older_than_its_horizon(spark, layout, hashed, types, tmp_path):
    check = str(tmp_path / "checkpoint")
    run_incremental(spark, layout, hashed, types, check, max_age="1h").awaitTermination()
    assert published(spark, layout) == want(HOURS)
    for name, age in (("too-late", 7200), ("in-time", 1800)):
        late = put_file(tmp_path / "raw", HOURS[2], name, packet(user_id="u1", session_id=name))
        os.utime(late, (1704400000 - age, 1704400000 - age))
    run_incremental(spark, layout, hashed, types, check, max_age="1h").awaitTermination()
    assert published(spark, layout) == sorted(want(HOURS) + [("in-time", "g1")])


def test_publish_by_hour_replaces_only_its_hours(spark, tmp_path):
    schema = "date_hour string, envelope string"
    out = str(tmp_path / "p")
    write_by_hour(spark.createDataFrame([(HOURS[0], "a"), (HOURS[1], "b")], schema), out)
    write_by_hour(spark.createDataFrame([(HOURS[1], "c")], schema), out)
    rows = spark.read.text(out)
    assert {(r.hour, r.value) for r in rows.collect()} == {(0, "a"), (1, "c")}
    write_by_hour(spark.createDataFrame([(HOURS[2], "d")], schema), out, "error")
    with pytest.raises(FileExistsError, match=HOURS[1]):
        write_by_hour(spark.createDataFrame([(HOURS[1], "e"), (HOURS[3], "f")], schema), out, "error")
    assert spark.read.text(out).count() == 3
    write_by_hour(spark.createDataFrame([(HOURS[4], "g")], schema), f"{out}-new", "error", gather=False)
    assert spark.read.text(f"{out}-new").first().value == "g"


def test_publish_topic_and_copy(spark, tmp_path):
    rows = spark.createDataFrame([("g", "a"), ("g", "b")], "goc_id string, envelope string")
    publish_topic(rows, str(tmp_path / "topic"), sink="text")
    copy_text(spark, str(tmp_path / "topic"), str(tmp_path / "copy"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "copy")).collect()) == ["a", "b"]


def test_first_per_event_type(spark):
    rows = [("a", 5, "2", None), ("a", 5, "1", "x"), ("a", 6, "0", "y"), ("b", None, "9", "z"), ("b", None, "8", "w")]
    df = spark.createDataFrame(rows, "event_type string, ts bigint, event_id string, v string")
    got = {tuple(r) for r in first_per_event_type(df).collect()}
    assert got == {("a", 5, "1", "x"), ("b", None, "8", "w")}
    some = {tuple(r) for r in any_per_event_type(df).collect()}
    assert {r[0] for r in some} == {"a", "b"} and some <= set(rows)
    assert [r.v for r in top_rows(df, 2, F.col("event_id").desc()).collect()] == ["z", "w"]


def test_strict_ledger_run_can_be_registered_and_repeated(spark, layout, types):
    strict = hashed_id_profile("g", on_unresolved="fail")
    with pytest.raises(UnresolvedIds):
        hash_ledger_run(spark, layout, strict, types, now=NOW, run="one")
    with pytest.raises(UnresolvedIds):
        hash_ledger_run(spark, layout, strict, types, now=NOW, run="two")
    worklist = unresolved_keys(parked_rows(spark, layout))
    assert [(r.player_id, r.events) for r in worklist.collect()] == [("new", 8)]
    register(spark, layout, spark.createDataFrame([("new", "g9")], "player_id string, goc_id string"), seq=2)
    assert hash_ledger_run(spark, layout, strict, types, now=NOW, run="three") == ["one"]
    assert published(spark, layout) == want(HOURS, ["g1", "g2", "g9"])
    assert parked_rows(spark, layout).count() == 0


EXTREME = [
    packet(ts=99999999999999999), packet(ts=-99999999999999999), packet(ts=9223372036854775807), packet(ts="NaN"),
    packet("transaction", price="NaN"), packet("transaction", price="Infinity"), packet("transaction", price="1d"),
    packet("transaction", price={"a": 1}), packet("transaction", price=[1]), packet("transaction", price="1e999"),
    packet("start_session", blackdiamond_elite_active={"a": 1}), packet("start_session", blackdiamond_elite_active=[1]),
    packet("spin", slot_id={"x": 1}), packet("spin", slot_id=["x"]), packet("level_up", level={"a": 1}),
    packet("level_up", level="99999999999999999999999999999999999999999999"),
]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(EXTREME), min_size=1, max_size=8))
def test_no_packet_fails_a_run(spark, hashed, types, packets):
    frame = spark.createDataFrame([("*##*".join([*packets, packet(user_id="u1")]), "h")], "value string, date_hour string")
    ids = spark.createDataFrame([("u1", "g1")], "player_id string, goc_id string")
    rows = transform(parse_packets(frame, packet_fields(hashed, types)), hashed, types, ids).collect()
    assert sorted(r.route for r in rows) == ["published"] + ["quarantine"] * len(packets)
    assert {r.reason for r in rows} <= {None, "missing_key", "bad_value"}


def test_texts_that_look_nested_pass(spark, hashed, types):
    frame = spark.createDataFrame([(packet("spin", slot_id='{"x": 1}', session_id="[guest]"), "h")], "value string, date_hour string")
    ids = spark.createDataFrame([("u1", "g1")], "player_id string, goc_id string")
    row = transform(parse_packets(frame, packet_fields(hashed, types)), hashed, types, ids).first()
    value = json.loads(row.event_value)
    assert (value["slot_id"], value["session_id"]) == ('{"x": 1}', "[guest]")


def test_a_run_name_cannot_be_used_again(spark, layout, hashed, types, tmp_path):
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    put_file(tmp_path / "raw", HOURS[2], "late", packet(user_id="u1", session_id="late"))
    with pytest.raises(ValueError, match="exists"):
        hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    assert published(spark, layout) == want(HOURS)
    assert ingest.run_stamp() != ingest.run_stamp()
    assert len(hash_ledger_run(spark, layout, hashed, types, now=NOW)) == 1
    assert published(spark, layout) == sorted(want(HOURS) + [("late", "g1")])
    failed = spark.read.parquet(layout.alerts).where("kind = 'failed'")
    assert failed.count() == 1


def test_full_backfill_replaces_hours_and_what_was_parked(spark, layout, hashed, types):
    write_watermark(spark, HOURS[0], layout.watermark)
    watermark_run(spark, layout, hashed, types, now=NOW)
    backfill_run(spark, layout, hashed, types, "2024/01/05", "2024/01/05", run="again")
    assert published(spark, layout) == want(HOURS)
    assert spark.read.text(layout.published).count() == 2 * len(HOURS)  # one layout
    register(spark, layout, spark.createDataFrame([("new", "g9")], "player_id string, goc_id string"), seq=2)
    replay(spark, layout, hashed, "r1")
    assert published(spark, layout) == want(HOURS, ["g1", "g2", "g9"])
    backfill_run(spark, layout, hashed, types, "2024/01/05", "2024/01/05", run="more")
    assert published(spark, layout) == want(HOURS, ["g1", "g2", "g9"])


def test_padded_ids_in_a_user_list(spark, layout, hashed, types, tmp_path):
    put_file(tmp_path / "raw", HOURS[0], "padded", packet(user_id=" u1 ", session_id="pad"))
    users = spark.createDataFrame([("u1 ",), ("",)], "user_id string")
    backfill_run(spark, layout, hashed, types, "2024/01/05", "2024/01/05", users=users, run="fix")
    assert published(spark, layout) == sorted(want(HOURS, ["g1"]) + [("pad", "g1")])


def test_backlog_in_slices(spark, layout, hashed, types, monkeypatch):
    names = hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one", slice_files=3)
    assert names == ["one", "one-2", "one-3"]
    assert published(spark, layout) == want(HOURS)
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="two") == []


def test_unfinished_slices_are_all_repeated(spark, layout, hashed, types, monkeypatch):
    real = ingest.append_hashes
    monkeypatch.setattr(ingest, "append_hashes", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one", slice_files=4)
    monkeypatch.setattr(ingest, "append_hashes", real)
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="two") == ["one", "one-2"]
    assert published(spark, layout) == want(HOURS)


def test_hash_ledger_leaves_unsettled_files(spark, layout, hashed, types, tmp_path):
    fresh = put_file(tmp_path / "raw", HOURS[2], "late", packet(user_id="u1", session_id="late"))
    os.utime(fresh, (1704439800 - 60, 1704439800 - 60))
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one", settle_minutes=5)
    assert published(spark, layout) == want(HOURS)
    os.utime(fresh, (1704400000, 1704400000))
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="two", settle_minutes=5) == ["two"]


def test_several_sinks(spark, layout, hashed, types, tmp_path):
    topic = str(tmp_path / "topic")
    sinks = [lambda rows, run: publish_topic(rows, topic, sink="text"), text_sink(layout, gather=False)]
    hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one", publish=sinks)
    assert published(spark, layout) == want(HOURS)
    assert spark.read.text(topic).count() == 2 * len(HOURS)


def test_early_allowlist_in_a_run(spark, layout, hashed, types, tmp_path):
    raw = tmp_path / "records"
    put_file(raw, HOURS[3], "a", "\n".join([packet(session_id="x"), packet("other"), "{broken"]))
    other = Layout(str(raw), layout.base)
    hash_ledger_run(spark, other, hashed, types, now=NOW, run="r", framing=Framing(separator=None, early=True))
    assert published(spark, layout) == [("x", "g1")]
    with pytest.raises(ValueError):
        Framing(early=True)


def test_failures_while_planning_leave_an_alert(spark, layout, hashed, types, monkeypatch):
    monkeypatch.setattr(ingest, "unseen", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one")
    assert spark.read.parquet(layout.alerts).where("kind = 'failed'").count() == 1
