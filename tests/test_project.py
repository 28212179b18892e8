import json

import pytest
from conftest import packet
from pyspark.sql import functions as F

from eventloom import numeric_id_profile, paired_id_profile
from eventloom.operators.project import interpret
from eventloom.plans.ingest import transform
from eventloom.sources import CatalogError, packet_fields, parse_packets


def interpreted(spark, profile, types, *packets):
    lines = spark.createDataFrame([("*##*".join(packets), "2024/01/01/00")], "value string, date_hour string")
    return interpret(parse_packets(lines, packet_fields(profile, types)), profile, types)


def one(spark, profile, types, text):
    return interpreted(spark, profile, types, text).first()


def test_typed_projection_keeps_order_and_nulls(spark, hashed, types):
    row = one(
        spark, hashed, types,
        packet("spin", bet_amount=5, session_id=None, level="7", slot_id=3, extra=1, numeric_user_id=42),
    )
    value = json.loads(row.event_value)
    assert list(value.items()) == [
        ("bet_amount", 5), ("event_id", None), ("session_id", None), ("platform_id", None),
        ("level", 7), ("slot_id", "3"), ("epoch_time", 1704067200123),
        ("event_time", "2024-01-01 00:00:00"), ("user_id_hashed", "u1"), ("user_id_numeric", "42"),
    ]
    assert row.reason is None and row.packet is None


def test_every_event_type_has_its_columns(spark, hashed, types):
    rows = interpreted(spark, hashed, types, *[packet(e) for e in hashed.event_names]).collect()
    assert len(rows) == len(hashed.event_names)
    for row in rows:
        keys = list(json.loads(row.event_value))
        assert keys[: -4] == list(hashed.event_columns[row.event_name])


@pytest.mark.parametrize(
    "sent, want",
    [("5", 5), (5, 5), (5.9, 5), ("1e3", 1000), (None, None), ("ABSENT", None), (-3, -3)],
)
def test_long(spark, hashed, types, sent, want):
    row = one(spark, hashed, types, packet("level_up", level=sent))
    assert json.loads(row.event_value)["level"] == want


@pytest.mark.parametrize("sent, want", [(True, True), ("TRUE", True), ("yes", False), (False, False), (1, False)])
def test_boolean(spark, hashed, types, sent, want):
    row = one(spark, hashed, types, packet("start_session", blackdiamond_elite_active=sent))
    assert json.loads(row.event_value)["blackdiamond_elite_active"] is want


@pytest.mark.parametrize("sent, want", [(1, 1.0), (2.5, 2.5), ("0.1", 0.1)])
def test_double(spark, hashed, types, sent, want):
    row = one(spark, hashed, types, packet("transaction", price=sent))
    assert json.loads(row.event_value)["price"] == want


@pytest.mark.parametrize("sent", [{"a": 1, "b": {"c": None}}, [1, "x", {"y": 2}], {}, []])
def test_array_passes_objects_and_arrays(spark, numeric, types, sent):
    row = one(spark, numeric, types, packet("start_session", spins_per_spinner=sent))
    assert json.loads(row.event_value)["spins_per_spinner"] == sent


@pytest.mark.parametrize(
    "text, reason",
    [
        (packet(ts="ABSENT"), "missing_key"),
        (packet(ts="soon"), "missing_key"),
        (packet(user_id="ABSENT"), "missing_key"),
        (packet(user_id=None), "missing_key"),
        (packet(user_id="ABSENT", numeric_user_id=5), "no_user_id"),
        (packet(user_id=""), "no_user_id"),
        (packet(user_id="  "), "no_user_id"),
        (packet("level_up", level="many"), "bad_value"),
        (packet("level_up", price="many"), None),
        ("{not json}", "corrupt"),
        (packet(), None),
    ],
)
def test_reasons(spark, hashed, types, text, reason):
    row = one(spark, hashed, types, text)
    assert row.reason == reason
    assert (row.packet is None) == (reason is None)
    assert (row.event_value is None) == (reason is not None)


def test_scalar_for_array_tag_is_bad(spark, numeric, types):
    for sent in ("text", 5, True, '{"a":1}'):
        row = one(spark, numeric, types, packet("start_session", spins_per_spinner=sent))
        assert row.reason == "bad_value", sent


def test_id_fields_per_profile(spark, types):
    text = packet("install", user_id=" u9 ", numeric_user_id=" 77 ")
    row = one(spark, numeric_id_profile("g"), types, text)
    assert json.loads(row.event_value)["user_id_numeric"] == " u9 " and row.player_key == "u9"
    row = one(spark, paired_id_profile("g"), types, text)
    value = json.loads(row.event_value)
    assert (value["user_id_hashed"], value["user_id_ref"]) == (" u9 ", " 77 ")
    assert row.player_key == "77"
    row = one(spark, paired_id_profile("g"), types, packet("install", user_id="u9"))
    assert row.reason == "missing_key"


def test_catalog_is_checked_before_any_job(spark, hashed, types):
    lines = spark.createDataFrame([("x",)], "value string")
    parsed = parse_packets(lines, packet_fields(hashed, types))
    with pytest.raises(CatalogError):
        interpret(parsed, hashed, {**types, "level": "decimal"})


def test_envelope(spark, hashed, types):
    lines = spark.createDataFrame(
        [(packet("install", session_id='q"é\\', user_id=" u1 "), "h")], "value string, date_hour string"
    )
    identity = spark.createDataFrame([("u1 ", 'g"1', "", 1)], "player_id string, goc_id string, numeric_id string, seq bigint")
    parsed = parse_packets(lines, packet_fields(hashed, types))
    row = transform(parsed, hashed, types, identity).first()
    envelope = json.loads(row.envelope)
    assert list(envelope) == ["game_id", "event_time", "event_name", "user_id", "event_value"]
    assert envelope["user_id"] == row.goc_id == 'g"1'
    assert envelope["game_id"] == "hashed game" and envelope["event_name"] == "install"
    assert envelope["event_value"] == json.loads(row.event_value)
    assert envelope["event_value"]["session_id"] == 'q"é\\'


def test_times(spark):
    from eventloom.functions import epoch_to_pacific, epoch_to_text, in_zone
    from eventloom.functions import times as t

    row = spark.createDataFrame([(1710064799999,)], "ms bigint").select(
        epoch_to_text("ms").alias("utc"),
        epoch_to_pacific("ms").alias("pacific"),
        epoch_to_text("ms", t.SECOND, t.INDIA_ZONE).alias("india"),
        epoch_to_text("ms", t.HOUR_PATH).alias("hour"),
        epoch_to_text("ms", t.FILE_STAMP).alias("stamp"),
        epoch_to_text("ms", t.RUN_STAMP).alias("run"),
        F.date_format(in_zone(F.timestamp_millis("ms"), t.PACIFIC_ZONE), t.MINUTE).alias("minute"),
        epoch_to_text("ms", t.COMPACT_DAY).alias("compact"),
    ).first()
    assert row.utc == "2024-03-10 09:59:59"
    assert row.pacific == "2024-03-10 01:59:59"
    assert row.india == "2024-03-10 15:29:59"
    assert (row.hour, row.stamp) == ("2024/03/10/09", "2024-03-10_09-59-59")
    assert (row.run, row.minute, row.compact) == ("20240310095959", "2024-03-10 01:59", "20240310")


def test_sequences(spark):
    from eventloom.functions import day_sequence, hour_sequence

    hours = [r.date_hour for r in hour_sequence(spark, "2024/02/28/22", "2024/02/29/01").collect()]
    assert hours == ["2024/02/28/22", "2024/02/28/23", "2024/02/29/00", "2024/02/29/01"]
    assert hour_sequence(spark, "2024/01/02/00", "2024/01/01/00").count() == 0
    days = [r.date for r in day_sequence(spark, "2024/02/28", "2024/03/01").collect()]
    assert days == ["2024/02/28", "2024/02/29", "2024/03/01"]


def test_path_strings(spark):
    from eventloom.functions import paths as p

    path = "hdfs://host:8020/raw/prod/2024/01/05/13/part-1"
    row = spark.createDataFrame([(path,)], "p string").select(
        p.date_hour_after_prod("p").alias("hour"), p.clean_path("p").alias("clean"),
        p.path_after("p").alias("after"), p.path_after("p", "prod/", 13).alias("cut"),
        p.file_hash("p").alias("md5"),
        p.path_tail(F.lit("/raw/prod/2024/01/05/13")).alias("tail"),
        p.day_of(F.lit("2024/01/05/13")).alias("day"), p.hour_of(F.lit("2024/01/05/13")).alias("hh"),
        p.date_hour_after_prod(F.lit("/raw/2024/01/05/13/x")).alias("none"),
        p.clean_path(F.lit("/plain/path")).alias("plain"), p.clean_path(F.lit("file:/a/b")).alias("file"),
    ).first()
    import hashlib

    assert row.hour == row.cut == row.tail == "2024/01/05/13"
    assert row.clean == "/raw/prod/2024/01/05/13/part-1"
    assert row.after == "2024/01/05/13/part-1" and row.md5 == hashlib.md5(path.encode()).hexdigest()
    assert (row.day, row.hh, row.none) == ("2024/01/05", "13", "")
    assert (row.plain, row.file) == ("/plain/path", "/a/b")
