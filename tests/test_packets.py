import json

import pytest
from conftest import packet, put_file
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.functions.text import brace_slice, event_type_of, packets_of
from eventloom.operators.route import allow_events, allow_users, early_allowlist
from eventloom.sources import (
    CatalogError, check_catalog, load_catalog, packet_fields, parse_packets, read_catalog,
    read_json_events, read_lines, read_records,
)


def frame(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_unframe_slices_braces_and_drops_empty(spark):
    line = 'x{"a":1}y*##*none*##**##*{"b":{"c":2}}z*##*'
    got = frame(spark, line).select(F.explode(packets_of("value")).alias("p")).collect()
    assert [r.p for r in got] == ['{"a":1}', '{"b":{"c":2}}']


@pytest.mark.parametrize(
    "text, want",
    [("ab", ""), ("{a", ""), ("}{", ""), ("a{b}c}d", "{b}c}"), ("{\n}", "{\n}"), ("", "")],
)
def test_brace_slice(spark, text, want):
    assert frame(spark, text).select(brace_slice("value")).first()[0] == want


PACKETS = st.lists(
    st.dictionaries(
        st.sampled_from(["a", "b", "c"]),
        st.one_of(st.integers(-5, 5), st.text("xyz*# é", max_size=4), st.none()),
        min_size=1,
    ),
    max_size=5,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(PACKETS)
def test_unframe_undoes_framing(spark, packets):
    texts = [json.dumps(p) for p in packets]
    texts = [t for t in texts if "*##*" not in t]
    got = frame(spark, "*##*".join(texts)).select(packets_of("value")).first()[0]
    assert got == texts


def test_lines_and_hour_from_both_layouts(spark, tmp_path):
    put_file(tmp_path, "2024/01/05/13", "a", packet() + "*##*" + packet())
    put_file(tmp_path, "date=2024-01-05/hour=14", "b", packet())
    rows = read_lines(spark, str(tmp_path)).collect()
    assert sorted(r.date_hour for r in rows) == ["2024/01/05/13", "2024/01/05/14"]
    globbed = read_lines(spark, f"{tmp_path}/2024/01/05/*/*")
    assert globbed.count() == 1


def test_explicit_file_list(spark, tmp_path):
    a = put_file(tmp_path, "2024/01/05/13", "a", "one\n")
    put_file(tmp_path, "2024/01/05/13", "b", "two\n")
    c = put_file(tmp_path, "2024/01/05/14", "c", "three\n")
    rows = read_lines(spark, [str(a), str(c)]).collect()
    assert sorted(r.value for r in rows) == ["one", "three"]


def test_records_keep_newlines(spark, tmp_path):
    put_file(tmp_path, "2024/01/05/13", "a", '{"a":\n1}**##**{"b":2}')
    rows = read_records(spark, str(tmp_path)).collect()
    assert sorted(r.value for r in rows) == ['{"a":\n1}', '{"b":2}']


def test_parse_keeps_corrupt_and_reads_each_field_as_text(spark, hashed, types):
    lines = frame(spark, packet(level=3, slot_id=9) + '*##*{"event_type": "spin",}*##*{"cut off*##*nothing')
    rows = parse_packets(lines, packet_fields(hashed, types)).orderBy("packet").collect()
    assert len(rows) == 2
    good = next(r for r in rows if r.corrupt is None)
    bad = next(r for r in rows if r.corrupt is not None)
    assert (good.event_type, good.level, good.slot_id) == ("spin", "3", "9")
    assert bad.event_type is None and bad.corrupt == bad.packet == '{"event_type": "spin",}'


def test_all_packets_bad_gives_no_events(spark, hashed, types):
    parsed = parse_packets(frame(spark, "{x}", "{y}"), packet_fields(hashed, types))
    assert allow_events(parsed, hashed.event_names).count() == 0
    assert allow_events(parsed, hashed.event_names, keep_corrupt=True).count() == 2


def test_packets_are_parsed_once(spark, hashed, types):
    parsed = parse_packets(frame(spark, packet()), packet_fields(hashed, types))
    plan = allow_events(parsed, ["spin"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_json_lines_match_packet_parse(spark, hashed, types, tmp_path):
    texts = [packet(level=3), packet("install", user_id=None), packet("other"), "{broken"]
    put_file(tmp_path, "2024/01/05/13", "a", "\n".join(texts))
    fields = packet_fields(hashed, types)
    read = read_json_events(spark, str(tmp_path), fields)
    assert read.columns == parse_packets(
        read_lines(spark, str(tmp_path)), fields
    ).select("date_hour", "packet", *fields, "corrupt").columns
    assert allow_events(read, hashed.event_names).count() == 2
    assert [r.packet for r in read.collect() if r.corrupt is not None] == ["{broken"]
    put_file(tmp_path, "2024/01/05/14", "b", '{"event_type": "spin", "undeclared": 7}')
    kept = [r.packet for r in read_json_events(spark, str(tmp_path), fields).collect()]
    assert '{"event_type": "spin", "undeclared": 7}' in kept
    inferred = read_json_events(spark, str(tmp_path))
    assert inferred.where("event_type = 'spin' and level is not null").first().level == 3


def test_allowlist_is_case_sensitive_and_drops_nulls(spark, hashed, types):
    lines = frame(spark, packet("spin"), packet("Spin"), packet("other"), '{"ts": 1}')
    parsed = parse_packets(lines, packet_fields(hashed, types))
    assert [r.event_type for r in allow_events(parsed, ["spin"]).collect()] == ["spin"]
    early = early_allowlist(lines, ["spin"]).collect()
    assert [r.event_type for r in early] == ["spin"]


def test_json_path_extract(spark):
    assert frame(spark, packet("spin")).select(event_type_of("value")).first()[0] == "spin"
    assert frame(spark, "{broken").select(event_type_of("value")).first()[0] is None


def test_user_allowlist(spark):
    events = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "user_id string, n int")
    users = spark.createDataFrame([("a",), ("a",), ("c",)], "user_id string")
    assert sorted(r.n for r in allow_users(events, users).collect()) == [1, 3]


def test_catalog(spark, tmp_path, hashed):
    text = "\n".join(
        [f" {c} : string " for c in hashed.attribute_columns if c != "level"]
        + ["", "level:long:ignored", "unused:weird"]
    )
    path = tmp_path / "schema.txt"
    path.write_text(text)
    rows = {r.column_name: r.column_type for r in read_catalog(spark, str(path)).collect()}
    assert rows["level"] == "long" and rows["unused"] == "weird"
    types = load_catalog(spark, str(path), hashed.event_columns)
    assert types["level"] == "long" and "unused" not in types


def test_catalog_errors(hashed, types):
    check_catalog(types, hashed.event_columns)
    with pytest.raises(CatalogError, match="spin.level"):
        check_catalog({k: v for k, v in types.items() if k != "level"}, hashed.event_columns)
    with pytest.raises(CatalogError, match="level:decimal"):
        check_catalog({**types, "level": "decimal"}, hashed.event_columns)
