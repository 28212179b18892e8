import pytest
from pyspark.sql import functions as F

from eventloom.operators.identity import (
    forward_entries, latest_per_key, numeric_entries, resolve_by_distinct_keys, resolve_ids,
    reverse_entries, unresolved_keys, upsert,
)
from eventloom.sources import merge_identity, read_identity

FORWARD = "player_id string, goc_id string, numeric_id string, seq bigint"
EVENTS = "player_key string, ts bigint, event_value string, reason string, packet string"


def events(spark):
    rows = [(f"u{i % 5}", i, f"v{i}", None, None) for i in range(40)]
    rows += [("hot", i, f"h{i}", None, None) for i in range(60)]
    rows += [("hot", 1, "copy", None, None)] * 20
    rows += [("", 1, None, "corrupt", "{x}")] * 10
    return spark.createDataFrame(rows, EVENTS)


def identity(spark):
    return spark.createDataFrame(
        [
            ("u0", "old", "", 1), (" u0", "g0", "", 2), ("u1", "g1", "", 1), ("u2", "", "", 9),
            ("hot", "ghot", "", 1), ("other", "gx", "", 1), ("", "gblank", "", 1), (None, "gnull", "", 1),
        ],
        FORWARD,
    )


def found(df):
    rows = df.groupBy("player_key", "goc_id").count().collect()
    return {(r.player_key, r.goc_id): r["count"] for r in rows}


WANT = {
    ("u0", "g0"): 8, ("u1", "g1"): 8, ("u2", ""): 8, ("u3", ""): 8, ("u4", ""): 8,
    ("hot", "ghot"): 80, ("", ""): 10,
}


def test_resolve(spark):
    got = resolve_ids(events(spark), identity(spark))
    assert found(got) == WANT
    assert got.columns == EVENTS.replace(" string", "").replace(" bigint", "").split(", ") + ["goc_id"]


def test_merged_identity_tables(spark, tmp_path):
    table = str(tmp_path / "forward")
    assert read_identity(spark, table).count() == 0
    merge_identity(identity(spark), table)
    rows = {r.player_id: (r.goc_id, r.seq) for r in read_identity(spark, table).collect()}
    assert rows == {"u0": ("g0", 2), "u1": ("g1", 1), "u2": ("", 9), "hot": ("ghot", 1), "other": ("gx", 1)}
    more = spark.createDataFrame([("u1 ", "n1", None, 1), ("u0", "late", "", 1), ("u9", "g9", "", 1)], FORWARD)
    for _ in range(3):
        merge_identity(more, table)
    rows = {r.player_id: (r.goc_id, r.seq) for r in read_identity(spark, table).collect()}
    assert rows["u1"] == ("n1", 1) and rows["u0"] == ("g0", 2) and rows["u9"] == ("g9", 1) and len(rows) == 6
    found_ = resolve_ids(events(spark), read_identity(spark, table), unique=True)
    assert found(found_) == {**{k: v for k, v in WANT.items() if k != ("u1", "g1")}, ("u1", "n1"): 8}
    plan = found_._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


def test_hot_unknown_players_are_spread(spark):
    rows = spark.createDataFrame([("ghost", i, f"v{i}", None, None) for i in range(400)], EVENTS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = resolve_by_distinct_keys(rows, identity(spark), max_hot_keys=8)
        assert found(got) == {("ghost", ""): 400}
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 2 and max(sizes) < 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("max_hot", [10, 3, 1, 1000])
def test_distinct_key_resolve_is_the_same(spark, max_hot):
    got = resolve_by_distinct_keys(events(spark), identity(spark), max_hot_keys=max_hot)
    assert found(got) == WANT
    expected = resolve_ids(events(spark), identity(spark))
    assert got.exceptAll(expected.select(got.columns)).isEmpty()


def test_resolve_survives_adaptive_skew_splitting(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = resolve_ids(events(spark).repartition(7), identity(spark))
        assert found(got) == WANT
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_identity_needs_no_event_shuffle(spark, tmp_path):
    events(spark).write.parquet(f"{tmp_path}/e")
    identity(spark).write.parquet(f"{tmp_path}/i")
    read = spark.read.parquet(f"{tmp_path}/e")
    plan = resolve_ids(read, spark.read.parquet(f"{tmp_path}/i"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_worklist_and_entries(spark):
    parked = spark.createDataFrame(
        [
            ("p1", " p1", "11", "h1"), ("p1", "p1", "", "h0"), ("p2", "p2", "", "h1"),
            ("p3", "p3", "33", "h1"), ("", "", "", "h1"),
        ],
        "player_key string, user_id string, numeric_user_id string, date_hour string",
    )
    work = unresolved_keys(parked)
    got = {r.player_id: (r.numeric_id, r.events) for r in work.collect()}
    assert got == {"p1": ("11", 2), "p2": ("", 1), "p3": ("33", 1)}
    known = spark.createDataFrame([(" p3 ", "g3", "", 1), ("p2", "", "", 1)], FORWARD)
    assert {r.player_id for r in unresolved_keys(parked, known).collect()} == {"p1", "p2"}

    assigned = spark.createDataFrame(
        [("p1 ", "g1"), ("p1", "g1"), ("p2", "g2"), ("p3", ""), ("p9", "g9")], "player_id string, goc_id string"
    )
    forward = {(r.player_id, r.goc_id, r.numeric_id, r.seq) for r in forward_entries(work, assigned, 7).collect()}
    assert forward == {("p1", "g1", "11", 7), ("p2", "g2", "", 7)}
    reverse = {(r.goc_id, r.numeric_id, r.hashed_id) for r in reverse_entries(work, assigned, 7).collect()}
    assert {(g, n) for g, n, _ in reverse} == {("g1", "11"), ("g2", "")}
    numeric = [tuple(r) for r in numeric_entries(work, assigned, 7).collect()]
    assert numeric == [("11", "p1", "g1", 7)]


def test_upsert_latest_wins_and_incoming_wins_ties(spark):
    schema = "k string, v string, seq bigint"
    current = spark.createDataFrame([("a", "a1", 1), ("b", "b5", 5), ("c", "c1", 1)], schema)
    incoming = spark.createDataFrame([("a", "a2", 1), ("b", "b4", 4), ("d", None, 2)], schema)
    got = {tuple(r) for r in upsert(current, incoming, "k").collect()}
    assert got == {("a", "a2", 1), ("b", "b5", 5), ("c", "c1", 1), ("d", None, 2)}


def test_latest_per_key_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, seq int, v string")
    latest = latest_per_key(df, ["k"], [F.col("seq")])
    assert [tuple(r) for r in latest.collect()] == [("a", 2, None)]
    assert "partial_max_by" in latest._jdf.queryExecution().executedPlan().toString()
