"""The physical plans that matter at scale."""

from conftest import packet
from pyspark.sql import functions as F

from eventloom.operators.backlog import hold_back, hours_after
from eventloom.operators.counts import hour_counts
from eventloom.operators.identity import unresolved_keys
from eventloom.plans.ingest import stage, transform
from eventloom.sources import packet_fields, parse_packets, read_hour_ledger, read_lines, replace_hour_cells
from test_backlog import DAY, hours, listing


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def routed(spark, profile, types, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text(packet() + "\n" + packet(user_id="u2") + "\n")
    ids = spark.createDataFrame([("u1", "g1")], "player_id string, goc_id string")
    parsed = parse_packets(read_lines(spark, str(tmp_path / "in")), packet_fields(profile, types))
    return transform(parsed, profile, types, ids)


def test_transform_parses_and_renders_once(spark, hashed, types, tmp_path):
    rows = routed(spark, hashed, types, tmp_path)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    # one rendering per event type and one of the envelope's head
    assert plan.count("StructsToJsonEvaluator") == len(hashed.event_names) + 1
    assert "Python" not in plan


def test_counts_do_not_render_json(spark, hashed, types, tmp_path):
    counts = hour_counts(routed(spark, hashed, types, tmp_path))
    assert "StructsToJsonEvaluator" not in counts._jdf.queryExecution().optimizedPlan().toString()


def test_staged_rows_are_pruned_by_route_and_column(spark, hashed, types, tmp_path):
    staged = stage(routed(spark, hashed, types, tmp_path), "routed", "route")
    plan = formatted(staged.where(F.col("route") == "published").select("envelope"))
    assert "PartitionFilters: [isnotnull(route" in plan
    assert "ReadSchema: struct<envelope:string>" in plan


def test_hour_ledger_reads_only_the_days_asked_for(spark, tmp_path):
    replace_hour_cells(listing(spark, (DAY[0], "a")), f"{tmp_path}/cells")
    plan = formatted(read_hour_ledger(spark, f"{tmp_path}/cells", ["2024/01/05", "2024/01/06"]))
    assert "PartitionFilters: [date" in plan and "ReadSchema: struct<path:string>" in plan


def test_no_cross_joins_between_rows(spark):
    frame = hours(spark, *DAY)
    for df in (hours_after(frame, DAY[3]), hours_after(frame, DAY[3], "all"), hold_back(frame)):
        plan = formatted(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "TakeOrderedAndProject" in formatted(hold_back(frame))


def test_worklist_counts_by_hashing(spark):
    rows = spark.createDataFrame([("k", "u", "n")], "player_key string, user_id string, numeric_user_id string")
    plan = formatted(unresolved_keys(rows))
    first = plan[: plan.index("Scan ExistingRDD")].rsplit("Aggregate", 1)[0]
    assert first.endswith("Hash")
