"""Files as a table: scans of listed files, slices within an hour, and settled files by the index."""

import os
from datetime import datetime

import pytest
from conftest import packet, put_file
from pyspark.sql import functions as F

from eventloom.operators.backlog import settled, settled_before
from eventloom.plans.ingest import _slices, hash_ledger_run, hour_ledger_run, published_rows
from eventloom.sources import list_files, read_listed
from test_plans import formatted
from test_run_names import counting
from test_runs import HOURS, NOW, layout, want  # noqa: F401

NAMES = ["a", "b c", "é%20x+y", "p%2Bq#?&[1]{2}", "tab'\"é"]


@pytest.mark.parametrize("partitioned", [True, False])
def test_only_listed_files_are_read(spark, tmp_path, partitioned):
    root = tmp_path / "raw"
    for hour in ("03", "04"):
        for name in NAMES:
            folder = f"date=2024-01-05/hour={hour}" if partitioned else f"2024/01/05/{hour}"
            put_file(root, folder, name, f"{hour} {name}\n")
    # a table, as the list of a run is
    list_files(spark, str(root)).withColumn("run", F.lit("r")).write.partitionBy("run").parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files")).where("run = 'r'")
    chosen = files.where(~F.col("path").endswith("/a"))
    hours = ["2024/01/05/03", "2024/01/05/04"]
    lines = read_listed(spark, str(root), chosen, hours, partitioned)
    want = {(f"{h} {n}", f"2024/01/05/{h}") for h in ("03", "04") for n in NAMES[1:]}
    assert {tuple(r) for r in lines.collect()} == want and lines.count() == 8
    one = read_listed(spark, str(root), chosen, hours[:1], partitioned)
    assert one.count() == 4
    plan = formatted(lines)
    assert "LeftSemi" in plan and ("dynamicpruning" in plan) == partitioned
    assert read_listed(spark, str(root), chosen, [], partitioned).count() == 0


def test_an_hour_with_too_many_files_is_cut(spark, layout, hashed, types, tmp_path):
    for i in range(20):
        old = put_file(tmp_path / "raw", HOURS[3], f"f{i}", packet(user_id="u1", session_id=f"s{i}"))
        os.utime(old, (1704400000, 1704400000))
    rows = sorted(want(HOURS) + [(f"s{i}", "g1") for i in range(20)])
    names = hash_ledger_run(spark, layout, hashed, types, now=NOW, run="one", slice_files=6)
    # three hours; four pieces of the full one; four hours
    assert names == ["one", *[f"one-{i}" for i in range(2, 7)]]
    assert sorted(r[:2] for r in counting(spark, layout)) == rows
    assert hash_ledger_run(spark, layout, hashed, types, now=NOW, run="two", slice_files=6) == []


def test_cells_hold_what_was_read_so_far(spark, layout, hashed, types, tmp_path, monkeypatch):
    from eventloom.plans import ingest

    for i in range(20):
        old = put_file(tmp_path / "raw", HOURS[3], f"f{i}", packet(user_id="u1", session_id=f"s{i}"))
        os.utime(old, (1704400000, 1704400000))
    real, calls = ingest.replace_hour_cells, []

    def stops(*args):
        calls.append(args)
        real(*args) if len(calls) < 4 else 1 / 0

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "replace_hour_cells", stops)
        with pytest.raises(ZeroDivisionError):
            hour_ledger_run(spark, layout, hashed, types, now=NOW, run="one", slice_files=6)
    done = {r[3] for r in counting(spark, layout)}
    left = hour_ledger_run(spark, layout, hashed, types, now=NOW, run="two", slice_files=6)
    assert left[0] == max(done) and len(left) >= 2
    assert sorted(r[:2] for r in counting(spark, layout)) == sorted(want(HOURS) + [(f"s{i}", "g1") for i in range(20)])
    cells = spark.read.parquet(layout.hour_ledger)
    assert cells.where("hour = 3").count() == 21 and cells.count() == 28


def test_slices(spark):
    rows = [("h1", 3), ("h2", 2), ("h3", 11), ("h4", 1), ("h5", 0)]
    files = spark.createDataFrame(
        [(h, f"{h}/{i}", False) for h, n in rows for i in range(n)] + [("h1", "h1/old", True), ("h5", "h5/old", True)],
        "date_hour string, path string, processed boolean",
    )
    slices = _slices(files, 5)
    assert [(s.hours, s.piece, s.pieces) for s in slices] == [
        (["h1", "h2"], 0, 1), (["h3"], 0, 3), (["h3"], 1, 3), (["h3"], 2, 3), (["h4", "h5"], 0, 1),
    ]
    read = [{r.path for r in s.of(files).where("NOT processed").collect()} for s in slices]
    assert sum(map(len, read)) == 17 and len(set().union(*read)) == 17
    assert slices[3].of(files).count() == 11


def test_the_index_lists_exactly_the_settled_files(spark, tmp_path):
    now = datetime.fromisoformat("2024-01-05T07:30:00+00:00").timestamp()
    for age in (0, 299, 300, 359, 359.5, 360, 360.5, 361, 420, 7200):
        file = put_file(tmp_path / "raw", "2024/01/05/03", f"age{age}", "x")
        os.utime(file, (now - age, now - age))
    moment = F.to_timestamp(F.lit(NOW))
    for minutes in (0, 4, 5, 6):
        wanted = {r.path for r in settled(list_files(spark, str(tmp_path / "raw")), moment, minutes).collect()}
        listed = list_files(spark, str(tmp_path / "raw"), before=settled_before(NOW, minutes))
        assert {r.path for r in listed.collect()} == wanted
        assert len(listed.inputFiles()) == len(wanted)  # the others are no input at all
    late = list_files(spark, str(tmp_path / "raw"), after=datetime(2024, 1, 5, 7, 0))
    assert late.count() == 9
