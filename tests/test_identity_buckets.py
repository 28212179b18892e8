"""Identity tables in buckets: what an update touches, and joins that take them as they lie."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from eventloom.operators.identity import resolve_by_distinct_keys, resolve_ids
from eventloom.sources import ConcurrentUpdate, identity as module, identity_buckets, merge_identity, read_identity, release_claim
from test_plans import formatted
from test_identity import EVENTS, FORWARD, WANT, events, found, identity


def entries(spark, *rows):
    return spark.createDataFrame([(k, g, "", s) for k, g, s in rows], FORWARD)


def files(path):
    """Data file -> time written, of the folders the newest manifest names."""
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data-*/slot=*/version=*/*.parquet")}


def contents(spark, path):
    return {r.player_id: (r.goc_id, r.seq) for r in read_identity(spark, path).collect()}


def test_an_update_leaves_the_files_of_other_buckets(spark, tmp_path):
    path = str(tmp_path / "forward")
    merge_identity(entries(spark, *[(f"u{i}", f"g{i}", 1) for i in range(200)]), path)
    before = files(path)
    assert len(before) == module.FEWEST_BUCKETS
    merge_identity(entries(spark, ("u7", "changed", 2)), path)
    after = files(path)
    new = set(after) - set(before)
    assert len(new) == 1 and all(after[f] == t for f, t in before.items())
    rows = contents(spark, path)
    assert len(rows) == 200 and rows["u7"] == ("changed", 2) and rows["u8"] == ("g8", 1)
    # the folder before stays for readers that began with it, and goes with the next update
    merge_identity(entries(spark, ("u7", "again", 3)), path)
    merge_identity(entries(spark, ("u7", "more", 4)), path)
    assert len(files(path)) == module.FEWEST_BUCKETS + 1 and contents(spark, path)["u7"] == ("more", 4)
    assert len(glob.glob(f"{path}/manifests/number=*")) == 2


def test_an_update_reads_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "forward")
    merge_identity(entries(spark, *[(f"u{i}", "g", 1) for i in range(200)]), path)
    slot = spark.range(1).select(F.pmod(F.hash(F.lit("u7")), F.lit(module.FEWEST_BUCKETS))).first()[0]
    for damaged in glob.glob(f"{path}/data-*/slot=*/version=*/*.parquet"):
        if f"slot={slot}/" not in damaged:
            with open(damaged, "w") as out:
                out.write("unreadable")
            os.path.exists(crc := os.path.join(os.path.dirname(damaged), f".{os.path.basename(damaged)}.crc")) and os.remove(crc)
    merge_identity(entries(spark, ("u7", "changed", 2)), path)
    assert len(glob.glob(f"{path}/manifests/number=*")) == 2


def test_ties_and_nulls(spark, tmp_path):
    path = str(tmp_path / "forward")
    merge_identity(entries(spark, ("a", "a1", 5), ("b", "b1", None), ("c", "c1", 5), ("d", "d1", None)), path)
    merge_identity(entries(spark, ("a", "a2", 5), ("b", "b2", None), ("c", "c2", 4), ("d ", "d2", 1), ("a", "a0", 5), ("e", "e2", None), (" ", "x", 9)), path)
    assert contents(spark, path) == {"a": ("a2", 5), "b": ("b2", None), "c": ("c1", 5), "d": ("d2", 1), "e": ("e2", None)}
    merge_identity(entries(spark, ("a", "a3", None)), path)
    assert contents(spark, path)["a"] == ("a2", 5)


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "forward")
    merge_identity(entries(spark, ("a", "a1", 1)), path)
    real = module._update

    def meanwhile(*args):
        monkeypatch.setattr(module, "_update", real)
        with pytest.raises(ConcurrentUpdate, match="under way"):
            merge_identity(entries(spark, ("b", "b1", 1)), path)
        real(*args)

    monkeypatch.setattr(module, "_update", meanwhile)
    merge_identity(entries(spark, ("c", "c1", 1)), path)
    assert set(contents(spark, path)) == {"a", "c"}
    # one that counted its number before the other was done
    numbers = module._manifests
    seen = [[1], numbers(spark, path)]
    monkeypatch.setattr(module, "_manifests", lambda *a: seen.pop(0) if seen else numbers(*a))
    with pytest.raises(ConcurrentUpdate, match="first"):
        merge_identity(entries(spark, ("d", "d1", 1)), path)
    monkeypatch.setattr(module, "_manifests", numbers)
    merge_identity(entries(spark, ("d", "d1", 1)), path)
    assert set(contents(spark, path)) == {"a", "c", "d"}


def test_an_update_that_stops_leaves_the_last_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "forward")
    merge_identity(entries(spark, ("a", "a1", 1)), path)
    real = spark.createDataFrame
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):  # folders are written, the manifest is not
            merge_identity(real([("a", "a2", "", 2)], FORWARD), path)
    assert contents(spark, path) == {"a": ("a1", 1)}
    merge_identity(entries(spark, ("a", "a3", 3)), path)
    assert contents(spark, path) == {"a": ("a3", 3)}
    # a lost driver leaves its claim behind
    os.makedirs(f"{path}/claims", exist_ok=True)
    open(f"{path}/claims/3", "w").close()
    with pytest.raises(ConcurrentUpdate):
        merge_identity(entries(spark, ("a", "a4", 4)), path)
    release_claim(spark, path)
    merge_identity(entries(spark, ("a", "a4", 4)), path)
    assert contents(spark, path) == {"a": ("a4", 4)}


def test_buckets_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "BUCKET_ROWS", 10)
    path = str(tmp_path / "forward")
    for at in range(0, 120, 30):
        merge_identity(entries(spark, *[(f"u{i}", f"g{i}", 1) for i in range(at, at + 30)]), path)
    assert contents(spark, path) == {f"u{i}": (f"g{i}", 1) for i in range(120)}
    assert os.path.isdir(f"{path}/data-16")


def test_a_table_of_whole_versions_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "forward")
    entries(spark, ("a", "a1", 1), ("b", "b1", 1)).write.parquet(f"{path}/version=3")
    assert set(contents(spark, path)) == {"a", "b"}
    merge_identity(entries(spark, ("b", "b2", 2)), path)
    assert contents(spark, path) == {"a": ("a1", 1), "b": ("b2", 2)}


def test_lookup_takes_the_table_as_it_lies(spark, tmp_path):
    """No shuffle of the identity side, the same rows, and hot players split."""
    path = str(tmp_path / "forward")
    merge_identity(identity(spark), path)
    merge_identity(entries(spark, ("u1", "g1", 2)), path)  # a second version of one bucket
    rows = spark.createDataFrame([("hot", i, f"v{i}", None, None) for i in range(300)], EVENTS).unionByName(events(spark))
    rows.write.parquet(str(tmp_path / "events"))
    rows = spark.read.parquet(str(tmp_path / "events"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        bucketed = read_identity(spark, path, bucketed=True)
        counted = rows.groupBy("player_key").count().repartition(identity_buckets(spark, path), "player_key")
        joined = counted.join(bucketed.withColumnRenamed("player_id", "player_key"), "player_key", "left")
        plan = formatted(joined)
        assert "Bucketed: true" in plan and "SortMergeJoin" in plan
        # shuffles only to count players and to deal them out; none on the identity side
        assert plan.count("Arguments: hashpartitioning") == 2
        want = {**WANT, ("hot", "ghot"): WANT["hot", "ghot"] + 300}
        got = resolve_by_distinct_keys(rows, bucketed, unique=True, max_hot_keys=8, buckets=identity_buckets(spark, path))
        assert found(got) == want
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = got.where("player_key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 2
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert found(resolve_ids(rows, read_identity(spark, path), unique=True)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
