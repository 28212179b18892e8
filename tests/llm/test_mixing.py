import math
import random

import pytest
from pyspark.sql import functions as F

from eventloom.llm.mixing import Mix, source_targets, split_quotas


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets as the rule says it: cap, hand the excess on by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    budget = share * sum(sizes.values())
    while open_:
        rest = budget - sum(target.values())
        level = rest / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > most * sizes[s]}
        if not over:
            target |= {s: w[s] * level for s in open_}
            break
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


def rows(n, sources, seed):
    rng = random.Random(seed)
    out = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(sources)) for i in range(n)]
    return out + [(n, None, sources[0]), (n + 1, " \t", "only blank"), (None, "no id here", sources[0])]


@pytest.mark.parametrize("sources", [["a"], ["a"] * 5 + ["b", None, "é", "z", "Z"]])
def test_targets_and_taken(spark, sources):
    data = rows(800, sources, 6)
    docs = spark.createDataFrame(
        [(*r, 7) for r in data], "doc_id long, text string, source string, size int"
    )
    mix = Mix(docs.repartition(3), block_words=200, blocks_per_shard=4)
    got = mix.taken().collect()
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = fill(sizes)
    assert len(got) == len(data)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 16 for s in sizes)
    again = Mix(docs.repartition(7), block_words=200, blocks_per_shard=4).taken().collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    mixed = mix.rows()
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {r["id"]: r["taken"] // r["size"] for r in got if r["taken"]}


def test_shards_get_disjoint_draws_and_even_counts(spark):
    docs = spark.createDataFrame(rows(1500, ["a", "a", "b", "c"], 8), "doc_id long, text string, source string")
    mix = Mix(docs, block_words=100, blocks_per_shard=8)
    draws = mix.shard_draws().collect()
    assert len({(d["rank"], d["block"], d["draw"]) for d in draws}) == len(draws)
    assert len(draws) == mix.blocks.agg(F.sum("draws")).first()[0]
    per = {}
    for d in draws:
        per[d["shard"]] = per.get(d["shard"], 0) + 1
    assert len(per) == mix.shards and max(per.values()) - min(per.values()) <= 1


def test_splitting_tree_is_hypergeometric(spark):
    quotas = spark.createDataFrame([(1, 30), (2, 10), (3, 0)], "rank int, quota long")
    seen = []
    for seed in range(12):
        got = split_quotas(quotas, 4, seed).collect()
        table = {(r["shard"], r["rank"]): r["quota"] for r in got}
        assert sum(table[s, 1] for s in range(4)) == 30 and sum(table[s, 2] for s in range(4)) == 10
        assert all(sum(table[s, k] for k in (1, 2, 3)) == 10 for s in range(4))
        seen.append(table[0, 1])
    assert 6.5 <= sum(seen) / len(seen) <= 8.5 and len(set(seen)) > 1


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    mix = Mix(spark.createDataFrame([], schema))
    assert mix.taken().count() == 0 and mix.rows().count() == 0
    blank = Mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema))
    assert [tuple(r)[2:6] for r in blank.taken().collect()] == [(0, 0, 0.0, 0)] * 2
    assert blank.rows().count() == 0


def test_long_text(spark):
    docs = spark.createDataFrame([(1, "w " * 200_000, "a"), (2, "w", "a")], "doc_id long, text string, source string")
    assert {r["id"]: r["size"] for r in Mix(docs).taken().collect()} == {1: 200_000, 2: 1}


def test_targets_table(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1), ("c", 5), (None, 3)], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes, (5, 2, 1), 1.5, 2.0).collect()}
    want = fill({"a": 100, "b": 1, "c": 5, None: 3})
    assert all(math.isclose(got[s], want[s], rel_tol=1e-12) for s in want)


@pytest.mark.parametrize("same_text", [True, False])
def test_rows_of_equal_id_and_size_are_cut_apart(spark, same_text):
    schema = "doc_id long, text string, source string, `a-b` int"
    data = [(None, "w w w" if same_text else f"w w {i}", "a", i) for i in range(1000)]
    data += [(i, "x y", "b", 0) for i in range(200)]
    docs = spark.createDataFrame(data, schema)
    for parts in (1, 6):
        mix = Mix(docs.repartition(parts), weights=(1.0, 1.0), most=5.0, block_words=500)
        got = mix.taken().collect()
        taken = {s: sum(r["taken"] for r in got if r["source"] == s) for s in "ab"}
        want = {r["source"]: r["target"] for r in got}
        assert abs(taken["a"] - want["a"]) <= 1.5 and abs(taken["b"] - want["b"]) <= 1, (taken, want)
        assert len(got) == 1200
        drawn = {r["source"]: r["n"] for r in mix.rows().groupBy("source").agg(F.count("*").alias("n")).collect()}
        assert drawn == {"a": taken["a"] // 3, "b": taken["b"] // 2}
