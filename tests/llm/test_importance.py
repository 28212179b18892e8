import random

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm.importance import features, least_of_top, log_ratios, resample

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed):
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        words = [rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(rng.randint(20, 120))]
        truth[i] = rng.choices(["good", "junk", "toxic"], [6, 2, 1])[0]
        if truth[i] == "junk":
            words = [w + rng.choice(["%%%", "***"]) for w in words]
        if truth[i] == "toxic":
            for _ in range(len(words) // 12 + 1):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scum", "moron"])
        rows.append((i, " ".join(words)))
    return rows, truth


def test_draws_good_and_leaves_bad(spark):
    rows, truth = corpus(1500, 21)
    labels = [(i, int(truth[i] != "junk"), int(truth[i] == "toxic")) for i in range(0, 1500, 2)]
    labels += [(1, None, 0), (None, 1, 0), (3, 1, None), (0, labels[0][1], labels[0][2])]
    docs = spark.createDataFrame(
        [(*r, 1.5, "k") for r in rows] + [(9000, None, 0.0, ""), (9001, " ", 0.0, "")],
        "doc_id long, text string, key double, good string",
    )
    got = resample(docs.repartition(3), spark.createDataFrame(labels, LABELS), buckets=1 << 14)
    drawn = [r["doc_id"] for r in got.collect()]
    held_out = {k: [i for i in range(1, 1500, 2) if truth[i] == k] for k in ("good", "junk", "toxic")}
    kept = {k: len(set(drawn) & set(v)) / len(v) for k, v in held_out.items()}
    assert kept["good"] > 0.95 and kept["junk"] < 0.02 and kept["toxic"] < 0.1, kept
    assert not {9000, 9001} & set(drawn)
    again = resample(docs.repartition(5), spark.createDataFrame(labels, LABELS), buckets=1 << 14)
    assert sorted(drawn) == sorted(r["doc_id"] for r in again.collect())


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)], [(77, 1, 0)]])
def test_without_good_labels_all_stay(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, ""), (None, "c"), (2, "d")], "doc_id long, text string")
    got = resample(docs, spark.createDataFrame(labels, LABELS), buckets=1 << 8)
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1, 2]


def test_empty_table_and_long_text(spark):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert resample(docs, labels, buckets=1 << 8).count() == 0
    docs = spark.createDataFrame([(1, "word " * 150_000)], "doc_id long, text string")
    assert resample(docs, labels, buckets=1 << 8).count() == 1


@pytest.mark.parametrize("values", [[1.0] * 50, [float(i % 7) for i in range(100)], [1e-12, 1e12, -5.0, 0.25]])
def test_least_of_top(spark, values):
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in {1, 2, len(values) // 2, len(values)}:
        assert least_of_top(keys, k, bins=4) == sorted(values, reverse=True)[k - 1]


def test_models():
    found, text, counts = features(pa.array(["Ab, cd", None, "x"]), 1 << 16)
    assert counts.tolist() == [2, 0, 1] and len(found) == 6 * 3 + 1
    assert sorted(set(text.tolist())) == [0, 2]
    ratios = log_ratios(np.array([0.0, 500, 0]), np.array([100.0, 1000, 1]), 1.0, 2.0)
    assert ratios[0] < -3 and ratios[1] == 0 and ratios[2] == 0


def test_columns_of_any_name_are_carried(spark):
    names = ["doc_id", "text", "a-b", "a.b", "source url", "__id", "__good", "__log_weight", "row", "id", "key"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names[2:])
    rows = [(i, f"some words {i}", *[f"{c}{i}" for c in names[2:]]) for i in range(8)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 1)], LABELS)
    got = resample(spark.createDataFrame(rows, schema), labels, buckets=1 << 8)
    assert got.columns == [*names, "___log_weight"]
    assert {tuple(r)[:-1] for r in got.collect()} <= set(rows) and got.count() > 0
