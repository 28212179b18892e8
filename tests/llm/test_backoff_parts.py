import os
import random

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm.backoff import Grams, backoff_scores, part_grams
from eventloom.llm.common import keep_table


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    found = set()
    for folder in folders:
        for at, _, names in os.walk(folder):
            found |= {os.path.join(at, n) for n in names if n.startswith("shuffle_") and n.endswith(".data")}
    return found


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_parts_hold_each_gram_once(parts):
    rng = random.Random(74)
    texts = pa.array([" ".join(rng.choices("abcdefgh", k=40)) for _ in range(9)] + [None, "", "a", "a b"])
    whole = Grams(texts, 3)
    found = [part_grams(texts, 3, part, parts) for part in range(parts)]
    assert np.array_equal(np.concatenate([g for g, _ in found]), whole.distinct)
    assert np.array_equal(np.concatenate([t for _, t in found]), whole.times)
    assert all(len(g) < 0.7 * len(whole.distinct) for g, _ in found) or parts == 1


def test_kept_tables_leave_no_shuffle_files(spark):
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(conf), shuffle_files(spark)
    rows = spark.range(5000).selectExpr("id % 700 as k").groupBy("k").count()
    assert keep_table(rows, "no-shuffle-left").count() == 700
    assert not {f for f in shuffle_files(spark) - files if os.path.getsize(f) > 2000}
    assert spark.conf.get(conf) == before


def test_asked_grams_are_gone_before_texts_move(spark):
    rng = random.Random(75)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(300))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    files = shuffle_files(spark)
    scores = backoff_scores(docs, window_bytes=50_000)
    left = [f for f in shuffle_files(spark) - files if os.path.exists(f)]
    assert sum(map(os.path.getsize, left)) < 50_000  # the packed n-grams take above 500,000
    assert scores.count() == 200
