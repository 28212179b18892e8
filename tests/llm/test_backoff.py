import math
import random
from collections import Counter

import pytest

import numpy as np

from eventloom.llm.backoff import backoff_scores, pack_grams, unpack_grams


def brute(rows, order):
    texts = [(d, (t or "").lower().split()) for d, t in rows]

    def count(words):
        return Counter(tuple(words[i - k + 1 : i + 1]) for k in range(1, order + 1) for i in range(k - 1, len(words)))

    own = [count(w) for _, w in texts]
    total = sum(own, Counter())
    n = sum(len(w) for _, w in texts)
    out = []
    for (d, words), mine in zip(texts, own):
        rest = max(n - len(words), 1)
        seen = lambda g: total[g] - mine[g]  # noqa: B023, E731

        def score(gram):
            if len(gram) == 1:
                return max(seen(gram), 1) / rest
            if seen(gram) > 0:
                return seen(gram) / max(seen(gram[:-1]), 1)
            return 0.4 * score(gram[1:])

        total_log = sum(math.log(score(tuple(words[max(0, i - order + 1) : i + 1]))) for i in range(len(words)))
        out.append((d, len(words), total_log))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(spark, order):
    rng = random.Random(71)
    rows = [(i, " ".join(rng.choices("a b c d E f gh ij".split(), k=rng.randint(0, 25)))) for i in range(80)]
    rows += [(200, None), (201, " \n "), (None, "a b c"), (0, rows[0][1]), (202, "never seen words")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, window string")
    got = backoff_scores(docs.repartition(4), order=order, window_bytes=300).collect()
    for g, w in zip(sorted(map(tuple, got), key=repr), brute(rows, order), strict=True):
        assert g[:2] == w[:2] and math.isclose(g[2], w[2], rel_tol=1e-9, abs_tol=1e-9)


def test_empty_table_and_long_text(spark):
    schema = "doc_id long, text string"
    assert backoff_scores(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, "x y " * 100_000), (2, "x y z")], schema)
    got = {r["doc_id"]: r for r in backoff_scores(docs).collect()}
    assert got[1]["n_words"] == 200_000 and got[2]["log_score"] < 0


def test_packed_hashes():
    rng = np.random.default_rng(72)
    for n in (1, 5, 4000):
        grams = np.unique(rng.integers(0, 1 << 55, n, dtype=np.uint64) + np.uint64(7 << 55))
        packed = pack_grams(grams, 7 << 55)
        assert np.array_equal(unpack_grams(packed, 7 << 55), grams)
        assert n < 4000 or len(packed) <= 6 * n + 1
    edge = np.array([0, 2**64 - 1], np.uint64)
    assert np.array_equal(unpack_grams(pack_grams(edge, 0), 0), edge)
