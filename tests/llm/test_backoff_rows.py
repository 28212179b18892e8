import math
import random

import pytest
from test_backoff import brute

from eventloom.llm.backoff import backoff_scores, relational_scores


@pytest.mark.parametrize("order", [1, 3])
def test_rows_of_ngrams_against_brute_force(spark, order):
    rng = random.Random(73)
    rows = [(i, " ".join(rng.choices("a b c d E f gh ij".split(), k=rng.randint(0, 25)))) for i in range(80)]
    rows += [(200, None), (201, " \n "), (None, "a b c"), (0, rows[0][1]), (202, "never seen words")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, gram string")
    got = relational_scores(docs.repartition(4), order=order).collect()
    for g, w in zip(sorted(map(tuple, got), key=repr), brute(rows, order), strict=True):
        assert g[:2] == w[:2] and math.isclose(g[2], w[2], rel_tol=1e-9, abs_tol=1e-9)


def test_both_forms_agree_and_empty_tables(spark):
    schema = "doc_id long, text string"
    assert relational_scores(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, "x y " * 50_000), (2, "x y z"), (3, None)], schema)
    some = {r["doc_id"]: r["log_score"] for r in relational_scores(docs).collect()}
    for r in backoff_scores(docs).collect():
        assert math.isclose(some[r["doc_id"]], r["log_score"], rel_tol=1e-9)
