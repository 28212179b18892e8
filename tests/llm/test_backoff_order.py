import math

from test_backoff import brute

from eventloom.llm.backoff import op3_stupid_backoff


def test_query_counts_two_words_of_context(spark, tmp_path):
    rows = [(1, "a b c"), (2, "a b c"), (3, "a b d"), (4, "x b d"), (5, "x b d e"), (6, "b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op3_stupid_backoff(spark, str(tmp_path)).collect()))
    assert any(not math.isclose(a[2], b[2]) for a, b in zip(brute(rows, 2), brute(rows, 3)))
    for g, w in zip(got, brute(rows, 3), strict=True):
        assert g[:2] == w[:2] and math.isclose(g[2], w[2], rel_tol=1e-9)
